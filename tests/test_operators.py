"""Small cases with known answers for the operators."""

import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom import storage
from chatloom.functions import text as tx
from chatloom.functions.similarity import Rests, lcs_length, token_set_ratio
from chatloom.operators import clusters, conversion, enrichment, ordered, reporting, templates
from chatloom.plans.runner import MissingInput, Runner, Stage
from chatloom.sources import files, sqlite


@pytest.mark.parametrize("a,b,score", [("obrigada", "obrigado", 87.5), ("ok", "ok perfeito obrigado", 100), ("ola bom dia", "ola, bom dia!", 91.67), ("bom dia", "boa tarde", 50)])
def test_token_set_ratio(a, b, score):
    assert token_set_ratio(a, b) == pytest.approx(score, abs=0.01)
    assert token_set_ratio(b, a) == token_set_ratio(a, b)


def test_lcs_equals_table():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a, b = ("".join(rng.choice(list("abcd"), rng.integers(0, 15))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert lcs_length(a, b) == t[-1][-1]


def test_fuzzy_links_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    words = ["bom", "dia", "ola", "obrigada", "obrigado", "perfeito", "massagem", "massagens", "valor"]
    norms = sorted({" ".join(rng.choice(words, rng.integers(1, 5))) for _ in range(60)})
    df = spark.createDataFrame(list(enumerate(norms)), "id long, norm string")
    got = {(r.a, r.b) for r in templates.fuzzy_links(df).collect()}
    want = {(i, j) for i in range(len(norms)) for j in range(i + 1, len(norms)) if token_set_ratio(norms[i], norms[j]) >= 87.5}
    assert got == want and want


def test_fuzzy_templates(spark):
    rows = [(0, 1, 1000, "Olá, bom dia!"), (1, 2, 5000, "Ola bom dia 😊"), (2, 3, 3000, "Olá, bom dia!!!"), (3, 4, 10, "O valor é 200 reais"), (4, 5, 11, "😊")]
    df = spark.createDataFrame(rows, "load_idx long, msg_id long, ts_ms long, text string").withColumn("norm", tx.ascii_fold(F.col("text")))
    out, members = templates.fuzzy_templates(df)
    got = {r.template_id: r for r in out.collect()}
    assert got[0].canonical_text == "Olá, bom dia!!!" and got[0].instance_count == 3 and got[0].example_msg_ids == [1, 2, 3]
    assert (got[0].first_seen_ts, got[0].last_seen_ts) == (1000, 5000)
    assert {r.msg_id: r.template_id for r in members.collect()} == {1: 0, 2: 0, 3: 0, 4: 1}


def test_text(spark):
    df = spark.createDataFrame([("hi https://x.com\n\n hi",), (" a  b\x1c",), (None,)], "t string")
    assert [r[0] for r in df.select(tx.clean_text(F.col("t"))).collect()] == ["hi hi", "a b", None]


@pytest.mark.parametrize("p,want", [(0, [[], []]), (1, [[200], [200]]), (3, [[200, 201], [202, 200], [200, 201], [200, 201]]), (4, [[200, 201], [202, 203], [200, 201]])])
def test_pairing(spark, p, want):
    turn = spark.createDataFrame([(i, "price", i) for i in range(len(want))], "chat_id long, objection_type string, conv_order long")
    lost = spark.createDataFrame([(200 + i, "price", f"2024-01-0{i + 1}", i) for i in range(p)], "chat_id long, objection_type string, date string, conv_order long")
    assert [r.paired_lost_deals for r in conversion.paired(turn, lost).orderBy("conv_order").collect()] == want


def test_windows(spark):
    sizes = spark.createDataFrame([(1, 200), (2, 30), (3, 100), (4, 0)], "chat_id long, n long")
    objections = spark.createDataFrame([(1, 80)], "chat_id long, pos long")
    got = ordered.with_gaps(ordered.merged(ordered.windows_of(sizes, objections))).orderBy("chat_id", "a").collect()
    assert [tuple(r) for r in got] == [(1, 0, 15, 0), (1, 70, 91, 55), (1, 185, 200, 94), (2, 0, 30, 0), (3, 0, 15, 0), (3, 85, 100, 70)]


def test_medoid_and_clusters(spark):
    points = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.2]), (3, [0.2, -1.0]), (4, [1.0, 1.0])]
    df = spark.createDataFrame([(0, *p) for p in points] + [(1, 7, [0.0, 0.0])], "g int, id long, v array<float>")
    got = {r.g: (r.medoid, r.size) for r in clusters.medoids(df, "g", "id", "v").collect()}
    unit = np.array([v for _, v in points]) / np.linalg.norm([v for _, v in points], axis=1, keepdims=True)
    assert got == {0: (int((1 - unit @ unit.T).sum(axis=1).argmin()), 5), 1: (7, 1)} and got[0][0] == 4
    rng = np.random.default_rng(3)
    rows = [(0, i, [float(x) for x in (np.eye(3)[i % 2] + rng.normal(0, 0.02, 3))]) for i in range(12)]
    got = {r.id: r.cluster for r in clusters.density_clusters(spark.createDataFrame(rows, "g int, id long, v array<double>"), "g", "id", "v").collect()}
    assert len({got[i] for i in range(0, 12, 2)} - {-1}) == 1 and len({got[i] for i in range(1, 12, 2)} - {-1}) == 1 and got[0] != got[1]


def test_enrich_and_checks(spark):
    provider = enrichment.KeywordProvider({"1": ["oi"]}, {"price": ["caro"]}, ["bom"], ["ruim"])
    items = spark.createDataFrame([(i, 100 + i, t) for i, t in enumerate(["oi", "muito caro", "ruim"])], "idx long, msg_id long, text string")
    got = {r.msg_id: tuple(r)[1:] for r in enrichment.enrich(items, provider, "msg_id", "msg_id long, step_id string, objection_type string, sentiment string", 2).collect()}
    assert got == {100: ("1", None, "neu"), 101: (None, "price", "neu"), 102: (None, None, "neg")}
    with pytest.raises(enrichment.BudgetExceeded):
        enrichment.guard(1.0, 0.5, 1.2)


def test_headers():
    assert reporting.repaired_headers("## 2. foo\nx", ["## 1. A", "## 2. B"]) == "## 2. B\nx\n\n## 1. A\n(sem dados — stub)\n"
    assert reporting.repaired_headers("  ##1. Viadas\n ## 2. B\n### 1. x", ["## 1. A", "## 2. B"]) == "## 1. A\n## 2. B\n### 1. x\n"


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "a.db")
    with sqlite3.connect(path) as c:
        c.execute("create table message(_id integer primary key, text_data text, timestamp integer)")
        c.executemany("insert into message values (?, ?, ?)", [(i, f"m{i}", i * 10) for i in range(1, 51)] + [(60, None, None)])
    df = sqlite.read(spark, path, "message", 3)
    assert df.count() == 51 and df.filter("text_data is null").first()._id == 60
    assert sqlite.label_catalogue(spark, path).count() == 0


def test_files(tmp_path):
    p = tmp_path / "phones.txt"
    p.write_text("# x\n5511000000001\n\n5511000000001\n5511000000002\n")
    assert files.phone_list(p) == ["5511000000001", "5511000000002"]
    p.write_text("1' OR 1=1 --\n")
    with pytest.raises(ValueError):
        files.phone_list(p)
    assert files.user_date("20.04.2026") == "2026-04-20" and files.iso_ms("1970-01-02") == 86_400_000


def test_runner(spark, tmp_path):
    calls = []

    def stage(n):
        return Stage(n, f"s{n}", lambda f: calls.append(n) or (tmp_path / f"o{n}").write_text("x") and {"n": n}, needs=[f"o{n - 1}"] if n > 1 else [], outputs=[f"o{n}"])

    r = Runner(storage.Folder(spark, tmp_path), [stage(1), stage(2)], {"input": "a"})
    with pytest.raises(MissingInput):
        r.run(only=2)
    r.run()
    r.run()
    assert calls == [1, 2]
    r.fingerprint = {"input": "b"}
    r.run()
    assert calls == [1, 2, 1, 2]


def test_rests_lose_no_pair_within_reach():
    """Same letters, other words: counts of letters let nearly all pairs pass, their order few; near ones stay."""
    rng = np.random.default_rng(3)
    texts = [[f"{''.join(rng.choice(list('abcdefghij'), 6))}" for _ in range(40)] for _ in range(60)]
    texts += [[w[:-1] if k % 3 else w for k, w in enumerate(t)] for t in texts[:20]] + [t[:34] + u[34:] for t, u in zip(texts[:20], texts[20:40], strict=True)]
    texts = [sorted(set(t)) for t in texts]
    size = np.array([len(" ".join(t)) for t in texts])
    rests, left = Rests(texts), 0
    for i in range(len(texts)):
        others = np.array([j for j in range(len(texts)) if j != i])
        most = 0.125 * (size[others] + size[i])
        found = set(rests.within(i, others, most).tolist())
        left += len(found)
        for j, m in zip(others.tolist(), most.tolist(), strict=True):
            one, other = (" ".join(sorted(set(texts[p]) - set(texts[q]))) for p, q in ((i, j), (j, i)))
            assert len(one) + len(other) - 2 * lcs_length(one, other) > m or j in found
    assert 40 <= left < len(texts) * len(texts) / 10


def _rows_shuffled(spark):
    store = spark._jsc.sc().statusStore()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    seq = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return sum(seq.apply(i).shuffleWriteRecords() for i in range(seq.size()))


def test_links_by_words_pass_candidates_to_no_shuffle(spark, monkeypatch):
    """Texts of few words, all common, are nearly all candidates of each other, and few are links."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["ab", *(f"w{k}" for k in rng.choice(24, 8, replace=False))])) for i in range(1000)]
    rows += [(1000 + i, norm + " und") for i, (_, norm) in enumerate(rows[:20])]
    # Words of one text alone are shared by none, but are part of it.
    rows += [(2000, "ab alone w1"), (2001, "ab alonely w1"), (2002, "ab"), (2003, "nobody else"), (2004, "a"), (2005, "w1 w2 w3 w4 w5 w6 w7"), (2006, "w1 w2 w3 w4 w5 w6 w7 abcdef"), (2007, "w1 w2 w3 w4 w5 w6 w7 w8 w9")]
    monkeypatch.setattr(templates, "BLOCK", 100)
    monkeypatch.setattr(templates, "WORD_BLOCKS", 3)
    monkeypatch.setattr(templates, "CANDIDATES", 50)
    df = storage.saved(templates.worded(spark.createDataFrame(rows, "id long, norm string")), "words")

    def score(a, b):
        x, y = set(a.split()), set(b.split())
        both, (la, lb) = x & y, (len(" ".join(sorted(s))) for s in (x, y))
        c = len(" ".join(sorted(both)))
        return 0 if not both else 100.0 if both in (x, y) else max(200 * c / (c + la), 200 * c / (c + lb))

    before = _rows_shuffled(spark)
    got = [(r.a, r.b, r.score) for r in templates.links_by_words(df, 87.5).collect()]
    dealt = _rows_shuffled(spark) - before
    want = [(a, b, score(s, t)) for k, (a, s) in enumerate(rows) for b, t in rows[k + 1 :] if score(s, t) >= 87.5]
    assert sorted(got) == sorted(want) and len(want) > 1000
    assert dealt < 60 * len(rows), dealt


def test_blocks_of_texts_meet_without_copies(spark, monkeypatch):
    """Many small blocks: each text is dealt a few times, not once for each block that it meets."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(sorted({f"w{k}x" for k in rng.choice(300, 6, replace=False)}))) for i in range(200)]
    rows += [(200 + i, norm.replace("x", "", 1)) for i, (_, norm) in enumerate(rows[:40])]
    monkeypatch.setattr(templates, "BLOCK", 20)
    monkeypatch.setattr(templates, "WORD_BLOCK", 20)
    df = storage.saved(templates.worded(spark.createDataFrame(rows, "id long, norm string")), "texts")
    want = {(a, b) for k, (a, s) in enumerate(rows) for b, t in rows[k + 1 :] if token_set_ratio(s, t) >= 87.5}
    for links, most in ((templates._by_letters, 4), (templates.links_by_words, 12)):
        before = _rows_shuffled(spark)
        got = [(r.a, r.b) for r in links(df, 87.5).collect()]
        dealt = _rows_shuffled(spark) - before
        assert len(got) == len(set(got)) and set(got) <= want and dealt < most * len(rows), dealt
        assert links is templates.links_by_words or set(got) == want and len(want) >= 40
