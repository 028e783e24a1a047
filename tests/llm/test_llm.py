"""The training-data operators against brute force on small tables with awkward rows."""

import collections
import json
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.llm import common, fingerprints, language, mixing, neardup, packing, pii, quality, search, sharding, substrings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality int, _range int"
VOCAB = [f"w{i}" for i in range(60)] + ["é", "ß💛"]


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, repeated words, ties, nulls and a long text."""
    rng = np.random.default_rng(5)

    def words(n):
        return " ".join(rng.choice(VOCAB, n))

    passage = words(40)
    texts = [words(rng.integers(1, 80)) for _ in range(40)]
    texts += [texts[0]] * 4 + [texts[5] + " w1", texts[5] + " w2 w3"]
    texts += [words(5) + "\n" + passage + "\t" + words(7) for _ in range(5)]
    texts += ["", "  \n ", None, None, "A b", "a B", "x " * 90, words(6000), passage]
    order = rng.permutation(len(texts))
    out = [(int(i) * 3, texts[int(i)], "en" if i % 2 else None, ["s0", "s1", None][int(i) % 3], None, 1, 0) for i in order]
    return [*out, (None, "lost id here", "en", "s0", 3, 0, 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_sharding(docs, empty, rows):
    got = contiguous = sharding.contiguous_shards(docs, 4).orderBy("shard", "slot").collect()
    assert len(got) == len(rows)
    assert [r.doc_id if r.doc_id is not None else -1 for r in contiguous] == sorted(-1 if r[0] is None else r[0] for r in rows)
    sizes = collections.Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    most = max(r["size"] for r in got)
    assert max(sizes.values()) - sum(sizes.values()) / 4 <= most
    for s in sizes:
        assert [r.slot for r in got if r.shard == s] == list(range(sum(r.shard == s for r in got)))
    assert all(r.text_crc32 == zlib.crc32((t or "").encode()) for r in got for i, t, *_ in rows if i == r.doc_id)
    assert sharding.contiguous_shards(empty).count() == 0


def test_fingerprints(docs, empty, rows):
    got = fingerprints.with_next(docs, rows_per_range=7).collect()
    want = sorted(((r[0] is not None, r[0] or 0, r[1] or "") for r in rows))
    after = {(w[1] if w[0] else None): n[2] for w, n in zip(want, want[1:] + want[:1])}
    assert len(got) == len(rows) and all(r.next_text == after[r.doc_id] for r in got)
    by = collections.defaultdict(set)
    for r in got:
        by[r.text].add(tuple(r.sketch))
        assert r.sketch == sorted(set(r.sketch))
    assert all(len(v) == 1 for v in by.values())
    long = max(got, key=lambda r: len(r.text))
    assert abs(len(long.sketch) / (6000 / fingerprints.ONE_IN) - 1) < 0.2
    assert fingerprints.with_next(empty).count() == 0


def test_many_ranges(spark):
    """More than 500 ranges, which 1,000,000 documents make at the usual size of a range."""
    docs = spark.range(1600).selectExpr("id * 3 as doc_id", "concat('text ', id) as text")
    assert len(common.range_bounds(docs, "doc_id", 2)) > 700
    got = {r.doc_id: r.next_text for r in fingerprints.with_next(docs, rows_per_range=2).collect()}
    assert got == {i * 3: f"text {(i + 1) % 1600}" for i in range(1600)}


def test_fingerprints_of_short_texts(spark):
    texts = [f"a{i} b c d e" for i in range(40)]
    df = spark.createDataFrame([(t, f"{t} f g h") for t in texts], "text string, longer string")
    a, b = ([fingerprints.sketch(F.col(c), one_in=n) for n in (1, 2)] for c in ("text", "longer"))
    got = df.select(*[fingerprints.fingerprint(x).alias(f"f{n}") for n, x in enumerate(a)], *[fingerprints.containment(x, y).alias(f"c{n}") for n, (x, y) in enumerate(zip(a, b, strict=True))]).collect()
    # No text with words is blank at any fraction; the whole range gives exact likeness, half of it finds most.
    assert len({r.f0 for r in got} - {""}) == len({r.f1 for r in got} - {""}) == 40 and all(r.c0 == 1 for r in got)
    assert sum(r.c1 == 1 for r in got) >= 15 and {r.c1 for r in got} <= {0.0, 1.0}


def test_pii(spark, empty):
    text = "é a.b@c.de x 10.0.0.1 y 300.1.1.1 z 4111 1111 1111 1111 +49 (30) 1234-567 w"
    rows = [(1, text), (2, None), (3, ""), (4, "nothing 12 + 3 @ home"), (None, text)]
    rows += [(10 + i, f"{'abcdefgh'[i] * 5} Zephyrus met q@r.st {'hgfedcba'[i] * 4}") for i in range(4)] + [(50 + i, "plain words here") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.sanitised(df).withColumn("m", pii.masked(F.col("text"), F.col("pii_spans"))).collect()}
    spans = [(s.kind, s.start, s.end) for s in got[1].pii_base]
    parts = {"email": "a.b@c.de", "ip": "10.0.0.1", "card": "4111 1111 1111 1111", "phone": "+49 (30) 1234-567"}
    assert spans == [(k, text.index(v), text.index(v) + len(v)) for k, v in parts.items()]
    assert got[1].m == "é [EMAIL] x [IP] y 300.1.1.1 z [CARD] [PHONE] w" == got[None].m
    assert got[2].m is None and got[3].m == "" and got[4].m == "nothing 12 + 3 @ home"
    assert [s.kind for s in got[10].pii_spans] == ["email", "term"] and "Zephyrus" not in got[10].m
    assert pii.sanitised(empty).count() == 0


def test_pii_one_text(spark):
    rows = [(1, "Zephyrus met q@r.st today"), (2, "today we met")] + [(50 + i, "plain words here today") for i in range(900)]
    got = {r.doc_id: r.pii_spans for r in pii.sanitised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.kind, s.start, s.end) for s in got[1]] == [("email", 13, 19), ("term", 0, 8)] and not got[2]


def test_pii_everywhere(spark):
    far = "Zephyrus " + "it is so " * 40 + "q@r.st and zephyrus"
    rows = [(i, f"{'abcde'[i] * 3} {far}") for i in range(5)] + [(9, "é zEphyrus!"), (10, "zephyrusé")] + [(50 + i, "plain words here") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.sanitised(df).withColumn("m", pii.masked(F.col("text"), F.col("pii_spans"))).collect()}
    assert [(s.kind, s.start, s.end) for s in got[0].pii_spans] == [("email", 373, 379), ("term", 4, 12), ("term", 384, 392)]
    assert got[0].m == "aaa Xxxxxxxx " + "it is so " * 40 + "[EMAIL] and "
    assert (got[9].m, got[10].m) == ("é xXxxxxxx!", "zephyrusé") and not got[50].pii_spans


def test_search(docs, empty, rows):
    queries = docs.filter("doc_id % 2 = 0").select(F.col("doc_id").alias("query_id"), "text")
    got = collections.defaultdict(list)
    for r in search.top_documents(docs, queries, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.score)
    tf = [(r[0], collections.Counter(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in split(r[1]))) for r in rows]
    df = collections.Counter(w for _, c in tf for w in c)
    mean = sum(c.total() for _, c in tf) / len(tf)
    for q, c in tf:
        if q is not None and q % 2 == 0:
            scores = [sum(n * np.log1p((len(tf) - df[w] + 0.5) / (df[w] + 0.5)) * d[w] * 2.2 / (d[w] + 1.2 * (0.25 + 0.75 * d.total() / mean)) for w, n in c.items() if w in d) for _, d in tf]
            assert got[q] == pytest.approx([s for s in sorted(scores, reverse=True) if s > 0][:5], rel=1e-5)
    assert search.top_documents(empty, queries.limit(0)).count() == 0


def test_substrings(docs, empty, rows):
    got = {r.doc_id: r for r in substrings.without_repeats(docs).collect()}
    seen, removed = set(), 0
    for i, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0)):
        w = split(text)
        gone = set()
        for k in range(len(w) - 19):
            window = tuple(w[k : k + 20])
            gone |= set(range(k, k + 20)) if window in seen else set()
            seen.add(window)
        removed += len(gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_text) == (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    assert removed and substrings.without_repeats(empty).count() == 0


def test_packing(docs, empty, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    strange = ["a  b\n\n c", " lead", "trail \n", "don't  stop's", "x y 　 z", "12,5% é&&& a$$$"]
    strange += ["".join(chr(c) for c in range(i, i + 64)) for i in [*range(0, 0x3100, 64), 0xFF00, 0x1F600]] + ["x<|endoftext|> y", "a" * 3000, " " * 500 + "z"]
    for encode in (packing.encoder(path), packing._plain(path)):
        assert [encode(t).tolist() for t in strange] == [tok.encode(t, add_special_tokens=False).ids for t in strange]
    assert packing._ranked(json.loads(open(path).read())) is not None
    stored = packing.saved(packing.tokenised(docs, path, capacity=512), "test-pieces")
    out = packing.packed(stored, capacity=512, group_items=16).orderBy("sequence_id", "offset").collect()
    pieces = collections.defaultdict(list)
    ends = collections.Counter()
    for r in out:
        assert r.offset == ends[r.sequence_id] and r.length <= 512
        ends[r.sequence_id] += r.length
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert max(ends.values()) <= 512 and len(ends) <= 1.1 * sum(ends.values()) / 512 + 1
    for i, text, *_ in rows:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        k = -(-len(ids) // 512)
        cuts = [0] + [len(ids) - 512 * (k - 1 - j) for j in range(k)]
        assert sorted(pieces[i]) == [(j, a, b - a, zlib.crc32(ids[a:b].tobytes())) for j, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert packing.packed(packing.saved(packing.tokenised(empty, path), "test-none")).count() == 0


def test_neardup(docs, empty, rows):
    got = {r.doc_id: r for r in neardup.near_duplicates(docs, width=4).collect()}
    sets = {}
    for i, text, *_ in rows:
        w = split(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    least = {i: i for i in sets if i is not None}
    for _ in least:
        for a in least:
            for b in least:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a] = min(least[a], least[b])
    for i in least:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), least[i], least[i] == i)
    assert got[None].component_id is None and got[None].kept and len(set(least.values())) < len(least)
    assert neardup.near_duplicates(empty).count() == 0


def test_classifiers(spark, empty):
    rng = np.random.default_rng(6)
    langs = {"aa": "abcde", "bb": "vwxyz"}
    rows = []
    for i in range(160):
        lang = "aa" if i % 2 else "bb"
        text = " ".join("".join(rng.choice(list(langs[lang]), 5)) for _ in range(20))
        rows.append((i, text.upper() + "!!" if i % 4 < 2 else text, lang, int(i % 4 >= 2)))
    rows += [(1000, None, "aa", None), (1001, "123 !?", "bb", None), (None, "abc abd", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    got = {r.doc_id: r for r in language.predicted(df, language.learned(df)).collect()}
    out = [i for i in range(160) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].lang_pred == ("aa" if i % 2 else "bb") for i in out) and got[1000].lang_pred == got[1001].lang_pred == "und" and got[None].lang_pred == "aa"
    scores = {r.doc_id: r.quality_score for r in quality.scored(df, quality.learned(df.drop("quality"), df.select("doc_id", "quality"))).collect()}
    assert all((scores[i] >= 0.5) == (i % 4 >= 2) for i in range(160) if zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= scores[1000] <= 1
    assert language.predicted(empty, language.learned(empty)).count() == 0
    assert quality.scored(empty, quality.learned(empty, empty.select("doc_id", "quality"))).count() == 0


def test_mixing(spark, empty):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "big" if i < 260 else "small" if i < 290 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    sizes = collections.Counter()
    for i, t, s in rows:
        sizes[s] += len(t.split()) + 1
    taken, seen = collections.Counter(), collections.Counter((r.doc_id, r.epoch) for r in out)
    for r in out:
        taken[r.source] += r.tokens
    assert max(seen.values()) == 1
    budgets = {r.source: r.source_budget for r in out}
    assert all(budgets[s] <= taken[s] < budgets[s] + 8 for s in budgets) and abs(sum(budgets.values()) - sum(sizes.values())) <= 3
    assert budgets["small"] > sizes["small"] and all(budgets[s] <= 4.01 * sizes[s] for s in sizes)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(df).columns == df.columns


def test_pipeline(spark, tmp_path, rows):
    import corpus_pipeline

    good = [(i, t, "en", f"s{i % 3}", len(t or ""), i, f"own{i}", i) for i, t, *_ in rows if i is not None]
    bad = [(5000 + i, " ".join(["NO!!"] * 30 + [f"Q{i}##"] * 9), "en", "s0", 10, 0, "", 0) for i in range(40)]
    # Extra columns whose names the stages use themselves.
    spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string, n_chars long, _row long, pii_base string, Quality_Score long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] < 5000), 0) for r in good + bad], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {r.doc_id for r in out}
    assert kept and all(i < 5000 for i in kept) and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "neardup", "pii", "mix", "pack"]
    assert not kept & {r[0] for r in good if r[1] == next(x[1] for x in good if x[0] == 0) and r[0] != 0}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = packing.saved(stage(spark, docs, str(tmp_path)), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_row", "pii_base", "Quality_Score"]
        assert docs.filter("_row <> doc_id or pii_base <> concat('own', doc_id) or Quality_Score <> doc_id").isEmpty() and not docs.isEmpty()


def test_pipeline_without_labels(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "a few words here", None, None, None), (1, "other words of this id", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 2
