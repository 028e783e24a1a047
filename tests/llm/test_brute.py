"""The training-data operators recomputed plainly, and every query called on a small table."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.llm import fingerprints, language, mixing, neardup, pii, quality, queries, search, sharding, substrings

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    """Two languages, good and bad texts, copies, near copies, a shared passage, identifiers, nulls."""
    rng = np.random.default_rng(8)
    words = {"aa": [f"{x}{y}ka" for x in "abcdefgh" for y in "aeiou"], "bb": [f"{x}{y}zu" for x in "rstvwx" for y in "aeiou"]}
    out = []
    for i in range(160):
        lang = "aa" if i % 2 else "bb"
        text = " ".join(rng.choice(words[lang], rng.integers(12, 70)))
        if i % 5 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split()) + " ### 12"
        if i % 9 == 0:
            text += f" mail Person{i}name{'xyz'[i % 3]} at user{i}@site.example or +49 30 1234{i:04d} "
        out.append((i, text, lang, f"s{0 if i < 90 else i % 4}", len(text)))
    passage = " ".join(rng.choice(words["aa"], 40))
    for i in range(160, 170):
        text = passage + (f" extra{i} words{i}" if i % 2 else "")
        out.append((i, text, "aa", "s1", len(text)))
    out += [(170, None, "aa", None, None), (171, "", None, "s2", 0), (172, "12 34 !!", "bb", "s2", 8), (173, "aaka " * 400, "aa", "s3", 2000)]
    return out


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] % 5 != 0), 0) for r in rows if r[0] % 7], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    vectors = np.random.default_rng(3).normal(0, 0.2, (150, 32)).astype(np.float32)
    kept = [(i, v.tolist(), None if i % 40 == 3 else i % 3) for i, v in enumerate(vectors)] + [(500, None, 1), (550, [float("nan")] * 32, 1), (600, [None] + [0.5] * 31, 2), (650, [float("inf")] * 32, None)]
    spark.createDataFrame(kept, "vec_id long, embedding array<float>, label int").repartition(2).write.parquet(f"{path}/embeddings.parquet")
    return path


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_op1(spark, folder, rows):
    got = queries.QUERIES["op1_mixing"](spark, folder).collect()
    sizes = collections.Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(split(t)) + 1
    total, n = sum(sizes.values()), len(sizes)
    p = np.array([v / total for v in sizes.values()])
    target = (h := -(p * np.log(p)).sum()) + mixing.ENTROPY_SHARE * (math.log(n) - h)

    def weights(a):
        return p**a / (p**a).sum()

    # By plain bisection: the greatest exponent that reaches the entropy, or the limit's if that is greater.
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        w = weights(mid)
        lo, hi = (mid, hi) if -(w * np.log(w)).sum() >= target else (lo, mid)
    if (weights(lo) / p).max() > mixing.MOST_EPOCHS:
        lo, hi = lo, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if (weights(mid) / p).max() <= mixing.MOST_EPOCHS else (mid, hi)
    want = dict(zip(sizes, weights(lo), strict=True))
    seen = {r.source: (r.weight, r.source_budget) for r in got}
    assert set(seen) == set(want)
    for s, (w, budget) in seen.items():
        assert w == pytest.approx(want[s], abs=1e-6) and budget == round(w * total)
    # Each source: epoch after epoch without a gap, every document once an epoch, cut at its budget.
    for s, budget in ((s, b) for s, (_, b) in seen.items()):
        mine = sorted((r for r in got if r.source == s), key=lambda r: r.place)
        at = 0
        for r in mine:
            assert r.place == pytest.approx((at + 0.5) / budget)
            at += r.tokens
        assert budget <= at < budget + max(r.tokens for r in mine)
        epochs = collections.Counter(r.epoch for r in mine)
        docs = sum(1 for r in rows if r[3] == s)
        assert [epochs[e] for e in sorted(epochs)][:-1] == [docs] * (len(epochs) - 1) and [r.epoch for r in mine] == sorted(r.epoch for r in mine)
        assert max(collections.Counter((r.doc_id, r.epoch) for r in mine).values()) == 1
    order = sorted(got, key=lambda r: (r.stretch, r.slot))
    assert [r.slot for r in order] == [i for _, g in itertools.groupby(order, key=lambda r: r.stretch) for i, _ in enumerate(g)]


def test_op2(spark, folder, rows):
    got = {r.doc_id: r for r in queries.QUERIES["op2_fingerprints"](spark, folder).collect()}
    texts = [(r[0], r[1] or "") for r in sorted(rows)]

    def grams(t):
        w = split(t)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    # Hashes from Spark itself, one shingle a row; which are kept is decided here.
    edited = {i: (t, t[: len(t) - len(t) // 2] + after[: len(t) // 2], after) for (i, t), (_, after) in zip(texts, texts[1:] + texts[:1], strict=True)}
    every = sorted({g for ts in edited.values() for t in ts for g in grams(t)})
    columns = [F.col(f"w{k}") for k in range(5)]
    table = spark.createDataFrame([tuple(g) + (None,) * (5 - len(g)) for g in every], ", ".join(f"w{k} string" for k in range(5)))
    hashed = {tuple(x for x in r[:5] if x is not None): r[5] for r in table.select(*columns, F.xxhash64(*columns)).collect()}

    def kept(t):
        h = sorted(hashed[g] for g in grams(t))
        low = [x for x in h if (x + 2**63) < 2**64 // fingerprints.ONE_IN]
        return low or h[:1]

    def like(a, b):
        return 1.0 if not a and not b else 0.0 if not a or not b else len(set(a) & set(b)) / min(len(a), len(b))

    for i, (t, e, after) in edited.items():
        r, a, b = got[i], kept(t), kept(e)
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == tuple(",".join(f"{x % 2**64:x}" for x in s) for s in (a, b))
        assert (r.near_edited, r.near_next) == (pytest.approx(like(a, b)), pytest.approx(like(a, kept(after))))
    parts = spark.createDataFrame([("a b c d e f",), ("c d e f g h",)], "t string").select(fingerprints.sketch(F.col("t")).alias("s"))
    whole = sorted(set(itertools.chain(*(r.s for r in parts.collect()))))
    low = [x for x in whole if x + 2**63 < 2**63] or whole[:1]
    assert parts.agg(fingerprints.merged(F.col("s"))).first()[0] == low


def naive_base(text):
    def luhn(d):
        return sum(x if k % 2 == 0 else (2 * x - 9 if 2 * x > 9 else 2 * x) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0

    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(d := re.sub("[^0-9]", "", v)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(re.sub("[^0-9]", "", v)) <= 15),
    }
    return [(k, m.start(), m.end(), m[0]) for k, (p, ok) in kinds.items() for m in re.finditer(p, text) if ok(m[0])]


def naive_terms(docs):
    """Terms over the thresholds, from every entity and every term of every document."""
    n_t, n_e, n_te, texts = collections.Counter(), collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for text in docs:
        base = naive_base(text)
        free = list(text)
        for _, lo, hi, _ in base:
            free[lo:hi] = " " * (hi - lo)
        terms = {w.lower() for w in re.findall(r"[^\W\d_]{4,}", "".join(free))}
        entities = {f"{k}:{re.sub('[^0-9]', '', v) if k in ('card', 'phone') else v.lower()}" for k, _, _, v in base}
        n_t.update(terms)
        n_e.update(entities)
        for pair in itertools.product(terms, entities):
            n_te[pair] += 1
            texts[pair].add(text)
    out = set()
    for (t, e), both in n_te.items():
        p, q = both / n_t[t], n_e[e] / len(docs)
        bits = math.log2(p / q)
        sure = len(texts[t, e]) * (bits + ((1 - p) / p * math.log2((1 - p) / (1 - q)) if p < 1 and q < 1 else 0))
        if p >= pii.MIN_P and bits >= pii.MIN_BITS and sure >= pii.MIN_SURE:
            out.add(t)
    return out


def test_op3(spark, folder, rows):
    extra = [(1000 + i, f"Zephyrus wrote q@r.st and quorum{i} too" if i < 3 else f"plain words number {i} here") for i in range(700)]
    extra += [(1800, "a lone zephyrus, " + "4111 1111-1111 1111 "), (1801, "Gondola solo one@two.three " * 3), (1802, "Gondola solo one@two.three " * 3)]
    docs = [(r[0], r[1]) for r in rows] + extra
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.sanitised(df).withColumn("m", pii.masked(F.col("text"), F.col("pii_spans"))).collect()}
    terms = naive_terms([t or "" for _, t in docs])
    assert {"zephyrus", "gondola", "solo", "wrote"} <= terms
    for i, text in docs:
        base = naive_base(text or "")
        free = list(text or "")
        for _, lo, hi, _ in base:
            free[lo:hi] = " " * (hi - lo)
        more = [("term", m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{4,}", "".join(free)) if m[0].lower() in terms]
        spans = [(s.kind, s.start, s.end) for s in got[i].pii_spans]
        assert spans == [b[:3] for b in base] + more
        out, at = "", 0
        for lo, end, kind in sorted((s, e, k) for k, s, e in spans):
            if lo >= at:
                word = text[lo:end]
                out += text[at:lo] + (f"[{kind.upper()}]" if kind != "term" else re.sub("[a-z]", "x", re.sub("[A-Z]", "X", word)) if re.search("[A-Z]", word) else "")
            at = max(at, end)
        assert got[i].m == (None if text is None else out + text[at:])
    query = {r.doc_id: r for r in queries.QUERIES["op3_pii"](spark, folder).collect()}
    for i, text, *_ in rows:
        base = naive_base(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in base)
        assert query[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and query[i].spans.startswith(joined)
        assert [query[i][f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]


def test_op3_many_identifiers_in_one_text(spark):
    text = " ".join(f"word{'abcdefghij'[i % 10]} u{i}@x{i}.yz 💛" for i in range(4000))
    df = spark.createDataFrame([(1, text), (2, "x" * 3000)], "doc_id long, text string")
    got = pii.sanitised(df).withColumn("m", pii.masked(F.col("text"), F.col("pii_spans"))).orderBy("doc_id").collect()
    assert [(s.start, s.end) for s in got[0].pii_spans] == [b[1:3] for b in naive_base(text)]
    assert got[0].m == " ".join(f"word{'abcdefghij'[i % 10]} [EMAIL] 💛" for i in range(4000)) and got[1].m == "x" * 3000


def bm25(docs, queries_, k):
    """Best k of every query, over all documents."""
    tf = [(i, collections.Counter(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in split(t))) for i, t in docs]
    df = collections.Counter(w for _, c in tf for w in c)
    mean, n, out = sum(c.total() for _, c in tf) / len(tf), len(tf), {}
    for q, t in queries_:
        asked = collections.Counter(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in split(t))
        scores = []
        for i, d in tf:
            s = sum(c * math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * d[w] * 2.2 / (d[w] + 1.2 * (0.25 + 0.75 * d.total() / mean)) for w, c in asked.items() if w in d)
            if s > 0:
                scores.append((-round(s, 6), i))
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_op4(spark, folder, rows):
    docs = [(r[0], r[1]) for r in rows]
    want = bm25(docs, [d for d in docs if d[0] % 20 == 0], search.TOP)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    asked = df.filter("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    for got in (queries.QUERIES["op4_search"](spark, folder), search.top_documents(df, asked, shard_docs=25)):
        found = collections.defaultdict(list)
        for r in got.orderBy("query_id", "rank").collect():
            found[r.query_id].append((r.doc_id, r.score))
        assert set(found) == {q for q, hits in want.items() if hits}
        for q, hits in found.items():
            assert [s for _, s in hits] == pytest.approx([s for _, s in want[q]], abs=2e-5)
            assert [i for i, _ in hits] == [i for i, _ in want[q]]
    twice = spark.createDataFrame([(1, "aaka baka"), (1, "aaka baka"), (1, "razu sazu"), (None, "aaka")], "query_id long, text string")
    assert {r["count"] for r in search.top_documents(df, twice, 3).groupBy("query_id", "query_key").count().collect()} == {3}


def test_op4_ranks_copies_by_id_in_all_shards(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice([f"c{i}" for i in range(200)], rng.integers(20, 60))) for _ in range(40)]
    docs = [(i * 20, t) for i, t in enumerate(texts * 6)] + [(20 * i + 7, " ".join(rng.choice([f"c{i}" for i in range(200)], 30))) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = df.filter("doc_id < 800 and doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    want = bm25(docs, [d for d in docs if d[0] < 800 and d[0] % 20 == 0], search.TOP)
    for shard_docs in (10_000, 90):
        got = collections.defaultdict(list)
        for r in search.top_documents(df, asked, shard_docs=shard_docs).orderBy("query_id", "rank").collect():
            got[r.query_id].append(r.doc_id)
        assert len(got) == 40 and all(ids[:6] == [q + 800 * k for k in range(6)] and ids == [i for i, _ in want[q]] for q, ids in got.items())


def test_op4_skips_blocks():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice([f"c{i}" for i in range(30)], 20)) + (" rare twin" if i % 500 == 7 else "") for i in range(4000)]
    index = search.Index(texts, 20.0)
    term, count = search._terms(["rare twin c1"])[1:]
    doc, score = index.top(term, count * np.array([5.0 if t in search._terms(["rare twin"])[1] else 0.1 for t in term]), 5)
    assert len(doc) == 5 and all("rare" in texts[d] for d in doc) and index.skipped > 0.5 * index.blocks


def test_op4_deals_each_part_of_a_shard_to_its_own_task(spark):
    rows = spark.range(12 * 2 * 3).select((F.col("id") % 12 + 12).cast("int").alias("shard"), (F.col("id") / 12 % 2).cast("int").alias("part"), F.lit(0).alias("kind"), "id")
    dealt = search._tasks(rows, 12, 24, 2).groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("shard", "part").alias("n")).collect()
    assert len(dealt) == 24 and {r.n for r in dealt} == {1}


def test_op4_finds_terms_and_sums_their_postings():
    """Queries that share steps, with terms that no document has or without any, rank as one by one."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice([f"c{i}" for i in range(400)], 30)) for _ in range(700)]
    index, asked = search.Index(texts, 30.0), []
    for text in (*texts[:5], "nowhere c1 c2", "nowhere", "c3"):
        term, count = search._terms([text])[1:]
        asked.append((index.find(term), count * 1.5))
    for (doc, score), one in zip(index.top_many(asked, 7), asked, strict=True):
        alone = index.top_many([one], 7)[0]
        assert doc.tolist() == alone[0].tolist() and score.tolist() == alone[1].tolist()
        assert len(doc) == (0 if (one[0] < 0).all() else 7)
    assert search.Index([], 1.0).find(np.array([1, 2])).tolist() == [-1, -1]


def test_samples_are_bounded_rows_of_one_id(spark, monkeypatch):
    """20,000 texts of one id, each twice, bring no more rows to the driver than a sample holds."""
    brought, one = [], next(i for i in range(99) if zlib.crc32(str(i).encode()) % 4 != 2 and zlib.crc32(str(i).encode()) % 3 != 1)
    for module in (language, quality):
        monkeypatch.setattr(module, "fit", lambda rows: brought.append(len(rows)))
    many = spark.range(40_000).select(F.lit(one).cast("long").alias("doc_id"), F.concat(F.lit("word "), (F.col("id") % 20_000).cast("string")).alias("text"), F.lit("aa").alias("lang"))
    language.learned(many)
    quality.learned(many, spark.createDataFrame([(one, 1)], "doc_id long, quality int"))
    assert brought == [language.SAMPLE, quality.SAMPLE]


def test_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGS", 3)
    rows = [(i, f"{'abcdefgh'[i % 8] * 3} text", f"l{min(i % 8, 5)}") for i in range(400)]
    used = collections.Counter(r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2)
    most = sorted(used, key=lambda g: (-used[g], g))[:3]
    assert language.learned(spark.createDataFrame(rows, "doc_id long, text string, lang string")).langs == sorted(most)


def test_op8(spark, folder, rows):
    got = {r.doc_id: r for r in queries.QUERIES["op8_language"](spark, folder).collect()}
    assert all(got[r[0]].held_out == (zlib.crc32(str(r[0]).encode()) % 4 == 2) for r in rows)
    assert got[170].lang_pred == got[171].lang_pred == got[172].lang_pred == "und"
    right = [got[r[0]].lang_pred == r[2] for r in rows if r[0] < 160 and got[r[0]].held_out]
    assert len(right) > 20 and all(right)

    assert [language.has_letter(t) for t in ("½ 12", "²", "Ⅷ 3", "_", None, "", "² é", "字", "½x")] == [False] * 6 + [True] * 3

    # The learner, one coordinate at a time.
    rng = np.random.default_rng(2)
    sample = [{"doc_id": i, "lang": "ab"[i % 2], "columns": np.sort(rng.choice(30, 6, replace=False)) + (20 if i % 2 else 0), "counts": rng.integers(1, 4, 6)} for i in range(80)]
    model = language.fit(sample)
    order = np.random.default_rng(language.SEED)
    df = collections.Counter(int(c) for r in sample for c in r["columns"])
    idf = {c: math.log(81 / (1 + df[c])) + 1 for c in df}
    shuffled = order.permutation(80)
    train = sorted(set(shuffled.tolist()) - set(shuffled[:: language.CALIBRATES].tolist()))
    z, n, zb, nb = collections.Counter(), collections.Counter(), [0.0, 0.0], [0.0, 0.0]
    al, be, l1, l2 = language.ALPHA, language.BETA, language.L1, language.L2

    def weight(c, k):
        v = z[c, k]
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((be + math.sqrt(n[c, k])) / al + l2)

    for _ in range(language.EPOCHS):
        for i in order.permutation(train):
            r = sample[i]
            x = {int(c): v / sum(r["counts"]) * idf[int(c)] * language.SCALE for c, v in zip(r["columns"], r["counts"], strict=True)}
            w = {(c, k): weight(c, k) for c in x for k in (0, 1)}
            b = [-zb[k] / ((be + math.sqrt(nb[k])) / al) for k in (0, 1)]
            s = [sum(x[c] * w[c, k] for c in x) + b[k] for k in (0, 1)]
            e = [math.exp(v - max(s)) for v in s]
            for k in (0, 1):
                g = e[k] / sum(e) - (k == "ab".index(r["lang"]))
                for c in x:
                    d = g * x[c]
                    z[c, k] += d - (math.sqrt(n[c, k] + d * d) - math.sqrt(n[c, k])) / al * w[c, k]
                    n[c, k] += d * d
                zb[k] += g - (math.sqrt(nb[k] + g * g) - math.sqrt(nb[k])) / al * b[k]
                nb[k] += g * g
    for c in df:
        for k in (0, 1):
            assert model.table[c, k] == pytest.approx(weight(c, k) * idf[c] * language.SCALE, abs=1e-4)


def test_op9(spark, folder, rows):
    got = queries.QUERIES["op9_sharding"](spark, folder).collect()
    sizes = {r[0]: len((r[1] or "").encode()) + 1 for r in rows}
    total, before, want, slots = sum(sizes.values()), 0, {}, collections.Counter()
    for i in sorted(sizes):
        shard = min(7, (2 * before + sizes[i]) * 8 // (2 * total))
        want[i] = (sizes[i], zlib.crc32((dict((r[0], r[1]) for r in rows)[i] or "").encode()), "bytes", shard, slots[shard], None)
        slots[shard] += 1
        before += sizes[i]
    assert {r.doc_id: (r["size"], r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) for r in got} == want
    small = sharding.contiguous_shards(spark.createDataFrame([(i % 3, "x" * (i % 4)) for i in range(20)], "doc_id long, text string"), 3)
    assert small.count() == 20 and small.groupBy("shard").agg((F.max("slot") - F.count("slot")).alias("d")).select("d").distinct().collect() == [(-1,)]


def test_op10(spark, folder, rows):
    got = {r.doc_id: r for r in queries.QUERIES["op10_quality"](spark, folder).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values()) and len(got) == len(rows)
    held = [got[r[0]].predicted == (r[0] % 5 != 0) for r in rows if r[0] < 160 and zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert len(held) > 30 and all(held) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())

    # Scores by the sum over all pairs of inputs.
    rng = np.random.default_rng(4)
    m = quality.Machine(0.1, rng.normal(0, 1, quality.STATS + quality.WORDS), rng.normal(0, 1, (quality.STATS + quality.WORDS, quality.FACTORS)), rng.normal(0, 1, quality.STATS), np.full(quality.STATS, 2.0))
    texts = ["a b c a", "", None, "Ünï 12 !!", "one two three two one zero"]
    row, column, value, stats = quality._inputs(texts)
    for i, score in enumerate(m.scores(texts)):
        x = {k: v for k, v in enumerate(np.clip((stats[i] - m.mean) / m.scale, -4, 4) / math.sqrt(quality.STATS))}
        x |= {int(c) + quality.STATS: v for r, c, v in zip(row, column, value, strict=True) if r == i}
        z = m.w0 + sum(m.w[k] * v for k, v in x.items()) + sum(float(m.v[j] @ m.v[k]) * x[j] * x[k] for j, k in itertools.combinations(x, 2))
        assert score == pytest.approx(1 / (1 + math.exp(-min(max(z, -30), 30))), abs=1e-9)


def test_op10_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    for labels, want in (([], 0.5), ([(1, None)], 0.5), ([(9, 1), (9, 0)], 0.5)):
        known = spark.createDataFrame(labels, "doc_id long, quality int")
        assert [r.quality_score for r in quality.scored(docs, quality.learned(docs, known)).collect()] == [want, want]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    found = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, folder).select(*found.columns).collect()
    assert got and sorted(map(repr, map(tuple, got))) == sorted(map(repr, found.fetchall()))


def test_op6(spark, folder, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = queries.QUERIES["op6_packing"](spark, folder).collect()
    texts, bins = {r[0]: r[1] or "" for r in rows}, collections.defaultdict(list)
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        ids = np.array(tok.encode(texts[r.doc_id], add_special_tokens=False).ids + [0], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(parts))]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 2048) + 1


@pytest.mark.parametrize("block", [8, 1024])
def test_near_duplicates_about_the_threshold(spark, monkeypatch, block):
    """Variants of a few texts whose likeness lies around the threshold, ids with several texts, copies."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = np.random.default_rng(9)
    vocab = [f"v{i}" for i in range(500)]
    texts = []
    for _ in range(3):
        base = list(rng.choice(vocab, 90))
        for _ in range(45):
            w = list(base)
            for at in rng.choice(90, rng.integers(0, 5), replace=False):
                w[at] = str(rng.choice(vocab))
            texts.append((int(rng.integers(0, 120)), " ".join(w)))
    texts += texts[:5] + [(500 + i, " ".join(rng.choice(vocab, 60))) for i in range(5)]

    def grams(t):
        w = t.split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))

    sets = [(i, grams(t)) for i, t in texts]
    least = {i: i for i, _ in texts}
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if 100 * len(x & y) >= 80 * len(x | y)]
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    got = neardup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == len(texts) and {r.doc_id: r.component_id for r in got} == least
    assert 8 < len(set(least.values())) < len(least)


def test_substrings_of_one_id_twice(spark):
    """Two texts of one id hold the same run at the same place: both lose it to an earlier document, neither to the other."""
    run = " ".join(f"r{i}" for i in range(25))
    for parts in (1, 5):
        rows = spark.createDataFrame([(5, run + " a"), (5, run + " b"), (7, run + " c"), (9, run), (9, run + " d")], "doc_id long, text string").repartition(parts)
        got = sorted((r.doc_id, r.n_removed) for r in substrings.without_repeats(rows).collect())
        assert got == [(5, 0), (5, 0), (7, 25), (9, 25), (9, 25)]


def test_pipeline_stages_plainly(spark, tmp_path):
    """Each stage against a plain version of it on its own input: rejected, near, personal, mixed and packed documents."""
    import corpus_pipeline
    import public_tokenizers
    import tokenizers

    rng = np.random.default_rng(12)
    words = [f"{a}{b}ka" for a in "bcdfghklm" for b in "aeiou"]
    good = [" ".join(rng.choice(words, 60)) for _ in range(40)]
    near = [" ".join([*t.split()[:59], "ending"]) for t in good[:6]]
    private = [f"Waldemar wrote q@r.st and {' '.join(rng.choice(words, 30))}" for _ in range(4)] + [f"call +49 30 123456{i} {' '.join(rng.choice(words, 30))} Waldemar" for i in range(3)]
    texts = good + near + good[:3] + private + ["short one", " ".join(rng.choice(words, 9000))]
    bad = [" ".join(["NO!!"] * 30 + [f"Q{i}##"] * 9) for i in range(30)]
    rows = [(i * 7 % 600, t, "aa", f"s{i % 3}", len(t)) for i, t in enumerate(texts + bad)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[1] not in bad), 0) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()

    assert {r.text for r in seen["quality"]} == set(texts)
    # Near documents: all pairs, the smallest id of those that hang together.
    sets = {r.doc_id: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for r in seen["quality"] if (w := r.text.lower().split())}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            up[max(top(a), top(b))] = min(top(a), top(b))
    assert sorted(r.doc_id for r in seen["neardup"]) == sorted({top(i) for i in up}) and len(seen["neardup"]) < len(texts)
    # Personal data: every span of every text, by its definition.
    terms, want = naive_terms([r.text for r in seen["neardup"]]), {}
    for r in seen["neardup"]:
        base, free = naive_base(r.text), list(r.text)
        for _, lo, hi, _ in base:
            free[lo:hi] = " " * (hi - lo)
        spans = [b[:3] for b in base] + [("term", m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{4,}", "".join(free)) if m[0].lower() in terms]
        text, at = "", 0
        for lo, end, kind in sorted((s, e, k) for k, s, e in spans):
            if lo >= at:
                word = r.text[lo:end]
                text += r.text[at:lo] + (f"[{kind.upper()}]" if kind != "term" else re.sub("[a-z]", "x", re.sub("[A-Z]", "X", word)) if re.search("[A-Z]", word) else "")
            at = max(at, end)
        want[r.doc_id] = text + r.text[at:]
    assert {r.doc_id: r.text for r in seen["pii"]} == want and all(r.n_chars == len(r.text) for r in seen["pii"]) and "[EMAIL]" in "".join(want.values())
    # Mixing: whole rounds of a source's documents and the start of one more, nothing else.
    given = {r.doc_id: tuple(r) for r in seen["pii"]}
    times = collections.Counter(r.doc_id for r in seen["mix"])
    assert all(tuple(r) == given[r.doc_id] for r in seen["mix"])
    for source in ("s0", "s1", "s2"):
        counts = {times[i] for i, r in given.items() if r[3] == source}
        assert max(counts) - min(counts) <= 1 and max(counts) >= 1
    # Packing: every token once, no sequence over its length, none that another could hold.
    tokens = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    length = {r.doc_id: len(tokens.encode(r.text, add_special_tokens=False).ids) + 1 for r in seen["mix"]}
    total, filled = collections.Counter(), collections.defaultdict(list)
    for r in seen["pack"]:
        total[r.doc_id] += r["length"]
        filled[r.sequence_id].append((r.offset, r["length"]))
    assert total == {i: n * times[i] for i, n in length.items()}
    for places in filled.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048
    left = sorted(2048 - sum(n for _, n in places) for places in filled.values())
    assert all(2048 - x > y for x, y in itertools.combinations(left, 2)) or len(filled) <= -(-sum(total.values()) // 2048) + 1


def test_op4_postings_come_with_their_parts():
    """A term's postings are its documents, and their parts of BM25 times the term's value."""
    texts = ["ab cd", None, "cd cd ef gh", "", "ef"] * 3
    index, mean = search.Index(texts, 2.0), 2.0
    for word in ("ab", "cd", "ef"):
        _, term, _ = search._terms([word])
        doc, value = index._postings(index.find(term), np.array([3.0]))
        said = {i: t.split() for i, t in enumerate(texts) if t and word in t.split()}
        want = {i: np.float32(t.count(word) * 2.2 / (t.count(word) + 1.2 * (0.25 + 0.75 * len(t) / mean))) * 3.0 for i, t in said.items()}
        assert dict(zip(index.own[doc].tolist(), value.tolist(), strict=True)) == pytest.approx(want, rel=1e-6)
