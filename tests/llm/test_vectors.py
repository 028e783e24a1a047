"""Vector codes and hard negatives against brute force on tables with awkward rows."""

import hashlib
import itertools
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.llm import compression, negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, code string, n int"


@pytest.fixture(scope="module")
def rows():
    """Clusters, copies, ties, a frequent vector, repeated ids, nulls, other lengths, great components."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 0.3, (5, 32))
    out = [(i * 3, (centres[i % 5] + rng.normal(0, 0.1, 32)).tolist(), i % 4, "x", 1) for i in range(260)]
    out += [(1000 + i, [0.25] * 32, i % 2, None, 1) for i in range(90)]
    out += [(700, out[0][1], 1, "y", 1), (700, out[4][1], 1, "y", 1), (700, out[0][1], 1, "y", 1), (0, out[9][1], 3, None, 2)]
    out += [(2000, None, 1, None, 1), (2001, [float("nan")] + [0.1] * 31, 1, None, 1), (2002, [float("inf")] * 32, 1, None, 1), (2003, [None] + [0.1] * 31, 2, None, 1)]
    out += [(2050, [0.5] * 16, 1, None, 1), (2100, [], 1, None, 1), (2150, [1e9] * 32, 1, None, 1), (2200, (-centres[0]).tolist(), 2, None, 1), (2250, [0.0] * 32, 2, None, 1)]
    out += [(2300, centres[1].tolist(), None, None, 1), (2350, centres[2].tolist(), 9, None, 1), (None, centres[0].tolist(), 0, None, 1), (None, centres[3].tolist(), None, None, 1)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], *rest) for i, v, *rest in (out[k] for k in rng.permutation(len(out)))]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def integers(v):
    return [math.floor(256 * Fraction(x)) for x in v]


def test_codes_by_brute_force(table, rows):
    kept = [(i, integers(v), label) for i, v, label, *_ in rows if whole(v)]
    fit = [r for r in kept if len(r[1]) == 32 and max(map(abs, r[1])) <= compression.LIMIT]
    first = sorted((r for r in fit if r[0] is not None), key=lambda r: (r[0], r[1]))[: compression.ENTRIES]
    cut = lambda v, p: v[2 * p : 2 * p + 2]
    books = [[cut(v, p) for _, v, _ in first] for p in range(16)]

    def nearest(v, p):
        return min((sum((x - y) ** 2 for x, y in zip(cut(v, p), e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(compression.ROUNDS):
        new = [list(b) for b in books]
        for p in range(16):
            groups = {}
            for _, v, _ in fit:
                groups.setdefault(nearest(v, p)[1], []).append(cut(v, p))
            for k, parts in groups.items():
                new[p][k] = [sum(x) // len(parts) for x in zip(*parts, strict=True)]
        books = new
    made = compression.trained(table)
    assert made.tolist() == books
    want = []
    for i, v, label in kept:
        if len(v) != 32 or max(map(abs, v)) > compression.LIMIT:
            want.append((i, label, None, None))
        else:
            found = [nearest(v, p) for p in range(16)]
            want.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    got = [tuple(r) for r in compression.compressed(table, made).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and None in {i for i, *_ in got}
    assert compression.digest(made) == hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_codes_as_a_query(spark, table, rows, tmp_path):
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.QUERIES["op11_vector_codes"](spark, str(tmp_path)).collect()
    assert len(got) == sum(whole(v) for _, v, *_ in rows) and len({r.codebooks_sha256 for r in got}) == 1
    labels = {}
    for i, v, label, *_ in rows:
        if whole(v):
            labels.setdefault(label, set()).add(i)
    for label, ids in labels.items():
        assert sum(r.error or 0 for r in got if r.vec_id in ids and r.vec_id not in (0, 700, None)) <= next(r.label_error for r in got if r.vec_id in ids and r.vec_id not in (0, 700)) if label is not None else True
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    for name in ("op11_vector_codes", "op12_hard_negatives"):
        assert queries.QUERIES[name](spark, f"{tmp_path}/none").count() == 0


def test_bounds_drop_no_nearest_entry():
    rng = np.random.default_rng(1)
    for width, scale in ((1, 5), (3, 40), (4, 3), (16, 300), (5, compression.LIMIT)):
        entries, x = rng.integers(-scale, scale + 1, (64, width)), rng.integers(-scale, scale + 1, (500, width))
        entries[7] = entries[3]
        book = compression.Codebook(entries)
        code, error = book.assign(x)
        d = ((x[:, None] - entries) ** 2).sum(axis=2)
        assert (code == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()
        assert book.exact < book.tried


def mined(rows, every=50, k=5, n=3):
    kept = [(i, label, integers(v)) for i, v, label, *_ in rows if whole(v) and None not in (i, label) and len(v) == 32 and max(map(abs, integers(v))) <= negatives.LIMIT]
    out = []
    for a, (anchor, label, q) in enumerate(kept):
        if anchor % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v, strict=True)), i, b) for b, (i, _, v) in enumerate(kept) if b != a))
        for s, positive, _ in [r for r in scored if kept[r[2]][1] == label][:k]:
            fit = [(t, i) for t, i, b in scored if kept[b][1] != label and 50 * -s <= 100 * -t <= 95 * -s][:n]
            out += [(anchor, positive, rank, i, -s, -t) for rank, (t, i) in enumerate(fit, 1)]
    return out


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_negatives_by_brute_force(table, rows, shard_rows):
    got = negatives.hard_negatives(table, shard_rows=shard_rows).collect()
    want = mined(rows)
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 50 and any(r[0] == 700 for r in want)
    assert negatives.hard_negatives(table, every=7, positives=2, negatives=9, shard_rows=shard_rows).count() == len(mined(rows, 7, 2, 9))


def test_negatives_query_changes_labels(spark, table, rows, tmp_path):
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, v, (label + 1) % 10 if i is not None and i % 7 == 0 and label is not None else label) for i, v, label, *_ in rows]
    assert sorted(map(tuple, queries.QUERIES["op12_hard_negatives"](spark, str(tmp_path)).collect())) == sorted(mined(moved))


def test_annuli_skip_blocks_and_stay_exact():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 100, (20, 8))
    x = np.rint(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 3, (4000, 8))).astype(np.int64)
    sphere = negatives.Sphere(x[:20], int((x * x).sum(axis=1).max()))
    import pandas as pd

    rows = pd.DataFrame({"row": np.arange(4000), "vec_id": np.arange(4000), "label": np.arange(4000) % 3, "v": list(x)})
    keyed = pd.concat(negatives._keys(sphere, False)([rows])).sort_values(["pivot", "distance", "vec_id"])
    shard = negatives.Shard(sphere, keyed)
    for a in range(0, 4000, 100):
        scores = x @ x[a]
        for same, low, high in ((True, -math.inf, math.inf), (False, scores.max() // 2, scores.max() * 95 // 100), (False, -math.inf, 0)):
            ok = [(-s, i) for i, s in enumerate(scores.tolist()) if (i % 3 == a % 3) == same and i != a and low <= s <= high]
            window, ids, found = shard.search(a, a % 3, x[a].astype(float), np.array([low]), np.array([high]), 5, same)
            assert list(zip((-found).tolist(), ids.tolist(), strict=True)) == sorted(ok)[:5] and not window.any()
    assert shard.skipped > shard.seen


def test_types_of_results(spark, table):
    assert dict(negatives.hard_negatives(table).dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    doubles = table.select("vec_id", F.col("embedding").cast("array<double>"), F.col("label").cast("long"))
    same = itertools.chain(compression.compressed(doubles, compression.trained(doubles)).collect())
    assert sorted((tuple(r) for r in same), key=repr) == sorted((tuple(r) for r in compression.compressed(table, compression.trained(table)).collect()), key=repr)
