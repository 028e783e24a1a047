"""Fingerprints and components of near ones against brute force."""

import collections
import itertools
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chatloom.llm import queries, simhash

SCHEMA = "doc_id long, text string, fingerprint string, component_id long"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least(rows, near):
    """The smallest id reachable, by merging every two rows that are near or share an id."""
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if near(rows[i], rows[j]):
            up[top(i)] = top(j)
    found = collections.defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            found[top(i)].append(r[0])
    return [min(found[top(i)], default=None) for i in range(len(rows))]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    words = [f"Word{i}" for i in range(400)] + ["É", "💛"]
    texts = [rng.choice(words, n).tolist() for n in [*rng.integers(1, 90, 60), 8000]]
    out = [" ".join(t) for t in texts]
    for t in texts[20:40]:  # long copies with a few other words
        for k in range(4):
            u = t * 6
            u[rng.integers(len(u))] = f"new{k}"
            out.append("\t".join(u))
    out += [out[3]] * 5 + ["", None, " \n ", "one", "ONE", "one two", "one\x0btwo", "a b c a b c a b c"]
    ids = rng.permutation(len(out)).tolist()
    return [*((int(i) * 2, t, "own", 1) for i, t in zip(ids, out, strict=True)), (ids[0] * 2, "other text of an id", "own", 1), (None, "lost", "own", 1), (None, out[3], "own", 1), (None, "lost", "own", 1)]


def test_components_by_brute_force(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_simhash"](spark, str(tmp_path)).collect()
    marked = [(r[0], plain(r[1])) for r in rows]
    want = least(marked, lambda a, b: (a[1] ^ b[1]).bit_count() <= 2 or a[0] is not None and a[0] == b[0])
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, f"{f:016x}", c)) for (i, f), c in zip(marked, want, strict=True))
    links = sum(1 for a, b in itertools.combinations({f for _, f in marked}, 2) if (a ^ b).bit_count() <= 2)
    assert links > 10 and None in want


def test_every_two_bits_are_left_out_together():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(list(range(64)), radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for some in itertools.combinations(range(64), radius):
            assert any(not any(m >> b & 1 for b in some) for m in masks)
    for m in simhash.covering_masks(list(range(64))):
        finer = simhash.finer_masks(m)
        assert all(x & m == m and x != m for x in finer)
        free = [b for b in range(64) if not m >> b & 1]
        assert all(any(not any(x >> b & 1 for b in two) for x in finer) for two in itertools.combinations(free, 2))


def test_spark_hashes_alike(spark):
    texts = ["a b c", "", "é 💛 x", "x" * 100]
    got = [r[0] % 2**64 for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]
    assert got == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


@pytest.mark.parametrize("bucket", [1, 16, 512])
def test_large_buckets_are_covered_again(spark, bucket):
    """A dense ball and a chain: every two-step neighbour of one number, and steps of two bits."""
    ball = {5 ^ (1 << a) ^ (1 << b) for a in range(24) for b in range(24)}
    chain = {(1 << 40) + (3 << 2 * k) - 3 + (1 << 60) for k in range(15)}
    far = {0xF0F0F0F0F0F0F0F0 ^ (0x1111 << k) for k in range(0, 40, 7)}
    rows = [(x - (1 << 64) if x >> 63 else x,) for x in sorted(ball | chain | far)]
    links = simhash.near_links(spark.createDataFrame(rows, "fingerprint long"), bucket=bucket).collect()
    got = [(r.a, r.b) for r in links]
    assert all((a ^ b).bit_count() <= 2 if (a ^ b) >= 0 else False for a, b in got)
    up = {r[0]: r[0] for r in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in got:
        up[top(a)] = top(b)
    want = least([(r[0] % 2**64, r[0] % 2**64) for r in rows], lambda a, b: (a[1] ^ b[1]).bit_count() <= 2)
    groups = collections.defaultdict(set)
    for r, c in zip(rows, want, strict=True):
        groups[top(r[0])].add(c)
    assert len({top(r[0]) for r in rows}) == len(set(want)) and all(len(g) == 1 for g in groups.values())


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
