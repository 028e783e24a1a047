"""MinHash near-dedup: banded candidates, odd sketches, exact links, connected components.

Two documents are linked when their sets of word shingles have a Jaccard similarity of at
least ``MIN_PERCENT`` / 100. Exact copies of a set are one vertex. For the rest:

1. ``BANDS`` bands of ``ROWS`` MinHash values bucket the vertices (a pair at the threshold
   misses every band with probability (1 - 0.8**3)**24, 3e-8).
2. An odd sketch folds ``HASHES`` MinHash samples of a set into a bitmap of ``BITS`` bits in
   which each sample flips one bit. With d differing bits in an exclusive or, similarity is
   about 1 + BITS / (4 * HASHES) * ln(1 - 2 * d / BITS); pairs estimated under
   ``MIN_ESTIMATE``, more than five standard errors below the threshold, are dropped.
   So are pairs of sets whose sizes alone forbid the threshold.
3. The pairs that pass are confirmed on their full sets.

Pairs come in two waves, so that a bucket never yields all its pairs. First each vertex meets
the hub of its bucket, the member with the least hash (one order for all bands, so a group of
near copies shares its hubs), and components of the confirmed links are found. Then only
buckets that still hold several components are compared, block by block: members travel with
their full sets, and pairs from different components that pass the sketch are confirmed where
they meet, in the first bucket they share. Only links leave a block, never the pairs that were
refuted, and what a link joins is not compared again. Buckets with the same members count once.
Nothing is capped: after the second wave every pair that shares a bucket is linked, in one
component, estimated too low, or refuted.

Cases: words are runs of non-white-space bytes with A-Z lowered; a text with fewer words than
a shingle has its whole sequence as its one shingle; without words it has no shingle and no
link; rows that share a ``doc_id`` are one vertex with the links of each; a null ``doc_id``
has no links and a null component, and is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Words, bounded_batches, mixed, saved, slices, table
from ..operators.graph import components

BANDS, ROWS = 24, 3
#: MinHash samples in an odd sketch (the banded ones are among them) and its bits.
HASHES, BITS = 256, 2048
MIN_PERCENT, MIN_ESTIMATE = 80, 0.67
#: Members of one block when a bucket is compared within itself, and shingles of their sets.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 19
#: Bytes of text that are hashed together.
CHUNK = 1 << 20
#: Bit maps that mark wanted documents, each of 2**15 bits: 8 MB in all, at any size of input.
MAPS = 2048

_rng = np.random.default_rng(20260101)
FACTORS = _rng.integers(1 << 62, 1 << 63, HASHES, dtype=np.uint64) * U64(2) + U64(1)
SIGNATURE = "doc_id long, n_shingles long, set_hash string, v long, bands array<long>, odd array<long>"


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    out: list[np.ndarray] = []
    for lo, hi in slices([len(t or "") for t in texts], CHUNK):
        out += _sets(texts[lo:hi], width)
    return out


def _sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    w = Words(texts, lower=True)
    found = []
    with np.errstate(over="ignore"):
        mult = [mixed(np.array([k + 1], dtype=U64))[0] | U64(1) for k in range(width)]
        n = len(w.h) - width + 1
        full = np.zeros(max(n, 0), dtype=U64)
        for k in range(width if n > 0 else 0):
            full += w.h[k : k + n] * mult[k]
        full = mixed(full)
        for i in range(len(texts)):
            lo, hi = w.first[i], w.first[i + 1]
            if hi - lo >= width:
                found.append(np.unique(full[lo : hi - width + 1]))
            elif hi > lo:
                short = U64(hi - lo)
                for k in range(hi - lo):
                    short = short + w.h[lo + k] * mult[k]
                found.append(mixed(np.array([short], dtype=U64)))
            else:
                found.append(np.zeros(0, dtype=U64))
    return found


def _minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """A row of HASHES values for each non-empty set."""
    sizes = [len(s) for s in sets]
    out = np.empty((len(sets), HASHES), dtype=U64)
    with np.errstate(over="ignore"):
        for lo, hi in slices(sizes, 1 << 15):
            h = np.concatenate(sets[lo:hi])
            at = np.concatenate(([0], np.cumsum(sizes[lo:hi])[:-1]))
            for k in range(HASHES):
                out[lo:hi, k] = np.minimum.reduceat(h * FACTORS[k], at)
    return out


def _number(hashes: np.ndarray) -> int:
    """A set's number: the first 64 bits of its digest."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()[:8], "big", signed=True)


def _signatures(width: int) -> object:
    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in slices([len(t or "") for t in texts], CHUNK):
                yield one(batch["doc_id"].iloc[lo:hi], texts[lo:hi])

    def one(ids: pd.Series, texts: list) -> pd.DataFrame:
        sets = _sets(texts, width)
        full = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [[]] * len(sets)
        odd: list = [[]] * len(sets)
        if full:
            m = _minhashes([sets[i] for i in full])
            with np.errstate(over="ignore"):
                parts = m[:, : BANDS * ROWS].reshape(len(full), BANDS, ROWS)
                key = np.zeros((len(full), BANDS), dtype=U64)
                for r in range(ROWS):
                    key = mixed(key + parts[:, :, r])
                bit = mixed(m + np.arange(HASHES, dtype=U64) * U64(0x9E3779B97F4A7C15)) % U64(BITS)
            flips = np.zeros((len(full), BITS), dtype=np.uint8)
            np.bitwise_xor.at(flips, (np.arange(len(full))[:, None], bit.astype(np.int64)), 1)
            words = np.packbits(flips, axis=1, bitorder="little").view("<i8")
            for j, i in enumerate(full):
                bands[i], odd[i] = key[j].view(np.int64), words[j]
        return pd.DataFrame({"doc_id": ids.to_numpy(), "n_shingles": [len(s) for s in sets], "set_hash": [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets], "v": [_number(s) for s in sets], "bands": bands, "odd": odd}).astype({"doc_id": "Int64"})

    return signed


def _estimate(a: Column, b: Column) -> Column:
    """Similarity from two odd sketches; half the bits or more differing means none."""
    d = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    free = F.lit(1.0) - F.lit(2.0) * d / F.lit(float(BITS))
    return F.when(free <= 0, 0.0).otherwise(F.lit(1.0) + F.lit(BITS / (4.0 * HASHES)) * F.log(free))


def _sets_of(width: int) -> object:
    """Every text's sorted shingle hashes as bytes, and the number of its set."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["id"].to_numpy()
            for lo, hi in slices([len(t) for t in texts], CHUNK):
                found = _sets(texts[lo:hi], width)
                yield pd.DataFrame({"id": ids[lo:hi], "v": [_number(s) for s in found], "hashes": [s.tobytes() for s in found]})

    return sets


def _within(least: float, percent: int) -> object:
    """The links between components in each block pair of a bucket."""
    low = int(np.floor((1 - np.exp((least - 1) * 4 * HASHES / BITS)) * BITS / 2))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        key = None
        for batch in batches:
            keys = batch[["band", "key", "x", "y"]].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if key is not None and tuple(keys[lo]) != key:
                    yield group(pd.concat(held, ignore_index=True))
                    held = []
                key = tuple(keys[lo])
                held.append(batch.iloc[lo:hi])
        if held:
            yield group(pd.concat(held, ignore_index=True))

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        ids, comp, block, size = (rows[c].to_numpy().copy() for c in ("id", "component", "block", "n_shingles"))
        band, x, y = (int(rows[c].iloc[0]) for c in ("band", "x", "y"))
        out: list[tuple[int, int]] = []
        if len(rows) > 1 and (comp != comp[0]).any():
            odd = np.stack(rows["odd"].to_numpy()).view(U64)
            bands = np.stack(rows["bands"].to_numpy())
            sets = [np.frombuffer(h, dtype=U64) for h in rows["hashes"]]
            # Within one block every two meet once; between two blocks only across.
            for i in range(len(rows)):
                if x != y and block[i] != x:
                    continue
                rest = np.arange(i + 1, len(rows)) if x == y else np.flatnonzero(block == y)
                rest = rest[comp[rest] != comp[i]]
                rest = rest[100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i])]
                d = np.bitwise_count(odd[rest] ^ odd[i]).sum(axis=1)
                rest, d = rest[d <= low], d[d <= low]
                # A pair is judged in the first bucket it shares; the likeliest pairs come first.
                first = (bands[rest] == bands[i]).argmax(axis=1) == band
                for j in rest[first][np.argsort(d[first], kind="stable")].tolist():
                    if comp[j] == comp[i]:
                        continue
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                        comp[comp == comp[j]] = comp[i]
        return pd.DataFrame(sorted(set(out)), columns=["a", "b"], dtype="int64")

    return compare


def _confirm(width: int, percent: int) -> object:
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple[str, np.ndarray] | None = None
        for batch in batches:
            ta, tb = batch["text_a"].tolist(), batch["text_b"].tolist()
            keep = []
            for lo, hi in slices([len(t) for t in tb], CHUNK):
                right = shingle_sets(tb[lo:hi], width)
                for i in range(lo, hi):
                    if last is None or last[0] != ta[i]:
                        last = (ta[i], shingle_sets([ta[i]], width)[0])
                    x, y = last[1], right[i - lo]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[keep, ["a", "b"]]

    return confirm


def _marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a ``doc_id`` in ``ids``.

    Bit maps over hashes of the ids, of a fixed size whatever the input, drop most other rows
    before the exact semi join shuffles texts.
    """
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(MAPS << 15))
    maps = ids.groupBy(F.shiftright(spot, 15).alias("map")).agg(F.bitmap_construct_agg(spot.bitwiseAND(F.lit((1 << 15) - 1))).alias("marks"))
    at = spot.bitwiseAND(F.lit((1 << 15) - 1))
    byte = F.conv(F.hex(F.substr("marks", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = (F.shiftright(spot, 15) == F.col("map")) & (F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1)
    return docs.join(F.broadcast(maps), there, "left_semi").join(ids, "doc_id", "left_semi")


def _linked(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough. ``texts``: a row for each vertex."""
    right = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    # A hub with very many pairs is split by the skew join, its text copied to each part.
    full = right.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return full.select("a", "b", "text_a", "text_b").mapInPandas(_confirm(width, percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = MIN_PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    bounded_batches(docs.sparkSession)
    signed = saved(docs.select("doc_id", "text").mapInPandas(_signatures(width), SIGNATURE), "neardup-signatures")
    known = signed.filter("doc_id is not null and set_hash is not null")
    classes = known.groupBy("set_hash").agg(F.min("doc_id").alias("id"))
    copies = saved(known.select("doc_id", "set_hash").join(classes, "set_hash").filter("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b")).distinct(), "neardup-copies")
    # One row for each different set; a doc_id with several texts stands for each of them.
    heads = known.join(classes, "set_hash").filter("doc_id = id").dropDuplicates(["set_hash"]).select("id", "v", "n_shingles", "bands", "odd")
    members = heads.select("id", "v", "n_shingles", F.posexplode("bands").alias("band", "key"))
    place = F.xxhash64("id", "v")
    hubs = members.groupBy("band", "key").agg(
        F.min_by("id", place).alias("hub"), F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"), F.bit_xor(place).alias("s"), F.bit_xor(F.xxhash64("v", "id")).alias("t")
    )
    # Of buckets with the same members the one of the first band stays.
    same = hubs.filter("n > 1").groupBy("n", "s", "t").agg(F.min(F.struct("band", "key", "hub", "shingles")).alias("b"))
    hubs = saved(same.select("b.*", "n"), "neardup-hubs")
    shared = saved(members.drop("n_shingles").join(hubs, ["band", "key"]), "neardup-buckets")
    stars = shared.filter("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    odd = heads.groupBy("id").agg(F.collect_list(F.struct("n_shingles", "odd")).alias("odds"))  # one, but for repeated ids
    passed = stars.join(odd.select(F.col("id").alias("a"), F.col("odds").alias("oa")), "a").join(odd.select(F.col("id").alias("b"), F.col("odds").alias("ob")), "b")
    near = F.exists("oa", lambda x: F.exists("ob", lambda y: (F.least(x["n_shingles"], y["n_shingles"]) * 100 >= percent * F.greatest(x["n_shingles"], y["n_shingles"])) & (_estimate(x["odd"], y["odd"]) >= MIN_ESTIMATE)))
    first = saved(passed.filter(near).select("a", "b"), "neardup-stars")

    def texts(ids: DataFrame) -> DataFrame:
        return _marked(docs.select("doc_id", "text").filter("text is not null"), ids).select(F.col("doc_id").alias("id"), "text")

    ends = first.select(F.col("a").alias("doc_id")).union(first.select(F.col("b").alias("doc_id"))).distinct()
    links = saved(_linked(first, texts(ends), width, percent), "neardup-links-1")
    so_far = components(links)
    placed = shared.join(so_far, "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = placed.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("band", "key")
    open_ = saved(placed.join(split, ["band", "key"]).select("band", "key", "id", "v", "component", "n", "shingles"), "neardup-open")
    # Distinct first: rows that share an id and a text would double the set.
    sets = texts(open_.select(F.col("id").alias("doc_id")).distinct()).mapInPandas(_sets_of(width), "id long, v long, hashes binary").dropDuplicates(["id", "v"])
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    whole = open_.join(heads.join(sets, ["id", "v"]), ["id", "v"])
    again = (
        whole.withColumn("block", F.pmod(place, blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("band", "key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "id", "component", "n_shingles", "odd", "bands", "hashes")
    )
    again = again.repartition("band", "key", "x", "y").sortWithinPartitions("band", "key", "x", "y")
    more = saved(again.mapInPandas(_within(MIN_ESTIMATE, percent), "a long, b long"), "neardup-links-2")
    merged = components(links.union(more).union(copies))
    return signed.join(merged.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)
