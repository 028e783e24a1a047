"""SimHash near-dedup: covering locality-sensitive hashing, exact links, connected components.

A text's fingerprint has ``BITS`` bits; bit b is 1 if it is set in over half of the hashes of its
word shingles, repeats included. Fingerprints that differ in at most ``RADIUS`` bits are linked.

``covering_masks`` gives 2**(radius + 1) - 1 bit masks: each bit of a fingerprint has a vector of
radius + 1 binary digits, and the mask of a vector v keeps the bits whose vectors have an odd
product with v. Any ``radius`` bits have vectors that span at most ``radius`` dimensions, so some
v is orthogonal to them all and its mask leaves them out: two fingerprints within the radius are
equal under that mask, for certain. So there is a table for each mask, and a bucket for each
masked value.

Equal fingerprints are one vertex, so copies never make pairs. A bucket of more than ``BUCKET``
fingerprints is covered again: masks over the bits that its own mask left out split it, and a
pair within the radius is together in some part, by the same argument. Each round keeps about
half of the bits left, and with log2(``BUCKET``) bits left no bucket can be larger, so this ends
at a bucket of bounded size without a cap. A bucket yields a spanning forest of its links, so
never more links than members; components of the forests are components of all links.

Cases: words are runs of non-white-space bytes with A-Z lowered; fewer words than a shingle make
one shingle; null and blank texts have fingerprint zero and are linked like any other; rows that
share a ``doc_id`` are one vertex with the links of each; a row with a null ``doc_id`` is linked
too, but its id is never the smallest: ``component_id`` is null if no row of the component has
an id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components
from .common import bounded_batches, saved, slices, table

WIDTH, SEED, BITS, RADIUS = 3, 42, 64, 2
#: Fingerprints of a bucket that are compared with each other.
BUCKET = 512
#: Shingles whose bits are counted together.
CHUNK = 1 << 15
#: Bytes of text taken from a batch at a time.
BYTES = 1 << 20


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over ``bits`` such that any ``radius`` of them are left out by one mask together."""
    # Independent vectors first: with more bits than the radius every mask keeps one at least.
    vectors = sorted(range(1, 1 << (radius + 1)), key=lambda v: (v.bit_count(), v))
    return sorted({sum(1 << b for j, b in enumerate(bits) if (vectors[j % len(vectors)] & v).bit_count() % 2) for v in vectors})


def finer_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """What covers a bucket of ``mask`` again: its bits and masks over the bits that it leaves out."""
    return [mask | m for m in covering_masks([b for b in range(BITS) if not mask >> b & 1], radius)]


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint of one text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, ends = b" ".join(words), list(itertools.accumulate((len(w) + 1 for w in words), initial=0))
    hashed = xxhash.xxh64_intdigest
    last = ends[width:] if len(words) >= width else ends[-1:]
    n, counts = len(last), np.zeros(BITS, dtype=np.int64)
    spans = zip(ends, last, strict=False)
    while part := [hashed(joined[a : b - 1], SEED) for a, b in itertools.islice(spans, CHUNK)]:
        octets = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, BITS // 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _signed(width: int) -> object:
    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in slices([len(t or "") for t in texts], BYTES):
                prints = np.array([fingerprint(t, width) for t in texts[lo:hi]], dtype=np.uint64).view(np.int64)
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[lo:hi].astype("Int64").to_numpy(), "fingerprint": prints})

    return signed


def _forest(radius: int) -> object:
    """Links that hold the near fingerprints of each bucket together; rows come bucket by bucket."""

    def forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = rows[["mask", "key"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            # The last bucket may go on in the next batch.
            done = int(cuts[-1]) if len(cuts) else 0
            if done:
                yield linked(rows["fingerprint"].to_numpy()[:done], np.concatenate(([0], cuts)))
            rest = rows.iloc[done:]
        if rest is not None and len(rest):
            yield linked(rest["fingerprint"].to_numpy(), np.array([0, len(rest)]))

    def linked(f: np.ndarray, cuts: np.ndarray) -> pd.DataFrame:
        sizes = np.diff(cuts)
        two = cuts[:-1][sizes == 2]
        near = np.bitwise_count((f[two] ^ f[two + 1]).view(np.uint64)) <= radius
        out = [np.stack((f[two][near], f[two + 1][near]), axis=1)]
        out += [tree(f[a : a + n]) for a, n in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True)]
        pairs = np.concatenate(out)
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    def tree(f: np.ndarray) -> np.ndarray:
        open_, links = np.ones(len(f), dtype=bool), []
        for i in range(len(f)):
            stack = [i] if open_[i] else []
            open_[i] = False
            while stack:
                k = stack.pop()
                new = np.flatnonzero(open_ & (np.bitwise_count((f ^ f[k]).view(np.uint64)) <= radius))
                open_[new] = False
                stack += new.tolist()
                links += [(f[k], f[j]) for j in new]
        return np.array(links, dtype=np.int64).reshape(-1, 2)

    return forests


def _long(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def near_links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that join the distinct ``fingerprint`` values within ``radius`` into their components."""
    bucket = max(bucket, 1 << radius)
    spark = prints.sparkSession
    masks = covering_masks(list(range(BITS)), radius)
    members = prints.select("fingerprint", F.explode(F.lit(np.array([_long(m) for m in masks], dtype=np.int64))).alias("mask"))
    found: list[DataFrame] = []
    while True:
        members = members.withColumn("key", F.col("fingerprint").bitwiseAND(F.col("mask")))
        sizes = members.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = saved(members.join(sizes, ["mask", "key"]), "simhash-buckets")
        free = F.lit(BITS) - F.bit_count("mask")
        small = (F.col("n") <= bucket) | (F.pow(F.lit(2.0), free) <= bucket)
        dealt = shared.filter(small).select("mask", "key", "fingerprint").repartition("mask", "key").sortWithinPartitions("mask", "key")
        found.append(dealt.mapInPandas(_forest(radius), "a long, b long"))
        large = shared.filter(~small)
        if large.isEmpty():
            return saved(functools.reduce(DataFrame.union, found).distinct(), "simhash-links")
        # 7 masks become 49, then 343: a table of known size.
        finer = [(_long(m), _long(x)) for m in masks for x in finer_masks(m, radius)]
        masks = sorted({x % (1 << 64) for _, x in finer})
        split = F.broadcast(spark.createDataFrame(finer, "mask long, finer long"))
        members = large.select("fingerprint", "mask").join(split, "mask").select("fingerprint", F.col("finer").alias("mask")).distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; the fingerprint as a signed number."""
    bounded_batches(docs.sparkSession)
    rows = saved(docs.select("doc_id", "text").mapInPandas(_signed(width), "doc_id long, fingerprint long"), "simhash-rows")
    heads = saved(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("id")), "simhash-fingerprints")
    # Texts of one doc_id hold together.
    several = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("high")).filter("a < high")
    same = rows.join(several, "doc_id").filter("a <> fingerprint").select("a", F.col("fingerprint").alias("b"))
    parts = components(near_links(heads, radius, bucket).union(same)).select(F.col("id").alias("fingerprint"), "component")
    named = saved(heads.join(parts, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint")), "simhash-components")
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of = named.select("fingerprint", "component").join(least, "component").select("fingerprint", "component_id")
    return rows.join(of, "fingerprint").select("doc_id", "fingerprint", "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
