"""Helpers shared by the training-data operators: tables, shared storage, range buckets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import saved, shared_dir, table

__all__ = ["saved", "shared_dir", "table"]

#: ASCII white space that separates words everywhere in this subpackage (fixed values).
SPACES = r"[\x20\x09-\x0D]+"
U64 = np.uint64
#: Rows of a table of group sizes that is small enough to broadcast.
FEW_GROUPS = 50_000
#: What Spark itself limits an Arrow batch to, where a session says nothing.
DEFAULT_BATCH = "67108864b"


def bounded_batches(spark: SparkSession, most: str = "4m") -> None:
    """Arrow batches of this session hold at most ``most`` bytes; ten thousand long texts would not fit a worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in (None, DEFAULT_BATCH):
        spark.conf.set(name, most)


def set_aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns of these names renamed, and what names them back.

    Names are told apart without regard to case, as Spark does.
    """
    taken, other = {c.lower() for c in docs.columns}, {}
    for name in docs.columns:
        if name.lower() in {n.lower() for n in names}:
            new = f"{name}_own"
            while new.lower() in taken:
                new += "_"
            taken.add(new.lower())
            other[name] = new
    return docs.withColumnsRenamed(other), lambda out: out.withColumnsRenamed({new: name for name, new in other.items()})


def least_hashed(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """Up to ``most`` rows of each ``group``, those with the least hash of their ``key``.

    Only rows whose hash is in the share of the range that holds half as many again are ranked, so
    a group of any size brings a bounded number of rows to the task that ranks them. The sizes of
    the groups travel to all tasks while there are few of them.
    """
    h = F.shiftrightunsigned(F.xxhash64(key), 1)
    sizes = saved(rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")), "group-sizes")
    low = rows.join(F.broadcast(sizes) if sizes.count() <= FEW_GROUPS else sizes, group).filter(h / F.lit(2.0**63) <= F.lit(1.5 * most) / F.col("_n"))
    place = Window.partitionBy(group).orderBy(h, key)
    return low.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= most).drop("_place", "_n")


def bounded_rows(rows: DataFrame, group: str, most: int) -> DataFrame:
    """Up to ``most`` rows ``doc_id, text`` of each ``group``, whatever number of rows share an id; equal rows count once."""
    once = saved(rows.withColumn("_h", F.xxhash64("doc_id", "text")).dropDuplicates([group, "_h"]), "picked")
    return once.join(F.broadcast(least_hashed(once.select(group, "_h"), group, "_h", most)), [group, "_h"]).drop("_h")


def range_bounds(ids: DataFrame, column: str, rows_per_bucket: int, most: int = 20_000) -> list[int]:
    """Upper bounds that cut ``column`` into ranges of about ``rows_per_bucket`` rows; at most ``most`` of them."""
    n = ids.agg(F.count(column)).first()[0]
    buckets = min(most, max(1, -(-n // rows_per_bucket)))
    if buckets == 1:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    accuracy = max(10_000, 10 * buckets)
    found = ids.agg(F.percentile_approx(column, F.lit(np.array(shares)), accuracy)).first()[0]
    return sorted(set(found))


def range_bucket(column: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` lie below ``column``, by binary search; null sorts first."""
    if not bounds:
        return F.lit(0)
    steps = len(bounds).bit_length()
    table_ = F.lit(np.array(bounds, dtype=np.int64))
    low = F.lit(0).cast("int")
    # acc.lo is the count of bounds known to be below the value, acc.hi the least index known not to be.
    start = F.struct(low.alias("lo"), F.lit(len(bounds)).cast("int").alias("hi"))

    def narrow(acc: Column, _: Column) -> Column:
        mid = ((acc["lo"] + acc["hi"]) / 2).cast("int")
        open_ = acc["lo"] < acc["hi"]
        below = F.get(table_, mid) < column
        return F.struct(F.when(open_ & below, mid + 1).otherwise(acc["lo"]).cast("int").alias("lo"), F.when(open_ & ~below, mid).otherwise(acc["hi"]).cast("int").alias("hi"))

    return F.when(column.isNull(), 0).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, narrow, lambda acc: acc["lo"]))


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (the public splitmix64 finaliser)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Words:
    """The words of a batch of texts, hashed together.

    ``doc`` is each word's text in the batch, ``lo``/``hi`` its byte range in ``raw`` and
    ``h`` its 64-bit hash. Words are the runs of bytes other than ASCII white space.
    """

    BASE = 0x9E3779B97F4A7C15  # odd, so powers of it can be inverted modulo 2**64
    STEP = 1 << 17

    def __init__(self, texts: list[str | bytes | None], lower: bool = False) -> None:
        blobs = [t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.raw = b" ".join(blobs) + b" "
        b = np.frombuffer(self.raw, dtype=np.uint8)
        if lower:
            b = b + (((b >= 65) & (b <= 90)) * np.uint8(32))
        self.bytes = b
        solid = ~((b == 32) | ((b >= 9) & (b <= 13)))
        edge = np.diff(np.concatenate(([0], solid.view(np.int8))))
        self.lo = np.flatnonzero(edge == 1)
        self.hi = np.flatnonzero(edge == -1)
        starts = np.cumsum([0] + [len(x) + 1 for x in blobs])
        self.doc = np.searchsorted(starts, self.lo, side="right") - 1
        self.first = np.searchsorted(self.lo, starts)
        self.h = self._hash(b)

    def _hash(self, b: np.ndarray) -> np.ndarray:
        """Polynomial hashes from prefix sums, a block of bytes at a time (a word is never cut)."""
        out = np.empty(len(self.lo), dtype=U64)
        cuts = np.searchsorted(self.lo, np.arange(0, len(b) + self.STEP, self.STEP))
        with np.errstate(over="ignore"):
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if i == j:
                    continue
                base = int(self.lo[i])
                lo, hi = self.lo[i:j] - base, self.hi[i:j] - base
                power, inverse = _powers(int(hi[-1]))
                total = np.concatenate((np.zeros(1, U64), np.cumsum((b[base : base + int(hi[-1])].astype(U64) + U64(1)) * power)))
                out[i:j] = mixed(((total[hi] - total[lo]) * inverse[lo]) ^ ((hi - lo).astype(U64) << U64(48)))
        return out


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        with np.errstate(over="ignore"):
            inverse = pow(Words.BASE, -1, 1 << 64)
            _POWERS[size] = tuple(np.cumprod(np.concatenate((np.ones(1, U64), np.full(size - 1, x, U64)))) for x in (Words.BASE, inverse))
    power, inverse = _POWERS[size]
    return power[:n], inverse[: n + 1]


def slices(sizes: np.ndarray | list[int], most: int) -> list[tuple[int, int]]:
    """Cut a batch into runs of rows of at most ``most`` bytes each (one long row makes its own run)."""
    out, lo, total = [], 0, 0
    for i, s in enumerate(sizes):
        if i > lo and total + s > most:
            out.append((lo, i))
            lo, total = i, 0
        total += s
    if len(sizes) > lo:
        out.append((lo, len(sizes)))
    return out
