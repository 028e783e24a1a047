"""Vector code compression: product codebooks, found through segment-mean lower bounds.

A vector's components become integers, floor(256 * x), and the vector is cut into ``PARTS`` equal
consecutive parts. Each part position has a codebook of up to ``ENTRIES`` entries, at first the
parts of the rows with the smallest ids. A round assigns every part to the nearest entry (squared
Euclidean distance, ties to the lower index) and replaces each entry by the floor of the mean of
its parts; entries without parts stay. After ``ROUNDS`` rounds the parts are assigned for good.

Assignment filters entries from coarse to fine. At each level a part and an entry are cut into
segments (one, then two, four, ...); with s the sum and m the length of a segment and r the norm of
what is left when each segment's mean is taken away, the squared distance is at least the sum of
(s - s')**2 / m over the segments plus (r - r')**2. An entry whose bound is over the exact distance
to the entry with the least bound cannot be nearest, and is dropped; bounds leave room for
rounding, so ties are kept. Entries that survive all levels get exact integer distances.

Rows stay where they are: a round sends sums of a fixed number of entries from each task, and
codebooks (``PARTS`` x ``ENTRIES`` entries) are all that the driver holds.

Cases: rows with a null vector or with null or non-finite components are dropped; a vector whose
length is not the most frequent one (the longer of equally frequent ones), or no multiple of
``PARTS``, or with a component beyond ``LIMIT``, has a null code and a null error; a null id is
never among the first entries; rows that share an id are coded each and start entries in the order
of their vectors; fewer rows than entries make smaller codebooks; null labels are one group; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, saved, table
from .vectors import Integers

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Greatest magnitude of an integer component whose squared distances stay exact.
LIMIT = 1 << 24
#: Parts that are assigned together.
CHUNK = 1 << 13


class Codebook:
    """The entries of one part position with their segment sums and residual norms."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries, width = entries, entries.shape[1]
        self.cuts = [np.linspace(0, width, segments + 1).astype(int)[:-1] for segments in (1 << k for k in range(20)) if segments < width] or [np.zeros(1, int)]
        self.levels = [self._segments(entries, cut) for cut in self.cuts]
        self.tried = self.exact = 0

    @staticmethod
    def _segments(x: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums of segments over the roots of their lengths, and the residual norm."""
        length = np.diff(np.append(cut, x.shape[1]))
        sums = np.add.reduceat(x, cut, axis=1)
        rest = x - np.repeat(sums / length, length, axis=1)
        return sums / np.sqrt(length), np.sqrt((rest * rest).sum(axis=1)), length

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row of ``x`` and the exact squared distance."""
        code, error = np.empty(len(x), dtype=np.int64), np.empty(len(x), dtype=np.int64)
        for lo in range(0, len(x), CHUNK):
            code[lo : lo + CHUNK], error[lo : lo + CHUNK] = self._assign(x[lo : lo + CHUNK])
        return code, error

    def _distance(self, x: np.ndarray, row: np.ndarray, entry: np.ndarray) -> np.ndarray:
        d = x[row] - self.entries[entry]
        return (d * d).sum(axis=1)

    def _assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(x), len(self.entries)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, entry, least = np.repeat(np.arange(n), k), np.tile(np.arange(k), n), None
        for cut, (sums, rest, _) in zip(self.cuts, self.levels, strict=True):
            own, own_rest, _ = self._segments(x, cut)
            if least is None:  # all entries: as a matrix
                bound = sum((own[:, j, None] - sums[None, :, j]) ** 2 for j in range(len(cut))) + (own_rest[:, None] - rest) ** 2
                best = bound.argmin(axis=1)
                bound = bound.reshape(-1)
            else:
                bound = ((own[row] - sums[entry]) ** 2).sum(axis=1) + (own_rest[row] - rest[entry]) ** 2
                first = np.searchsorted(row, np.arange(n))
                at = np.flatnonzero(bound == np.repeat(np.minimum.reduceat(bound, first), np.diff(np.append(first, len(row)))))
                best = entry[at[np.searchsorted(row[at], np.arange(n))]]
            now = self._distance(x, np.arange(n), best)
            least = now if least is None else np.minimum(least, now)
            alive = bound <= least[row] * (1 + 1e-9) + 1e-3
            row, entry = row[alive], entry[alive]
        self.tried, self.exact = self.tried + n * k, self.exact + len(row)
        key = self._distance(x, row, entry) * k + entry
        key = np.minimum.reduceat(key, np.searchsorted(row, np.arange(n)))
        return key % k, key // k


def _starts(limit: int, most: int) -> object:
    """Of each length, a task's number of rows and its first ones by id."""

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[int, int] = {}
        first: dict[int, list[tuple]] = {}
        for batch in batches:
            v, ids = Integers(batch.column("embedding")), batch.column("vec_id")
            fits = v.good & (v.most <= limit)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            number = ids.fill_null(0).to_numpy()
            for size in np.unique(v.size[v.good]).tolist():
                mine = v.size == size
                count[size] = count.get(size, 0) + int((mine & v.good).sum())
                rows = np.flatnonzero(mine & fits & known)
                if len(rows) > most:  # whoever ties with the last stays
                    rows = rows[number[rows] <= np.partition(number[rows], most - 1)[most - 1]]
                held = first.get(size, []) + list(zip(number[rows].tolist(), map(tuple, v.matrix(rows, size).tolist()), strict=True))
                first[size] = sorted(held)[:most]
        rows = [(s, n, None, None) for s, n in count.items()] + [(s, 0, i, list(x)) for s, found in first.items() for i, x in found]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["size", "n", "vec_id", "part"])

    return starts


def _rows(batch: pa.RecordBatch, size: int, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are kept, which of them can be coded, and these as a matrix."""
    v = Integers(batch.column("embedding"))
    fits = v.good & (v.size == size) & (v.most <= limit)
    return v.good, fits, v.matrix(np.flatnonzero(fits), size)


def _sums(books: np.ndarray) -> object:
    """By part, entry and position: the sum over a task's parts of that entry, and their number."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, width = books.shape
        made = [Codebook(b) for b in books]
        total, count = np.zeros(books.shape, dtype=np.int64), np.zeros((parts, k), dtype=np.int64)
        for batch in batches:
            x = _rows(batch, parts * width, LIMIT)[2].reshape(-1, parts, width)
            for p in range(parts):
                code, _ = made[p].assign(x[:, p])
                count[p] += np.bincount(code, minlength=k)
                for j in range(width):
                    total[p, :, j] += np.bincount(code, weights=x[:, p, j], minlength=k).astype(np.int64)
        part, entry, at = (a.reshape(-1) for a in np.indices(books.shape))
        used = np.repeat(count.reshape(-1), width) > 0
        yield pa.record_batch([pa.array(c[used]) for c in (part, entry, at, total.reshape(-1), np.repeat(count.reshape(-1), width))], names=["part", "entry", "at", "total", "n"])

    return sums


def _codes(books: np.ndarray, label_type: pa.DataType) -> object:
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, width = books.shape
        made = [Codebook(b) for b in books if b.size]
        for batch in batches:
            good, fits, x = _rows(batch, parts * width, LIMIT)
            if not made:  # without entries nothing can be coded
                fits[:], x = False, x[:0]
            found = [book.assign(x[:, p * width : (p + 1) * width]) for p, book in enumerate(made)] or [(np.zeros(0, np.int64),) * 2]
            octets = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            error, code = np.zeros(len(good), dtype=np.int64), np.full(len(good), None, dtype=object)
            error[fits] = sum(e for _, e in found)
            code[fits] = [row.tobytes().hex() for row in octets]
            out = pa.record_batch([batch.column("vec_id").cast(pa.int64()), batch.column("label").cast(label_type), pa.array(code, pa.string()), pa.array(error, mask=~fits)], names=["vec_id", "label", "code", "error"])
            yield out.filter(pa.array(good))

    return codes


def trained(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks as ``parts`` x entries x width integers, for ``vectors(vec_id, embedding)``."""
    source = vectors.select(F.col("vec_id").cast("long"), "embedding")
    starts = saved(source.mapInArrow(_starts(LIMIT, entries), "size long, n long, vec_id long, part array<long>"), "codes-starts")
    usual = starts.groupBy("size").agg(F.sum("n").alias("n")).filter("n > 0").orderBy(F.desc("n"), F.desc("size")).first()
    size = usual["size"] if usual else 0
    if not size or size % parts:
        return np.zeros((parts, 0, 0), dtype=np.int64)
    first = starts.filter(F.col("vec_id").isNotNull() & (F.col("size") == size)).orderBy("vec_id", "part").limit(entries).collect()
    books = np.array([r["part"] for r in first], dtype=np.int64).reshape(len(first), parts, size // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        sums = source.mapInArrow(_sums(books), "part long, entry long, at long, total long, n long").groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for r in sums.collect():  # a row for each component of the codebooks at most
            books[r["part"], r["entry"], r["at"]] = r["total"] // r["n"]
    return books


def compressed(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of every kept row."""
    label = vectors.schema["label"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    source = vectors.select(F.col("vec_id").cast("long"), "embedding", "label")
    return source.mapInArrow(_codes(books, to_arrow_type(label)), f"vec_id long, label {label.simpleString()}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    bounded_batches(spark)
    books = trained(vectors)
    rows = saved(compressed(vectors, books), "codes")
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    # Few labels are broadcast by their size at run time; of many, a hot one is split.
    out = rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
