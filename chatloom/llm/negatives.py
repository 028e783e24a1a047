"""Hard-negative mining: exact top-k by inner product over one-dimensional distance keys.

Components become integers, floor(256 * x), and a row's score for an anchor is their inner product.
With one more component, the root of what a row lacks of the greatest squared norm, all rows lie
on one sphere; an anchor gets a zero there. Then the squared distance of an anchor and a row is
``anchor's square + sphere's square - 2 * score``: the highest scores are the nearest rows.

Every row belongs to its nearest pivot, and the index is a table sorted by the key (pivot,
distance to it), cut into shards and these into blocks of ``BLOCK`` rows, each an interval of
keys. A row at distance d from an anchor has a key within d of the anchor's own distance to the
pivot. So an anchor visits the blocks of a shard by their distance from its own key, a few more at
each step: an annulus that grows around it. It stops as soon as the next interval is further than
the k-th best row found so far, which certifies the top k.

Rows of equal label give each anchor its positives. Each positive makes a window of scores, from
``LEAST`` to ``MOST`` percent of its own, and the best rows of other labels inside the window are
the hard negatives; intervals that lie wholly nearer than the window's upper end are passed over,
and the window's lower end is a threshold from the start. Both searches have two waves: first each
anchor searches the shard that holds it, then, with the k-th best scores that it found, only the
shards whose intervals can still hold a better row. A task holds one shard and streams anchors
past it; all of an anchor's rows together are k a shard.

Bounds leave room for rounding, scores are exact, and ties go to the smaller ``vec_id``.

Cases: rows with a null label, a null vector, or a null or non-finite component take no part; nor
do rows with a null ``vec_id`` (they can't be named), of another length than the most frequent one
(the longer of equally frequent ones), or with a component beyond ``LIMIT``; rows that share an id
are rows each, as anchors too; a negative or missing positive has no negatives, a zero one those
with score zero; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, saved, table
from .vectors import Integers

POSITIVES, NEGATIVES, EVERY = 5, 3, 50
#: Percent of a positive's score that its negatives have at least and at most.
LEAST, MOST = 50, 95
#: Pivots (those of least hash: they only decide how much is searched), rows of a shard and a block.
PIVOTS, SHARD_ROWS, BLOCK = 64, 2048, 64
#: Anchors that stream past one copy of a shard; blocks of the first step.
ANCHOR_BLOCK, STEP = 1 << 18, 4
#: Greatest magnitude of an integer component whose scores stay exact.
LIMIT = 1 << 21
#: Room for rounding in bounds, as a share of the squares they come from.
SLACK = 1e-9
KEYED = "row long, vec_id long, label int, v array<int>, pivot int, distance double"


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v = Integers(batch.column("embedding"))
        rows = np.flatnonzero(v.good & (v.most <= LIMIT) & (v.size > 0))
        sizes = v.size[rows]
        at = np.repeat(v.start[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        flat = v.flat[at]
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(flat.astype(np.int32)))
        square = np.bincount(np.repeat(np.arange(len(rows)), sizes), weights=flat * flat, minlength=len(rows)).astype(np.int64)
        ids, labels = (batch.column(c).take(pa.array(rows)) for c in ("vec_id", "label"))
        yield pa.record_batch([ids, labels, lists, pa.array(square), pa.array(sizes)], names=["vec_id", "label", "v", "square", "size"])


def prepared(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, label, v, square`` of the rows that take part in mining."""
    source = vectors.filter("vec_id is not null and label is not null").select(F.col("vec_id").cast("long"), F.col("label").cast("int"), "embedding")
    rows = saved(source.mapInArrow(_integers, "vec_id long, label int, v array<int>, square long, size long"), "negatives-vectors")
    usual = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return rows.filter(F.col("size") == (usual["size"] if usual else 0)).withColumn("row", F.monotonically_increasing_id()).drop("size")


class Sphere:
    """Pivots on the sphere that all rows of the index lie on."""

    def __init__(self, pivots: np.ndarray, square: int) -> None:
        self.square, self.pivots = float(square), pivots.astype(np.float64)
        self.lift = self.lifted((self.pivots**2).sum(axis=1))

    def lifted(self, squares: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.square - squares, 0))

    def distances(self, x: np.ndarray, anchors: bool) -> np.ndarray:
        """Of each row of ``x`` to each pivot; anchors have no lift."""
        squares = (x * x).sum(axis=1)
        own = np.zeros(len(x)) if anchors else self.lifted(squares)
        off = (squares + own * own + self.square)[:, None] - 2 * (x @ self.pivots.T + own[:, None] * self.lift)
        return np.sqrt(np.maximum(off, 0))


def _keys(sphere: Sphere, anchors: bool) -> object:
    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            d = sphere.distances(np.stack(batch["v"].to_numpy()).astype(np.float64), anchors)
            if anchors:
                yield batch.assign(distances=list(d))
            else:
                near = d.argmin(axis=1)
                yield batch[["row", "vec_id", "label", "v"]].assign(pivot=near, distance=d[np.arange(len(d)), near])

    return keys


class Shard:
    """Rows sorted by key, cut into blocks. ``seen`` and ``skipped`` count blocks."""

    def __init__(self, sphere: Sphere, rows: pd.DataFrame) -> None:
        self.sphere = sphere
        self.x = np.stack(rows["v"].to_numpy()).astype(np.float64)
        self.row, self.id, self.label, pivot, distance = (rows[c].to_numpy() for c in ("row", "vec_id", "label", "pivot", "distance"))
        turn = np.flatnonzero(pivot[1:] != pivot[:-1]) + 1
        runs = np.concatenate(([0], turn, [len(pivot)]))
        self.first = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(runs[:-1].tolist(), runs[1:].tolist(), strict=True)])
        self.end = np.append(self.first[1:], len(pivot))
        self.pivot, self.near, self.far = pivot[self.first], distance[self.first], distance[self.end - 1]
        self.seen = self.skipped = 0

    def search(self, own: int, label: int, q: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, id and score of the best ``k`` rows in each window of scores, of the anchor's label or of others."""
        square = float(q @ q) + self.sphere.square
        d = np.sqrt(np.maximum(square - 2 * (self.sphere.pivots @ q), 0))[self.pivot]
        room = SLACK * square + 1e-3
        most = (square - np.maximum(np.maximum(d - self.far, self.near - d), 0) ** 2) / 2 + room
        order = np.argsort(-most, kind="stable")
        order = order[((square - (d + self.far) ** 2) / 2 - room <= high.max())[order] & (most[order] >= low.min())]
        ids, scores, at, step = np.zeros(0, np.int64), np.zeros(0), 0, STEP
        floor = low
        while at < len(order) and most[order[at]] >= floor.min():
            blocks = order[at : at + step]
            sizes = self.end[blocks] - self.first[blocks]
            rows = np.repeat(self.first[blocks] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            rows = rows[(self.label[rows] == label) & (self.row[rows] != own) if same else self.label[rows] != label]
            score = self.x[rows] @ q
            good = (score >= floor.min()) & (score <= high.max())
            ids, scores = np.concatenate((ids, self.id[rows[good]])), np.concatenate((scores, score[good]))
            best = np.lexsort((ids, -scores))
            ids, scores = ids[best], scores[best]
            # Best first, a window's rows are next to each other.
            start = np.searchsorted(-scores, -high, side="left")
            last = np.append(scores, np.full(k, -np.inf))[start + k - 1]
            floor = np.maximum(low, last)
            at, step = at + len(blocks), step * 2
        self.seen, self.skipped = self.seen + at, self.skipped + len(self.first) - at
        start = np.searchsorted(-scores, -high, side="left")
        place = (start[:, None] + np.arange(k)).reshape(-1)
        window = np.repeat(np.arange(len(low)), k)
        there = place < len(scores)
        there[there] = scores[place[there]] >= low[window[there]]
        return window[there], ids[place[there]], scores[place[there]]


def _search(sphere: Sphere, k: int, same: bool) -> object:
    """Rows come by shard and part, the shard's own first: they make what the anchors pass."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held, shard = None, [], None
        for batch in batches:
            keys = batch[["shard", "part", "kind"]].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if tuple(keys[lo, :2]) != group:
                    group, held, shard = tuple(keys[lo, :2]), [], None
                rows = batch.iloc[lo:hi]
                if keys[lo, 2] == 0:
                    held.append(rows)
                    continue
                if shard is None:
                    shard, held = Shard(sphere, pd.concat(held, ignore_index=True)), []
                out = []
                for own, label, v, low, high in zip(*(rows[c].tolist() for c in ("row", "label", "v", "low", "high")), strict=True):
                    window, ids, scores = shard.search(own, label, np.asarray(v, dtype=np.float64), np.asarray(low), np.asarray(high), k, same)
                    out.append(pd.DataFrame({"row": own, "window": window, "vec_id": ids, "score": scores}))
                yield pd.concat(out, ignore_index=True).astype({"row": "int64", "window": "int32", "vec_id": "int64", "score": "int64"})

    return search


class Index:
    """All rows by key in a stored table of shards, and each shard's intervals."""

    def __init__(self, rows: DataFrame, shard_rows: int = SHARD_ROWS) -> None:
        n, square = rows.agg(F.count(F.lit(1)), F.max("square")).first()
        some = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").select("v").limit(PIVOTS).collect()
        pivots = np.unique(np.array([r["v"] for r in some], dtype=np.int64), axis=0) if some else np.zeros((0, 0), np.int64)
        self.sphere = Sphere(pivots, square or 0)
        keyed = rows.select("row", "vec_id", "label", "v").mapInPandas(_keys(self.sphere, False), KEYED)
        # Equal keys are told apart by their ids, so one frequent vector fills several shards.
        dealt = keyed.repartitionByRange(max(1, -(-n // shard_rows)), "pivot", "distance", "vec_id", "row")
        self.rows = saved(dealt.sortWithinPartitions("pivot", "distance", "vec_id", "row").withColumn("shard", F.spark_partition_id()), "negatives-index")
        self.intervals = saved(self.rows.groupBy("shard", "pivot").agg(F.min("distance").alias("near"), F.max("distance").alias("far")), "negatives-intervals")

    def anchors(self, every: int = EVERY) -> DataFrame:
        """Rows whose id is divisible by ``every``: ``row, anchor_id, label, v, home, distances``."""
        mine = self.rows.filter(F.col("vec_id") % every == 0).select("row", F.col("vec_id").alias("anchor_id"), "label", "v", F.col("shard").alias("home"))
        return saved(mine.mapInPandas(_keys(self.sphere, True), "row long, anchor_id long, label int, v array<int>, home int, distances array<double>"), "negatives-anchors")

    def best(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """``row, window, rank, vec_id, score``: the best ``k`` rows of each window of each anchor.

        ``anchors`` have ``row, label, v, home, distances`` and arrays ``low, high`` of the windows' scores.
        """
        anchors = saved(anchors, "negatives-asked")
        first = saved(self._hits(anchors.withColumn("shard", F.col("home")), k, same), "negatives-home")
        kth = first.groupBy("row", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).filter(F.col("n") == k)  # k of them at most
        reached = kth.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("window", F.col("kth").cast("double")))).alias("kths"))
        low = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("kths", i), x)))
        again = anchors.join(reached, "row", "left").withColumn("low", low).drop("kths")
        hits = first.union(self._hits(again.join(self._shards(again), "row"), k, same))
        rank = F.row_number().over(Window.partitionBy("row", "window").orderBy(F.desc("score"), "vec_id"))
        return hits.withColumn("rank", rank).filter(F.col("rank") <= k)

    def _shards(self, anchors: DataFrame) -> DataFrame:
        """``row, shard``: the shards beside its home where an anchor's windows can still find better rows."""
        square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x) + F.lit(self.sphere.square)
        asked = anchors.select("row", "home", square.alias("square"), F.array_min("low").alias("low"), F.array_max("high").alias("high"), F.posexplode("distances").alias("pivot", "d"))
        room = F.lit(SLACK) * F.col("square") + 1e-3
        gap = F.greatest(F.col("d") - F.col("far"), F.col("near") - F.col("d"), F.lit(0.0))
        can = ((F.col("square") - gap * gap) / 2 + room >= F.col("low")) & ((F.col("square") - F.pow(F.col("d") + F.col("far"), F.lit(2.0))) / 2 - room <= F.col("high"))
        return asked.join(self.intervals, "pivot").filter(can & (F.col("shard") != F.col("home"))).select("row", "shard").distinct()

    def _hits(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        parts = max(1, -(-asked.select("row").distinct().count() // ANCHOR_BLOCK))
        left = self.rows.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "kind": F.lit(0), "low": F.lit(None).cast("array<double>"), "high": F.lit(None).cast("array<double>")})
        right = asked.select("row", F.lit(0).cast("long").alias("vec_id"), "label", "v", F.lit(0).alias("pivot"), F.lit(0.0).alias("distance"), "shard", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("kind"), "low", "high")
        rows = left.unionByName(right).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind", "pivot", "distance", "vec_id", "row")
        return rows.mapInPandas(_search(self.sphere, k, same), "row long, window int, vec_id long, score long")


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``vectors(vec_id, embedding, label)``."""
    bounded_batches(vectors.sparkSession)
    index = Index(prepared(vectors), shard_rows)
    anchors = index.anchors(every)
    whole = F.array(F.lit(float("-inf"))), F.array(F.lit(float("inf")))
    found = saved(index.best(anchors.withColumns({"low": whole[0], "high": whole[1]}), positives, True), "negatives-positives")
    # LEAST * positive <= 100 * negative <= MOST * positive, in whole numbers; a negative score has no such window.
    wanted = found.filter("score >= 0").select("row", F.struct(F.col("rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.expr(f"({LEAST} * score + 99) div 100").alias("low"), F.expr(f"({MOST} * score) div 100").alias("high")).alias("w"))
    windows = wanted.groupBy("row").agg(F.array_sort(F.collect_list("w")).alias("w"))  # ``positives`` of them at most
    asked = saved(anchors.join(windows, "row"), "negatives-windows")
    best = index.best(asked.select("row", "label", "v", "home", "distances", F.col("w.low").cast("array<double>").alias("low"), F.col("w.high").cast("array<double>").alias("high")), negatives, False)
    out = best.join(asked.select("row", "anchor_id", "w"), "row").withColumn("p", F.get("w", F.col("window")))
    return out.select("anchor_id", "p.positive_id", "rank", F.col("vec_id").alias("negative_id"), "p.positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return hard_negatives(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))
