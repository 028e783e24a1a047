"""Quality classifier: a second-order factorisation machine over hashed words and structure.

Inputs of a score are the text's words (hashed to ``WORDS`` columns, weighted by the root of
their count, scaled to length one) and statistics of its structure and length. Labels,
language, source and id are never inputs. With x the inputs, the score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2)

which takes time linear in the number of non-zero inputs.

The machine is fitted on a bounded sample: up to ``SAMPLE`` labelled rows of each class, those
with the least hash of their id. Their inputs are made where the rows are; only those reach the
driver (at most ``2 * SAMPLE`` sparse rows of ``WORDS`` columns). Scoring reads every whole text.

Cases: null and empty texts score as a text without words; rows without a label are scored,
not learned from; rows that share a ``doc_id`` share its label and score by their own text; a
``doc_id`` with labels of both kinds is not learned from; a null ``doc_id`` is scored and never
learned from; without labels of both classes every score is the share of label 1 (0.5 if there
is none); ``scored`` keeps other columns and replaces one named ``quality_score``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Words, bounded_batches, bounded_rows, least_hashed, slices, table

#: Columns of hashed words, factors of an interaction, labelled rows of each class to learn from.
WORDS, FACTORS, SAMPLE = 1 << 13, 6, 1200
EPOCHS, RATE, DECAY, SEED = 12, 0.05, 1e-4, 7
CHUNK = 1 << 20
STATS = 14


def held_out(doc_id: Column, modulus: int, rest: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def _inputs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the hashed words, and a dense table of statistics."""
    w = Words(texts)
    n = len(texts)
    columns = (w.h >> U64(51)).astype(np.int64) % WORDS
    keys, counts = np.unique(w.doc.astype(np.int64) * WORDS + columns, return_counts=True)
    row, column = keys // WORDS, keys % WORDS
    value = np.sqrt(counts)
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=n))
    value = value / np.maximum(norm, 1e-9)[row]

    b = w.bytes
    sizes = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
    starts = np.cumsum([0] + [s + 1 for s in sizes])[:-1]

    def share(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int64), starts) / np.maximum(sizes, 1)

    upper = (b >= 65) & (b <= 90)
    lower = (b >= 97) & (b <= 122)
    digit = (b >= 48) & (b <= 57)
    high = b >= 128
    space = (b == 32) | ((b >= 9) & (b <= 13))
    words = np.bincount(w.doc, minlength=n)
    distinct = np.bincount(row, minlength=n)
    length = np.bincount(w.doc, weights=w.hi - w.lo, minlength=n) / np.maximum(words, 1)
    # Words that equal the word before them, and words that end in a mark other than , and .
    same = np.bincount(w.doc[1:][(w.h[1:] == w.h[:-1]) & (w.doc[1:] == w.doc[:-1])], minlength=n) if len(w.h) > 1 else np.zeros(n)
    last = b[w.hi - 1] if len(w.hi) else np.zeros(0, np.uint8)
    odd = ~(((last >= 48) & (last <= 57)) | ((last >= 65) & (last <= 90)) | ((last >= 97) & (last <= 122)) | (last >= 128) | (last == 44) | (last == 46))
    odd = np.bincount(w.doc[odd], minlength=n)
    single = np.bincount(w.doc[(w.hi - w.lo) == 1], minlength=n)
    per = np.maximum(words, 1)
    stats = np.stack(
        [
            np.log1p(sizes) / 10,
            np.log1p(words) / 10,
            length / 10,
            share(upper),
            share(lower),
            share(digit),
            share(high),
            share(~(upper | lower | digit | high | space)),
            share(b == 10) * 20,
            share(b == 124) * 10,
            np.where(words, distinct / per, 0),
            same / per,
            odd / per,
            single / per,
        ],
        axis=1,
    )
    return row, column, value, stats


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        for lo, hi in slices([len(t or "") for t in texts], CHUNK):
            row, column, value, stats = _inputs(texts[lo:hi])
            at = np.searchsorted(row, np.arange(hi - lo + 1))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].to_numpy()[lo:hi],
                    "label": batch["label"].to_numpy()[lo:hi],
                    "columns": [column[a:b].astype(np.int32) for a, b in zip(at, at[1:], strict=False)],
                    "values": [value[a:b].astype(np.float32) for a, b in zip(at, at[1:], strict=False)],
                    "stats": [s.astype(np.float32) for s in stats],
                }
            )


class Machine:
    """A fitted factorisation machine: inputs are ``STATS`` scaled statistics, then words."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> None:
        self.w0, self.w, self.v, self.mean, self.scale = w0, w, v, mean, scale

    def scores(self, texts: list[str | None]) -> np.ndarray:
        row, column, value, stats = _inputs(texts)
        n = len(texts)
        dense = np.clip((stats - self.mean) / self.scale, -4, 4) / np.sqrt(STATS)
        at = column + STATS
        linear = self.w0 + dense @ self.w[:STATS] + np.bincount(row, weights=self.w[at] * value, minlength=n)
        pair = np.zeros(n)
        for f in range(self.v.shape[1]):
            t = self.v[at, f] * value
            once = dense @ self.v[:STATS, f] + np.bincount(row, weights=t, minlength=n)
            squares = (dense**2) @ (self.v[:STATS, f] ** 2) + np.bincount(row, weights=t * t, minlength=n)
            pair += once * once - squares
        return 1 / (1 + np.exp(-np.clip(linear + pair / 2, -30, 30)))


def fit(sample: list, seed: int = SEED) -> Machine:
    """Adagrad on the logistic loss, classes weighted alike; ``sample`` holds rows of inputs."""
    labels = np.array([r["label"] for r in sample], dtype=np.float64)
    p = labels.mean() if len(labels) else 0.5
    rng = np.random.default_rng(seed)
    w = np.zeros(STATS + WORDS)
    v = rng.normal(0, 0.05, (STATS + WORDS, FACTORS))
    mean, scale = np.zeros(STATS), np.ones(STATS)
    if not len(labels) or not 0 < p < 1:
        v[:] = 0
        return Machine(float(np.clip(np.log(max(p, 1e-9) / max(1 - p, 1e-9)), -20, 20)), w, v, mean, scale)
    stats = np.array([r["stats"] for r in sample], dtype=np.float64)
    mean, scale = stats.mean(axis=0), stats.std(axis=0) + 1e-3
    dense = np.clip((stats - mean) / scale, -4, 4) / np.sqrt(STATS)
    rows = [(np.concatenate((np.arange(STATS), np.asarray(r["columns"], dtype=np.int64) + STATS)), np.concatenate((d, np.asarray(r["values"], dtype=np.float64)))) for r, d in zip(sample, dense, strict=True)]
    weight = np.where(labels == 1, 0.5 / p, 0.5 / (1 - p))
    w0, g0 = 0.0, 1e-6
    gw, gv = np.full(len(w), 1e-6), np.full(v.shape, 1e-6)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            va = v[at]
            once = x @ va
            z = w0 + x @ w[at] + 0.5 * float((once * once - (x * x) @ (va * va)).sum())
            g = weight[i] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i])
            g0 += g * g
            w0 -= RATE * g / np.sqrt(g0)
            d = g * x + DECAY * w[at]
            gw[at] += d * d
            w[at] -= RATE * d / np.sqrt(gw[at])
            d = g * (x[:, None] * once - va * (x * x)[:, None]) + DECAY * va
            gv[at] += d * d
            v[at] = va - RATE * d / np.sqrt(gv[at])
    # Classes were weighted alike; half of the sample's log odds goes back to the intercept.
    return Machine(w0 + float(np.log(p / (1 - p))) * 0.5, w, v, mean, scale)


def learned(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on labelled rows outside the held-out third."""
    bounded_batches(docs.sparkSession)
    known = labels.select("doc_id", F.col("quality").alias("label")).filter("doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id"), 3, 1))
    sure = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_high")).filter("label = _high").drop("_high")
    chosen = least_hashed(sure, "label", "doc_id", SAMPLE)  # at most 2 * SAMPLE ids
    picked = bounded_rows(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "label", SAMPLE)
    inputs = picked.mapInPandas(_rows, "doc_id long, label int, columns array<int>, values array<float>, stats array<float>")
    return fit(sorted(inputs.collect(), key=lambda r: (r["doc_id"], len(r["columns"]), r["stats"][0])))


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """All columns of ``docs`` and ``quality_score``."""
    model = docs.sparkSession.sparkContext.broadcast(machine)  # a few hundred kB, fixed

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = texts.tolist()
        out = [model.value.scores(rows[lo:hi]) for lo, hi in slices([len(t or "") for t in rows], CHUNK)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn("quality_score", score("text"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, learned(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
