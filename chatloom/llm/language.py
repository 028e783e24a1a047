"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams of the lower-cased text are hashed to ``FEATURES`` columns. A
column's term frequency is its share of the text's n-grams, times the inverse document
frequency of the sample, times ``SCALE``. Weights are learned with
follow-the-regularised-leader (proximal, per-coordinate rates) under elastic-net penalties,
so most are exactly zero; a temperature fitted on rows that were not trained on calibrates
the scores.

The model is fitted on a bounded sample: up to ``SAMPLE`` rows of each language, those with
the least hash of their id; their n-gram counts are made where the rows are. Prediction reads
every whole text; language, source and id are never inputs.

Cases: a text that is null or has no letter is ``und`` with score 0; a row without language is
predicted, not learned from; rows that share a ``doc_id`` are predicted by their own text; a
null ``doc_id`` is predicted and never learned from; without any learnable row every text is
``und``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, bounded_batches, bounded_rows, least_hashed, mixed, slices, table
from .quality import held_out

FEATURES, GRAMS, SAMPLE, SCALE = 1 << 15, 3, 400, 20.0
#: Languages that are learned, the most frequent ones; each adds FEATURES weights to the model.
LANGS = 256
#: Follow-the-regularised-leader: rate, smoothing, L1 and L2 penalties, passes.
ALPHA, BETA, L1, L2, EPOCHS, SEED = 0.5, 1.0, 0.02, 0.05, 4, 11
#: One sampled row in this many calibrates instead of training.
CALIBRATES = 5
UNKNOWN = "und"
CHUNK = 1 << 19
_WORDLIKE = re.compile(r"[^\W\d_]")


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text and column of every character n-gram."""
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(U64)
    sizes = np.array([len(t) for t in low])
    doc = np.repeat(np.arange(len(low)), sizes)
    docs, columns = [], []
    with np.errstate(over="ignore"):
        h = np.zeros(len(code), dtype=U64)
        for n in range(1, GRAMS + 1):
            m = len(code) - n + 1
            if m <= 0:
                break
            h = h[:m] * U64(0x100000001B3) + code[n - 1 :] + U64(n)
            inside = doc[:m] == doc[n - 1 :]
            docs.append(doc[:m][inside])
            columns.append((mixed(h[inside]) >> U64(49)).astype(np.int32))
    return (np.concatenate(docs), np.concatenate(columns)) if docs else (np.zeros(0, np.int64), np.zeros(0, np.int32))


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        for lo, hi in slices([len(t or "") for t in texts], CHUNK):
            doc, column = _grams(texts[lo:hi])
            keys, n = np.unique(doc * FEATURES + column, return_counts=True)
            at = np.searchsorted(keys // FEATURES, np.arange(hi - lo + 1))
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[lo:hi], "lang": batch["lang"].to_numpy()[lo:hi], "columns": [(keys[a:b] % FEATURES).astype(np.int32) for a, b in zip(at, at[1:], strict=False)], "counts": [n[a:b].astype(np.int32) for a, b in zip(at, at[1:], strict=False)]})


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter; numerals such as fractions are none."""
    first = _WORDLIKE.search(text or "")
    return first is not None and (first[0].isalpha() or any(map(str.isalpha, text)))


class Model:
    """``table`` folds weights and inverse document frequencies: a score is a mean over n-grams."""

    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float) -> None:
        self.langs, self.table, self.bias, self.temperature = langs, weights.astype(np.float32), bias, temperature

    def logits(self, texts: list[str | None]) -> np.ndarray:
        doc, column = _grams(texts)
        total = np.maximum(np.bincount(doc, minlength=len(texts)), 1)
        return np.stack([np.bincount(doc, weights=self.table[column, k], minlength=len(texts)) / total for k in range(len(self.langs))], axis=1) + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = _softmax(self.logits(texts) / self.temperature)
        best = p.argmax(axis=1)
        known = np.array([has_letter(t) for t in texts], dtype=bool)
        return [self.langs[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)], np.where(known, p[np.arange(len(texts)), best], 0.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(sample: list) -> Model:
    rows = sorted((r for r in sample if len(r["columns"])), key=lambda r: (r["doc_id"], r["lang"], len(r["columns"])))
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return Model([], np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    df = np.zeros(FEATURES)
    for r in rows:
        df[r["columns"]] += 1
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    xs = []
    for r in rows:
        at, n = np.asarray(r["columns"], dtype=np.int64), np.asarray(r["counts"], dtype=np.float64)
        xs.append((at, n / n.sum() * idf[at] * SCALE, langs.index(r["lang"])))
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(xs))
    # Rows to calibrate on, unless there are too few.
    rest = order[::CALIBRATES] if len(xs) >= 10 * CALIBRATES else order
    train = np.setdiff1d(order, rest) if len(rest) < len(order) else order
    z, g2 = np.zeros((FEATURES, len(langs))), np.zeros((FEATURES, len(langs)))
    zb, gb = np.zeros(len(langs)), np.zeros(len(langs))

    def weights(z_: np.ndarray, g_: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z_) <= L1, 0.0, -(z_ - np.sign(z_) * L1) / ((BETA + np.sqrt(g_)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i in rng.permutation(train):
            at, x, y = xs[i]
            w, b = weights(z[at], g2[at]), -zb / ((BETA + np.sqrt(gb)) / ALPHA)
            p = _softmax(x @ w + b)
            p[y] -= 1
            g = x[:, None] * p
            new = g2[at] + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(g2[at])) / ALPHA * w
            g2[at] = new
            newb = gb + p * p
            zb += p - (np.sqrt(newb) - np.sqrt(gb)) / ALPHA * b
            gb = newb
    w, b = weights(z, g2), -zb / ((BETA + np.sqrt(gb)) / ALPHA)
    logits = np.stack([xs[i][1] @ w[xs[i][0]] + b for i in rest])
    truth = np.array([xs[i][2] for i in rest])

    # Smoothed targets: rows that are all right must not drive the temperature to nothing.
    sure = (len(truth) + 1) / (len(truth) + 2)

    def loss(t: float) -> float:
        p = np.maximum(_softmax(logits / t), 1e-300)
        right = p[np.arange(len(truth)), truth]
        return float(-(sure * np.log(right) + (1 - sure) * np.log(np.maximum(1 - right, 1e-300))).mean())

    lo, hi = np.log(0.05), np.log(20.0)
    for _ in range(60):  # the loss is unimodal in the temperature's logarithm: ternary search
        a, c = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        lo, hi = (lo, c) if loss(np.exp(a)) <= loss(np.exp(c)) else (a, hi)
    return Model(langs, w * (idf * SCALE)[:, None], b, float(np.exp((lo + hi) / 2)))


def learned(docs: DataFrame) -> Model:
    """Fit on up to ``SAMPLE`` rows of each of the ``LANGS`` most frequent languages, outside the held-out fourth."""
    bounded_batches(docs.sparkSession)
    known = docs.filter("doc_id is not null and lang is not null and text is not null").filter(~held_out(F.col("doc_id"), 4, 2)).select("doc_id", "lang", "text")
    langs = [r["lang"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGS).collect()]
    known = known.filter(F.col("lang").isin(langs)) if langs else known.limit(0)
    chosen = least_hashed(known.select("doc_id", "lang").distinct(), "lang", "doc_id", SAMPLE)  # SAMPLE * LANGS ids at most
    picked = bounded_rows(known.join(F.broadcast(chosen), ["doc_id", "lang"]), "lang", SAMPLE)
    return fit(picked.mapInPandas(_counts, "doc_id long, lang string, columns array<int>, counts array<int>").collect())


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES * languages * 4 bytes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in slices([len(t or "") for t in texts], CHUNK):
                langs, score = shared.value.predict(texts[lo:hi])
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[lo:hi].astype("Int64").to_numpy(), "lang_pred": langs, "score": score})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, lang_pred string, score double")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = predicted(docs, learned(docs))
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
