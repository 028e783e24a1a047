"""Substring dedup: every repeat of a window of words, found in super-k-mer buckets.

A window is ``WINDOW`` consecutive words of one document. Its minimiser is the least hash
among its ``GRAM``-word grams; consecutive windows mostly share theirs, and such a run travels
as one packed string (a super-k-mer) to the bucket of the minimiser. Equal windows have equal
minimisers, so each bucket counts its windows exactly by sorting them. All but the earliest
of equal windows (by ``doc_id``, then start) mark the words they cover for removal.

Scale: before the shuffle a task keeps one copy of each super-k-mer and settles the others
itself, so a passage that a third of all rows share is sent once a task. Minimisers that a
sample shows to be hot (say, within a common line) are split further by the second least
hash; that only changes which bucket a window goes to, never a result. Packed strings are
compressed, and buckets grow in number, not in size, with the input.

Cases: a null text has no words; documents shorter than a window are kept whole; rows that
share a ``doc_id`` count as one place in the order, and windows that start at the same word
there are both kept; a null ``doc_id`` comes last; an empty table gives an empty result; a
very long text is worked on whole; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Words, bounded_batches, mixed, slices, table

WINDOW, GRAM = 20, 4
#: Bytes of text hashed together, of packed strings a task holds, and of those in a bucket.
CHUNK, HELD, BUCKET = 1 << 20, 48 << 20, 16 << 20
#: Share of documents looked at for hot minimisers (one in ``SAMPLED``).
SAMPLED = 32
LAST = np.iinfo(np.int64).max
PACKED = "bucket int, words binary, places binary"
RANGES = "doc long, text_key int, lo int, hi int"
_PLACE = np.dtype([("doc", "<i8"), ("key", "<i4"), ("start", "<i4"), ("size", "<i4")])

with np.errstate(over="ignore"):
    MULT = mixed(np.arange(1, WINDOW + 1, dtype=U64)) | U64(1)


def _sums(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive word hashes."""
    n = max(0, len(h) - width + 1)
    out = np.zeros(n, dtype=U64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out += h[k : k + n] * MULT[k]
        return mixed(out)


def _least(g: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` consecutive values, by doubling."""
    n, have = len(g) - width + 1, 1
    while have < width:
        step = min(have, width - have)
        g = np.minimum(g[: len(g) - step], g[step:])
        have += step
    return g[:n]


class _Runs:
    """Runs of consecutive windows that go to one bucket."""

    def __init__(self, w: Words, hot: np.ndarray) -> None:
        grams = _sums(w.h, GRAM)
        span = WINDOW - GRAM + 1
        n = len(w.h) - WINDOW + 1
        if n <= 0:
            self.first = self.last = np.zeros(0, dtype=np.int64)
            self.key = np.zeros(0, dtype=U64)
            return
        least = _least(grams, span)
        key = mixed(least)
        if len(hot):
            at = np.flatnonzero(np.isin(least, hot))
            if len(at):
                inner = grams[at[:, None] + np.arange(span)]
                second = np.where(inner == least[at, None], U64(2**64 - 1), inner).min(axis=1)
                with np.errstate(over="ignore"):
                    key[at] = mixed(key[at] + mixed(second))
        inside = w.doc[:n] == w.doc[WINDOW - 1 :]
        change = np.concatenate(([True], (key[1:] != key[:-1]) | (w.doc[1:n] != w.doc[: n - 1]) | ~inside[:-1]))
        starts = np.flatnonzero(change & inside)
        ends = np.flatnonzero(np.concatenate((change[1:] | ~inside[1:], [True])) & inside)
        self.first, self.last, self.key, self.least = starts, ends, key[starts], least[starts]


def _normal(w: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by single spaces, and each one's byte range there."""
    b = w.bytes.copy()
    b[w.hi] = 32
    keep = np.zeros(len(b) + 1, dtype=np.int8)
    keep[w.lo] += 1
    keep[w.hi + 1] -= 1
    sizes = w.hi - w.lo
    lo = np.cumsum(sizes + 1) - sizes - 1
    return b[np.cumsum(keep[:-1]).astype(bool)].tobytes(), lo, lo + sizes


def _packed(hot: np.ndarray, buckets: int) -> object:
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, tuple] = {}
        repeats: list[tuple] = []
        ties: list[tuple[bytes, tuple]] = []
        held = 0
        for batch in batches:
            texts, docs, keys = batch["text"].tolist(), batch["doc"].tolist(), batch["text_key"].tolist()
            for lo, hi in slices([len(t or "") for t in texts], CHUNK):
                w = Words(texts[lo:hi])
                runs = _Runs(w, hot)
                flat, nlo, nhi = _normal(w)
                place = (runs.first - w.first[w.doc[runs.first]]).tolist() if len(runs.first) else []
                to = (runs.key % U64(buckets)).tolist()
                for d, s, a, e, size, bucket in zip(w.doc[runs.first].tolist(), place, nlo[runs.first].tolist(), nhi[runs.last + WINDOW - 1].tolist(), (runs.last - runs.first + 1).tolist(), to, strict=True):
                    words = flat[a:e]
                    mine = (docs[lo + d], keys[lo + d], s, size, bucket)
                    other = seen.get(words)
                    if other is None:
                        seen[words] = mine
                        held += e - a + 150
                    elif (mine[0], s) < (other[0], other[2]):
                        seen[words] = mine
                        repeats.append(other)
                        held += 60
                    elif (mine[0], s) > (other[0], other[2]):
                        repeats.append(mine)
                        held += 60
                    elif mine[1] != other[1]:  # another text of the same id: which is a repeat, only the bucket knows
                        ties.append((words, mine))
                        held += e - a + 60
                if held > HELD:
                    yield flush(seen, repeats, ties)
                    seen, repeats, ties, held = {}, [], [], 0
        if seen or repeats:
            yield flush(seen, repeats, ties)

    def flush(seen: dict[bytes, tuple], repeats: list[tuple], ties: list[tuple[bytes, tuple]]) -> pd.DataFrame:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        by: dict[int, list] = {}
        for words, place in itertools.chain(seen.items(), ties):
            by.setdefault(place[4], []).append((words, place))
        for items in by.values():  # like strings side by side
            items.sort()
        rows = [(b, squeeze(b"\n".join(x[0] for x in items)), squeeze(np.array([x[1][:4] for x in items], dtype=_PLACE).tobytes())) for b, items in by.items()]
        for lo in range(0, len(repeats), 50_000):
            part = repeats[lo : lo + 50_000]
            rows.append((part[0][4], None, squeeze(np.array([x[:4] for x in part], dtype=_PLACE).tobytes())))
        return pd.DataFrame(rows, columns=["bucket", "words", "places"])

    return pack


def _merged(doc: np.ndarray, key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pd.DataFrame:
    """Overlapping or touching ranges of one text as one."""
    order = np.lexsort((lo, key, doc))
    doc, key, lo, hi = doc[order], key[order], lo[order], hi[order]
    if len(lo):
        fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
        # Ends rise with starts here, but for runs of different length: take the running maximum in each text.
        text = np.cumsum(fresh)
        top = np.maximum.accumulate(text * np.int64(1 << 32) + hi)
        new = fresh | np.concatenate(([True], lo[1:] + (text[1:] * np.int64(1 << 32)) > top[:-1]))
        at = np.flatnonzero(new)
        ends = np.concatenate((at[1:], [len(lo)])) - 1
        doc, key, lo, hi = doc[at], key[at], lo[at], top[ends] & np.int64(0xFFFFFFFF)
    return pd.DataFrame({"doc": doc, "text_key": key, "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)})


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    """Ranges of words that windows of this bucket remove."""
    grow = zstandard.ZstdDecompressor().decompress
    strings: list[bytes] = []
    places, repeats = [np.zeros(0, dtype=_PLACE)], [np.zeros(0, dtype=_PLACE)]
    for words, place in zip(pdf["words"], pdf["places"], strict=True):
        p = np.frombuffer(grow(place), dtype=_PLACE)
        if words is None:
            repeats.append(p)
        else:
            strings += grow(words).split(b"\n")
            places.append(p)
    place, repeat = np.concatenate(places), np.concatenate(repeats)
    if strings:
        w = Words(strings)
        del strings, places
        n = len(w.h) - WINDOW + 1
        # Numbers of words fit 32 bits in a bucket; arrays go as soon as they are used.
        at = np.flatnonzero(w.doc[:n] == w.doc[WINDOW - 1 :]).astype(np.int32)
        hashed = _sums(w.h, WINDOW)[at]
        owner = w.doc[at].astype(np.int32)
        w.h = w.doc = w.bytes = None
        doc, start = place["doc"][owner], (place["start"][owner] + (at - w.first[owner])).astype(np.int32)
        order = np.lexsort((start, doc, hashed))
        hashed, doc, start = hashed[order], doc[order], start[order]
        at, owner = at[order], owner[order]
        leads = np.concatenate(([True], hashed[1:] != hashed[:-1]))
        del order, hashed
        leader = np.flatnonzero(leads).astype(np.int32)[np.cumsum(leads, dtype=np.int32) - 1]
        # A place repeated under one doc_id is no repeat of itself.
        later = np.flatnonzero((doc != doc[leader]) | (start != start[leader]))
        raw, lo, hi = w.raw, w.lo[at], w.hi[at + WINDOW - 1]

        def same(part: np.ndarray) -> bool:
            to = leader[part]
            return all(raw[a:b] == raw[c:d] for a, b, c, d in zip(lo[part].tolist(), hi[part].tolist(), lo[to].tolist(), hi[to].tolist(), strict=True))

        if not all(same(later[k : k + (1 << 16)]) for k in range(0, len(later), 1 << 16)):  # two different windows share a hash: tell them apart by their words
            keep, firsts = [], {}
            for i in range(len(at)):
                mine = firsts.setdefault(raw[lo[i] : hi[i]], (doc[i], start[i]))
                if mine != (doc[i], start[i]):
                    keep.append(i)
            later = np.array(keep, dtype=np.int64)
        key = place["key"][owner[later]]
        doc, start = doc[later], start[later].astype(np.int64)
    else:
        doc = start = np.zeros(0, dtype=np.int64)
        key = np.zeros(0, dtype=np.int32)
    lo = np.concatenate((start, repeat["start"].astype(np.int64)))
    hi = np.concatenate((start + WINDOW, repeat["start"].astype(np.int64) + repeat["size"] - 1 + WINDOW))
    return _merged(np.concatenate((doc, repeat["doc"])), np.concatenate((key, repeat["key"])), lo, hi)


def _minimisers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        for lo, hi in slices([len(t or "") for t in texts], CHUNK):
            runs = _Runs(Words(texts[lo:hi]), np.zeros(0, dtype=U64))
            if len(runs.first):
                value, count = np.unique(runs.least, return_counts=True)
                yield pd.DataFrame({"least": value.view(np.int64), "n": count})


def repeated_ranges(rows: DataFrame) -> DataFrame:
    """``doc, text_key, lo, hi``: words to remove of ``rows(doc, text_key, text)``."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-3 * size // BUCKET))
    counts = rows.filter(F.pmod(F.xxhash64("text_key"), F.lit(SAMPLED)) == 0).select("text").mapInPandas(_minimisers, "least long, n long")
    # A run of windows is about 200 bytes; what fills a fourth of a bucket is hot. At most some
    # four values a bucket can be, so this list is bounded by the number of buckets.
    often = max(8, BUCKET // (4 * 200 * SAMPLED))
    hot = np.array([r[0] for r in counts.groupBy("least").agg(F.sum("n").alias("n")).filter(F.col("n") >= often).select("least").collect()], dtype=np.int64).view(U64)
    packed = rows.mapInPandas(_packed(hot, buckets), PACKED)
    return packed.groupBy("bucket").applyInPandas(_count, RANGES)


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts, ranges = batch["text"].tolist(), batch["ranges"].tolist()
        out = []
        for lo, hi in slices([len(t or "") for t in texts], CHUNK):
            w = Words(texts[lo:hi])
            flat, nlo, nhi = _normal(w)
            for i in range(hi - lo):
                a, b = int(w.first[i]), int(w.first[i + 1])
                gone = 0
                if b == a:
                    kept = b""
                elif ranges[lo + i] is None or not len(ranges[lo + i]):
                    kept = flat[nlo[a] : nhi[b - 1]]
                else:
                    spans = sorted((r["lo"], r["hi"]) for r in ranges[lo + i])
                    parts, at = [], 0
                    for s, e in spans:
                        if s > at:
                            parts.append(flat[nlo[a + at] : nhi[a + s - 1]])
                        if e > at:
                            gone += e - max(s, at)
                            at = e
                    if a + at < b:
                        parts.append(flat[nlo[a + at] : nhi[b - 1]])
                    kept = b" ".join(parts)
                out.append((b - a, gone, kept.decode("utf-8", "surrogatepass")))
        frame = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text"])
        frame.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
        yield frame


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(int(LAST))).alias("doc"), F.hash("text").alias("text_key"), "text")
    ranges = repeated_ranges(rows.drop("doc_id"))
    by_text = ranges.groupBy("doc", "text_key").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))  # of one text
    full = rows.join(by_text, ["doc", "text_key"], "left").select("doc_id", "text", "ranges")
    return full.mapInPandas(_removed, "doc_id long, n_words long, n_removed long, kept_text string")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
