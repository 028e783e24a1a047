"""Best-fit packing: hierarchical residual packing of token sequences.

A document's token ids, followed by an end id, are one item; longer ones are cut so that only
the first piece can be shorter than a sequence. Items are dealt to groups, each group packs
best-fit decreasing on its own and emits the bins that are nearly full. Underfull bins travel
on as items of the next round, in fewer groups, until one group holds all that is left or a
round no longer merges anything. A group's size is bounded by how many groups there are, so
no task holds an unbounded part.

Cases: a null text is empty and gives one piece with the end id alone; rows that share a
``doc_id`` give pieces each, told apart by their sequences and offsets; an empty table gives
an empty result; a text of any length is tokenised whole; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, saved, table

#: Tokens of a sequence, and the id that ends a document.
CAPACITY, END_ID = 2048, 0
#: A bin with at most this many tokens free is emitted before the last round.
NEARLY = 8
#: Items that one group packs.
GROUP_ITEMS = 16_384

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", bin long, offset long, filled long, done boolean"


_ENCODERS: dict[str, Callable[[str], np.ndarray]] = {}
#: Fixed value: how the byte-level pre-tokeniser of these vocabularies parts a text.
_PARTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids by the vocabulary file at ``path``, kept by the worker process.

    The file is one of ``tokenizers``. Where its merges are numbered in their order, as byte-level
    vocabularies have them, a merge's rank is its token's id, and ``tiktoken`` gives the same ids
    in an eighth of the time; any other file is left to ``tokenizers``.
    """
    if path not in _ENCODERS:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _ENCODERS[path] = _ranked(spec) or _plain(path)
    return _ENCODERS[path]


def _plain(path: str) -> Callable[[str], np.ndarray]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


def _ranked(spec: dict) -> Callable[[str], np.ndarray] | None:
    model, parts = spec["model"], spec.get("pre_tokenizer") or {}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges") or []]
    vocab, special = model["vocab"], {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}.items() <= parts.items() and not spec.get("normalizer")
    plain = plain and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or any(t[k] for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
        return None
    # Byte-level files write a byte as a printable character: itself, or one from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)) or any(ranks.get(bytes([b]), 256) > 255 for b in range(256)) or len(ranks) != 256 + len(pairs):
        return None
    import tiktoken

    found = tiktoken.Encoding("ranked", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: found.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


def tokenised(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: ``doc_id, piece, start, length, ids_crc32``."""
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                blob = ids(text or "").tobytes() + end
                n = len(blob) // 4
                pieces = -(-n // capacity)
                hi = n - (pieces - 1) * capacity
                lo = 0
                for k in range(pieces):
                    rows.append((doc, k, lo, hi - lo, zlib.crc32(blob[4 * lo : 4 * hi])))
                    lo, hi = hi, hi + capacity
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select("doc_id", "text").mapInPandas(cut, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin of each item and its place there.

    Open bins stand in stacks by free room; a bit set of the non-empty stacks finds the
    tightest one that fits.
    """
    order = np.argsort(-sizes, kind="stable")
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_, bins = 0, 0
    bin_of = np.empty(len(sizes), dtype=np.int64)
    at = np.empty(len(sizes), dtype=np.int64)
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = open_ >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                open_ ^= 1 << room
        else:
            b, room = bins, capacity
            bins += 1
        bin_of[i], at[i] = b, capacity - room
        room -= size
        if room:
            if not stacks[room]:
                open_ |= 1 << room
            stacks[room].append(b)
    return bin_of, at


def _pack(capacity: int, nearly: int, round_: int) -> object:
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["_group"].iloc[0])
        pdf = pdf.sort_values(["bin", "doc_id", "piece", "offset", "start", "ids_crc32"], kind="stable", ignore_index=True)
        item, first = np.unique(pdf["bin"].to_numpy(), return_index=True)
        of = np.searchsorted(item, pdf["bin"].to_numpy())
        sizes = pdf["filled"].to_numpy()[first]
        bin_of, at = best_fit(sizes, capacity)
        filled = np.bincount(bin_of, weights=sizes).astype(np.int64)
        pdf["offset"] = pdf["offset"].to_numpy() + at[of]
        pdf["bin"] = (np.int64(round_) << 56) | (np.int64(group) << 24) | bin_of[of]
        pdf["filled"] = filled[bin_of[of]]
        pdf["done"] = pdf["filled"] >= capacity - nearly
        return pdf.drop(columns="_group")

    return pack


def packed(pieces: DataFrame, capacity: int = CAPACITY, nearly: int = NEARLY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``pieces`` must be a stored table)."""
    unit = F.monotonically_increasing_id()
    left = pieces.withColumns({"bin": unit, "offset": F.lit(0).cast("long"), "filled": F.col("length"), "done": F.lit(False)})
    items = pieces.count()
    out, round_ = [], 1
    while items:
        groups = -(-items // group_items)
        dealt = left.withColumn("_group", F.pmod(F.xxhash64("bin"), F.lit(groups)))
        now = saved(dealt.groupBy("_group").applyInPandas(_pack(capacity, nearly, round_), PLACED), f"packing-{round_}")
        rest = now.filter(~F.col("done"))
        after = rest.agg(F.count_distinct("bin")).first()[0]
        if groups == 1 or after >= 0.98 * items:
            out.append(now)
            break
        out.append(now.filter("done"))
        left, items, round_ = rest, after, round_ + 1
    if not out:
        out = [left]
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole.withColumnRenamed("bin", "sequence_id").drop("filled", "done")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = saved(tokenised(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")), "packing-pieces")
    return packed(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
