"""Scalar text functions as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the source data's producer counts it: Unicode spaces and the four separators.
_SPACE = r"[\s\x1c-\x1f\x85]"


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(text, f"(?U){_SPACE}+", " "))


def clean_text(text: Column) -> Column:
    """Drop http(s) links, then squeeze white space."""
    return squeeze(F.regexp_replace(text, r"(?U)https?://[^\s\x1c-\x1f\x85]+", ""))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def ascii_fold(text: Column) -> Column:
    """Compatibility-decompose, drop what is not ASCII, lower, strip (Arrow: Spark has no NFKD).

    Texts that are ASCII already never leave the JVM.
    """

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower().strip())

    # Else a filter on the result is pushed under it, and every text is folded twice.
    fold = fold.asNondeterministic()
    wide = text.rlike(r"[^\x00-\x7f]")
    plain = F.regexp_replace(F.lower(text), r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return F.when(wide, fold(F.when(wide, text))).otherwise(plain)


def counted_tokens(count: Callable[[list[str]], list[int]]) -> Callable[[Column], Column]:
    """A token counter as an expression, from a function of a batch of texts; null counts none."""

    @F.pandas_udf("long")
    def counted(s: pd.Series) -> pd.Series:
        return pd.Series(count([t or "" for t in s]), dtype="int64")

    return counted


def tokens_of(chars: Column) -> Column:
    """The estimate for a text of so many characters."""
    return F.greatest(F.lit(1), F.floor(chars / 4)).cast("long")


def estimated_tokens(text: Column) -> Column:
    return tokens_of(F.char_length(text))


def vocabulary_tokens(path: str) -> Callable[[Column], Column]:
    """Tokens by a vocabulary file of a public tokenizer, which all executors can read."""
    held: list = []

    def count(texts: list[str]) -> list[int]:
        if not held:
            import tokenizers

            held.append(tokenizers.Tokenizer.from_file(path))
        return [len(e.ids) for e in held[0].encode_batch(texts, add_special_tokens=False)]

    return counted_tokens(count)


def utc_date(ts_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ts_ms), "yyyy-MM-dd")


#: The words for the two sides of a transcript.
AGENT, CUSTOMER = "spa", "cli"


def rendered(msg_id: Column, from_me: Column, text: Column) -> Column:
    """A transcript line."""
    return F.concat(F.lit("["), msg_id.cast("string"), F.lit("] "), F.when(from_me, AGENT).otherwise(CUSTOMER), F.lit(": "), text)


def set_hash(values: Column, digits: int = 16) -> Column:
    """Aggregate: a hash of the set of values, whatever their order."""
    return F.substring(F.sha2(F.array_join(F.sort_array(F.collect_set(values)), ","), 256), 1, digits)


def mentions_any(text: Column, phrases: list[str]) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(low, F.lit(phrase))
    return found
