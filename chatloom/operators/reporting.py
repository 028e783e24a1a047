"""Report payload, CSV rows and Markdown repair."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import utc_date


def outcome_counts(conversions: DataFrame) -> DataFrame:
    return conversions.agg(*[F.count_if(F.col("final_outcome") == o).alias(o) for o in ("booked", "lost", "ambiguous")], F.count(F.lit(1)).alias("total"))


def histogram(rows: DataFrame, value: str) -> DataFrame:
    """How often each value stands; null is none."""
    return rows.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))


def deal_rows(deals: DataFrame, chat_labels: DataFrame, limit: int | None = None) -> DataFrame:
    """CSV rows of turnarounds or lost deals with their phone's labels, in list order."""
    rows = deals.withColumn("date", utc_date(F.col("ts_ms"))).join(chat_labels, "phone", "left").withColumn("labels", F.coalesce("labels", F.lit("")))
    return rows if limit is None else rows.orderBy("conv_order").limit(limit)


def repaired_headers(text: str, headers: list[str], stub: str = "(sem dados — stub)") -> str:
    """Numbered second-level headers in their canonical wording, indented ones too; missing ones appended with a stub.

    The stub's wording is a fixed value.
    """
    wanted = {m[1]: h for h in headers if (m := re.match(r"##\s*(\d+)\.", h))}
    seen: set[str] = set()
    lines = []
    for line in text.splitlines():
        m = re.match(r"\s*##\s*(\d+)\.", line)
        if m and m[1] in wanted:
            seen.add(m[1])
            line = wanted[m[1]]
        lines.append(line)
    for number, header in wanted.items():
        if number not in seen:
            lines += ["", header, stub]
    return "\n".join(lines).rstrip() + "\n"
