"""Running sums and last values along ordered groups, of which one may hold most of all rows.

A group of up to ``SEGMENT`` rows is one window. Larger ones are cut into segments: their rows are
range-partitioned by group and order, scanned inside a segment, and what the segments before hold
(a row a segment) is added. So no task holds a large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import saved

SEGMENT = 1_000_000


def segmented(rows: DataFrame, group: str, order: list[str], most: int | None = None) -> tuple[DataFrame, bool]:
    """``rows`` with a segment ``_seg`` that follows ``order`` in each ``group``, and whether any group has several.

    The rows of large groups are stored: ranges come from a sample, so a plan that made them twice
    could deal them differently.
    """
    most = most or SEGMENT
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select(F.col(group).alias("_large"), "_n")
    total = sizes.agg(F.sum("_n")).first()[0]
    if total is None:
        return rows.withColumn("_seg", F.lit(0)), False
    sizes = saved(sizes, "large-groups")
    of = F.col(group).eqNullSafe(F.col("_large"))
    large = rows.join(sizes, of, "left_semi").repartitionByRange(max(2, -(-2 * total // most)), group, *order)
    large = saved(large.withColumn("_seg", F.spark_partition_id()), "segments")
    return rows.join(sizes, of, "left_anti").withColumn("_seg", F.lit(0)).unionByName(large), True


def running(rows: DataFrame, group: str, order: list[str], sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, most: int | None = None) -> DataFrame:
    """``rows`` with running sums and last values that are not null, up to and with each row by ascending ``order``.

    Nulls count nothing in a sum; a last value is null while there is none.
    """
    sums, lasts = sums or {}, lasts or {}
    rows, several = segmented(rows, group, order, most)
    # Within a segment; the expressions see the columns of ``rows``.
    inside = Window.partitionBy(group, "_seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()} | {n: F.last(c, ignorenulls=True).over(inside) for n, c in lasts.items()}
    out = rows.withColumns(local)
    if not several:
        return out.drop("_seg")
    at = F.struct(*order)
    held = rows.groupBy(group, "_seg").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()], *[F.max_by(c, F.when(c.isNotNull(), at)).alias(n) for n, c in lasts.items()])
    before = Window.partitionBy(group).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)  # a row a segment
    carried = held.select(F.col(group).alias("_g"), F.col("_seg").alias("_s"), *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in sums], *[F.last(n, ignorenulls=True).over(before).alias(f"_{n}") for n in lasts])
    whole = out.join(carried, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_seg") == F.col("_s")))
    whole = whole.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums} | {n: F.coalesce(n, f"_{n}") for n in lasts})
    return whole.drop("_g", "_s", "_seg", *[f"_{n}" for n in (*sums, *lasts)])
