"""Sharding: contiguous shards of near-equal bytes from global prefix sums.

Rows are put in order of ``doc_id`` and cut where the running byte count passes equal
targets. The running count is never made in one task: rows are dealt to ranges of ids,
each range sums its own rows, the (few) range totals are summed in order, and both sums
together give every row its place.

Cases: a null text has size 1 and the CRC of the empty text; a null ``doc_id`` sorts first;
rows that share a ``doc_id`` are neighbours, ordered by CRC and size (rows alike in all three
are interchangeable); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import range_bounds, range_bucket, saved, table

#: Rows of a range: what one task sorts and sums (24 bytes each).
ROWS_PER_RANGE = 2_000


def prefix_sums(rows: DataFrame, order: list[str], size: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``row_before``, ``bytes_before`` (sums over all earlier rows) and ``total``."""
    bounds = range_bounds(rows, order[0], rows_per_range)
    dealt = rows.withColumn("_range", range_bucket(F.col(order[0]), bounds))
    totals = dealt.groupBy("_range").agg(F.sum(size).alias("_b"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range, of which there are at most 20,001, whatever the input.
    starts = totals.select(
        "_range",
        F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b0"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.sum("_b").over(Window.partitionBy()).alias("total"),
    )
    own = Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    upto = own.rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("_bi", F.coalesce(F.sum(size).over(upto), F.lit(0)))
        .withColumn("_ni", F.row_number().over(own) - 1)
        .join(F.broadcast(starts), "_range")
        .withColumn("bytes_before", F.col("_b0") + F.col("_bi"))
        .withColumn("row_before", F.col("_n0") + F.col("_ni"))
        .drop("_range", "_b0", "_n0", "_bi", "_ni")
    )


def contiguous_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    # Texts are read once; all that follows works on three numbers a row.
    placed = saved(prefix_sums(saved(slim, "shard-sizes"), ["doc_id", "text_crc32", "size"], "size"), "shard-prefix")
    middle = F.col("bytes_before") * 2 + F.col("size")
    shard = F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / (F.col("total") * 2)).cast("int"))
    cut = placed.withColumn("shard", shard)
    firsts = cut.groupBy("shard").agg(F.min("row_before").alias("_first"))  # one row a shard
    return cut.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row_before") - F.col("_first")).alias("slot"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contiguous_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
