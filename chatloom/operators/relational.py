"""Loading operators: base scan, label exclusion, thresholds and limits over chats."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import saved
from .scans import running


def base_scan(message: DataFrame, chat: DataFrame, jid: DataFrame, from_ms: int | None = None, phones: list[str] | None = None) -> DataFrame:
    """Text messages of one-to-one chats with their phone; both filters hold when both are given."""
    rows = message.filter("message_type = 0 and text_data is not null")
    if from_ms is not None:
        rows = rows.filter(F.col("timestamp") >= F.lit(from_ms))
    names = jid.select(F.col("_id").alias("jid_row_id"), F.col("user").alias("phone"))
    if phones is not None:
        names = names.filter(F.col("phone").isin(phones))
    chats = chat.filter("group_type = 0").select(F.col("_id").alias("chat_row_id"), "jid_row_id")
    return rows.join(chats, "chat_row_id").join(names, "jid_row_id")


def excluded_keys(links: DataFrame, labels: DataFrame, names: list[str], key: str, label_key: str) -> DataFrame:
    """Distinct non-null keys that carry one of the labels ``names`` (compared trimmed)."""
    chosen = labels.filter(F.trim("label_name").isin(names)).select(label_key)
    return links.join(chosen, label_key, "left_semi").filter(F.col(key).isNotNull()).select(key).distinct()


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return rows.join(keys, key, "left_anti")


def sized(rows: DataFrame, chat: str = "chat_id") -> DataFrame:
    """Add ``n_messages`` of the row's chat; counted apart, so that a huge chat is not one task."""
    return rows.join(rows.groupBy(chat).agg(F.count(F.lit(1)).alias("n_messages")), chat)


def long_chats(rows: DataFrame, least: int, limit: int | None = None, chat: str = "chat_id") -> DataFrame:
    """Ids and sizes of chats with at least ``least`` messages, the first ``limit`` by id."""
    out = rows.groupBy(chat).agg(F.count(F.lit(1)).alias("n_messages")).filter(F.col("n_messages") >= least)
    return out if limit is None else out.orderBy(chat).limit(limit)


def busiest(rows: DataFrame, k: int, chat: str = "chat_id") -> DataFrame:
    """The ``k`` chats of most messages with how many each side wrote; the first id among equals."""
    out = rows.groupBy(chat).agg(F.count(F.lit(1)).alias("n_messages"), F.count_if("from_me").alias("agent"), F.count_if(~F.col("from_me")).alias("customer"))
    return out.orderBy(F.desc("n_messages"), chat).limit(k)


def labels_per_key(links: DataFrame, key: str, name: str) -> DataFrame:
    return links.groupBy(key).agg(F.array_join(F.sort_array(F.collect_set(name)), ";").alias("labels"))


def numbered(rows: DataFrame, order: list, name: str = "idx") -> DataFrame:
    """A global 0-based row number without a single-task window.

    Rows are range-partitioned by ``order``, numbered inside their partition, and shifted by
    the counts of the partitions before (one row a partition). The partitioned rows are stored
    first: ranges come from a sample, so a plan that made them twice could deal rows differently.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    # The id counts up inside a partition from partition << 33.
    parts = parts.withColumn("_p", F.shiftright("_m", 33)).withColumn("_i", F.col("_m").bitwiseAND((1 << 33) - 1)).drop("_m")
    parts = saved(parts, "numbered")
    counts = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))  # one row a partition
    return parts.join(F.broadcast(starts), "_p").withColumn(name, F.col("_s") + F.col("_i")).drop("_p", "_i", "_s")


def numbered_within(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """0-based row numbers inside each ``group``; a large group is numbered in segments."""
    return running(rows, group, order, sums={name: F.lit(1)}).withColumn(name, (F.col(name) - 1).cast("long"))
