"""Operators that depend on the order of messages in a chat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import domain
from ..functions.formats import chat_line
from ..functions.text import stripped
from .scans import running, segmented


#: How messages of a chat follow each other; a null time comes first.
ORDER = ["ts_ms", "msg_id"]


def positioned(messages: DataFrame) -> DataFrame:
    """Add ``pos``: the 0-based place in the chat."""
    return running(messages, "chat_id", ORDER, sums={"pos": F.lit(1)}).withColumn("pos", (F.col("pos") - 1).cast("long"))


def nested(messages: DataFrame) -> DataFrame:
    """``chat_id, messages``: each chat's messages in order, as structs of all other columns."""
    rest = [c for c in messages.columns if c not in ("chat_id", "ts_ms", "msg_id")]
    return messages.groupBy("chat_id").agg(F.array_sort(F.collect_list(F.struct("ts_ms", "msg_id", *rest))).alias("messages"))


def written_out(messages: DataFrame) -> DataFrame:
    """``chat_id, chat``: each chat for people to read, a head and its lines; the raw text of a message if it has one.

    Fixed value: how the head reads.
    """
    said = F.coalesce(F.nullif("text_raw", F.lit("")), "text")
    lines = messages.select("chat_id", *ORDER, "phone", chat_line(F.col("ts_ms"), F.col("from_me"), said).alias("line"))
    chats = lines.groupBy("chat_id").agg(F.min_by("phone", F.struct(*ORDER)).alias("phone"), F.array_sort(F.collect_list(F.struct(*ORDER, "line"))).alias("m"))
    head = F.concat(F.lit("chat_id="), F.col("chat_id").cast("string"), F.lit("  phone="), F.coalesce("phone", F.lit("")), F.lit("  msgs="), F.size("m").cast("string"))
    return chats.select("chat_id", F.array_join(F.concat(F.array(head, F.lit("-" * 60)), F.transform("m", lambda m: m["line"])), "\n").alias("chat"))


def with_parent_step(messages: DataFrame) -> DataFrame:
    """As-of join, backward: the last non-empty step an agent was at, else unknown."""
    step = F.when(F.col("from_me") & (F.col("step_id") != ""), F.col("step_id"))
    return running(messages, "chat_id", ORDER, lasts={"parent_step": step}).withColumn("parent_step", F.coalesce("parent_step", F.lit(domain.UNKNOWN)))


def with_hints(messages: DataFrame, keep: int = domain.HINT_MESSAGES, chars: int = domain.HINT_CHARS) -> DataFrame:
    """``chat_id, msg_id, hints`` of customers' messages: the last ``keep`` agent texts before each, oldest first.

    In a segment a text is a few places back among those that are there; what is missing comes from
    the last few of the segments before.
    """
    text = stripped(F.col("text"))
    rows = messages.select("chat_id", *ORDER, "from_me", F.when(F.col("from_me") & (text != ""), F.substring(text, 1, chars)).alias("_t"))
    rows, several = segmented(rows, "chat_id", ORDER)
    back = [f"lag(_t, {k}) ignore nulls over (partition by chat_id, _seg order by {', '.join(ORDER)})" for k in range(keep, 0, -1)]
    out = rows.withColumn("_last", F.expr(f"filter(array({', '.join(back)}), t -> t is not null)"))
    if several:
        own = F.concat("_last", F.array("_t"))
        ends = out.groupBy("chat_id", "_seg").agg(F.max_by(own, F.when(F.col("_t").isNotNull(), F.struct(*ORDER))).alias("_end"))
        before = Window.partitionBy("chat_id").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)  # a row a segment
        ends = ends.select(F.col("chat_id").alias("_g"), F.col("_seg").alias("_s"), F.flatten(F.collect_list(_ending("_end", keep)).over(before)).alias("_before"))
        out = out.join(ends, F.col("chat_id").eqNullSafe(F.col("_g")) & (F.col("_seg") == F.col("_s"))).withColumn("_last", F.concat(F.coalesce("_before", F.array().cast("array<string>")), "_last"))
    return out.filter("not from_me").select("chat_id", "msg_id", F.array_join(_ending("_last", keep), " | ").alias("hints"))


def _ending(name: str, n: int) -> Column:
    return F.slice(name, F.greatest(F.size(name) - n + 1, F.lit(1)), F.lit(n))


def batches(rows: DataFrame, size: int, number: str = "idx") -> DataFrame:
    return rows.withColumn("batch", F.floor(F.col(number) / size).cast("long"))


def windows_of(sizes: DataFrame, objections: DataFrame, head: int = domain.HEAD, tail: int = domain.TAIL, radius: int | str = domain.RADIUS) -> DataFrame:
    """``chat_id, a, b`` intervals [a, b) of a transcript: its head, its tail, around objections.

    ``radius`` is a number, or the name of a column that ``sizes`` has besides ``chat_id`` and ``n``;
    all such columns are kept.
    """
    n, keys = F.col("n"), [c for c in sizes.columns if c != "n"]
    reach = F.col(radius) if isinstance(radius, str) else F.lit(radius)
    ends = sizes.select(*keys, "n", F.explode(F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(head).cast("long").alias("b")), F.struct((n - tail).alias("a"), n.alias("b")))).alias("w"))
    around = objections.join(sizes, "chat_id").select(*keys, "n", F.struct((F.col("pos") - reach).alias("a"), (F.col("pos") + reach + 1).alias("b")).alias("w"))
    clipped = ends.unionByName(around).select(*keys, F.greatest(F.col("w.a"), F.lit(0)).alias("a"), F.least(F.col("w.b"), F.col("n")).alias("b"))
    return clipped.filter("a < b")


def merged(intervals: DataFrame) -> DataFrame:
    """Overlapping or touching intervals of a chat (or of any other columns) as one: gaps and islands."""
    keys = [c for c in intervals.columns if c not in ("a", "b")]
    order = Window.partitionBy(*keys).orderBy("a", "b")
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("_new", F.when(reach.isNull() | (F.col("a") > reach), 1).otherwise(0))
    island = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return island.groupBy(*keys, "_island").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("_island")


def with_gaps(islands: DataFrame) -> DataFrame:
    """Add ``gap``: messages left out between an interval and the one before it (of equal other columns)."""
    keys = [c for c in islands.columns if c not in ("a", "b")]
    return islands.withColumn("gap", F.coalesce(F.col("a") - F.lag("b").over(Window.partitionBy(*keys).orderBy("a")), F.lit(0)).cast("long"))


def first_after(messages: DataFrame, marks: DataFrame, wanted: Column) -> DataFrame:
    """For each ``marks(chat_id, mark)`` the text of the first wanted message after the mark, or ''.

    Marks and wanted messages are one ordered table, passed once from its end: a mark takes what
    was met last. So a mark costs a row, not a row for each message after it.
    """
    said = messages.filter(wanted).select("chat_id", (-F.col("pos")).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("mark"), F.struct("text").alias("_t"))
    asked = marks.select("chat_id", (-F.col("mark")).alias("_at"), F.lit(0).alias("_kind"), F.col("mark").cast("long").alias("mark"), F.lit(None).cast("struct<text:string>").alias("_t"))
    # A message at its mark's own place comes after the mark on the way back: it isn't taken.
    met = running(said.unionByName(asked), "chat_id", ["_at", "_kind"], lasts={"_next": F.col("_t")})
    return met.filter("_kind = 0").select("chat_id", "mark", F.coalesce("_next.text", F.lit("")).alias("text"))


def last_after(messages: DataFrame, marks: DataFrame, wanted: Column) -> DataFrame:
    """For each ``marks(chat_id, mark)`` the text of the chat's last wanted message if it comes after the mark, or ''."""
    last = messages.filter(wanted).groupBy("chat_id").agg(F.max("pos").alias("_pos"), F.max_by("text", "pos").alias("_text"))
    found = marks.join(last, "chat_id", "left")
    return found.select(*marks.columns, F.when(F.col("_pos") > F.col("mark"), F.coalesce("_text", F.lit(""))).otherwise("").alias("text"))


def tertiles(chats: DataFrame, size: str, order: str) -> DataFrame:
    """Strata 0, 1, 2 by size, cut at n div 3 and 2n div 3 of the sorted chats."""
    from .relational import numbered

    n = chats.count()
    rows = numbered(chats, [F.col(size), F.col(order)])
    return rows.withColumn("stratum", F.when(F.col("idx") < n // 3, 0).when(F.col("idx") < 2 * n // 3, 1).otherwise(2))
