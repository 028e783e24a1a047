"""The generic tables seen as conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import table


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` without system turns as messages."""
    c = table(spark, sf_dir, "conversations").filter("role <> 'system'")
    return c.select(F.col("conv_id").alias("chat_id"), (F.col("conv_id") * 1000 + F.col("turn")).alias("msg_id"), (F.col("turn") * 1000).alias("ts_ms"), (F.col("role") == "assistant").alias("from_me"), "text")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as messages: views and sign-ups are the agent's, with their kind as the step."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    me = F.col("event_type").isin("view", "signup")
    return e.select(
        F.col("user_id").alias("chat_id"),
        F.col("event_id").alias("msg_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        me.alias("from_me"),
        F.col("event_type").alias("text"),
        F.when(me, F.col("event_type")).alias("step_id"),
        F.when(~me, F.when(k % 3 == 0, "on_script").when(k % 3 == 1, "off_script").otherwise("transition")).alias("step_context"),
        F.when(~me & (k % 5 != 0), F.concat(F.col("event_type"), F.lit("-"), (k % 7).cast("string"))).alias("intent"),
        F.when(~me & (k % 4 == 0), F.concat(F.lit("objection-"), (k % 9).cast("string"))).alias("objection_type"),
        k.alias("k"),
    )


#: The same view in SQL, for the oracles.
EVENT_SQL = """
ev as (select user_id as chat_id, event_id as msg_id, epoch_ms(ts) as ts_ms, event_type in ('view', 'signup') as from_me, event_type as text,
  cast(json_extract_string(props, '$.k') as integer) as k from events),
m as (select *, case when from_me then text end as step_id,
  case when not from_me then case k % 3 when 0 then 'on_script' when 1 then 'off_script' else 'transition' end end as step_context,
  case when not from_me and k % 5 <> 0 then text || '-' || (k % 7) end as intent,
  case when not from_me and k % 4 = 0 then 'objection-' || (k % 9) end as objection_type,
  row_number() over (partition by chat_id order by ts_ms, msg_id) - 1 as pos from ev)"""
CHAT_SQL = """
c0 as (select conv_id as chat_id, conv_id * 1000 + turn as msg_id, turn * 1000 as ts_ms, role = 'assistant' as from_me, text from conversations where role <> 'system'),
c as (select *, row_number() over (partition by chat_id order by ts_ms, msg_id) - 1 as pos from c0)"""


def event_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversion for each chat, from its first objection and the event after it."""
    from ..operators.ordered import positioned

    m = positioned(event_messages(spark, sf_dir))
    first = m.filter("objection_type is not null").groupBy("chat_id").agg(F.min("pos").alias("first_objection_idx"), F.min_by("objection_type", "pos").alias("first_objection_type"), F.min_by("k", "pos").alias("k"), F.min_by("ts_ms", "pos").alias("ts_ms"))
    n = m.groupBy("chat_id").agg(F.count(F.lit(1)).alias("n"))
    score = (F.col("k") % 4 + F.col("chat_id") % 4) % 4
    score = score.cast("int")
    return first.join(n, "chat_id").select(
        "chat_id",
        "n",
        "ts_ms",
        "first_objection_idx",
        "first_objection_type",
        (F.col("first_objection_idx") + 3).alias("resolution_idx"),
        score.alias("conversion_score"),
        F.when(score >= 2, "booked").when(score == 1, "lost").otherwise(F.when(F.col("chat_id") % 2 == 0, "lost").otherwise("ambiguous")).alias("final_outcome"),
        F.col("chat_id").alias("conv_order"),
        F.col("first_objection_type").alias("objection_type"),
    )


CONVERSION_SQL = (
    EVENT_SQL
    + """,
f as (select chat_id, min(pos) as first_objection_idx, arg_min(objection_type, pos) as first_objection_type, arg_min(k, pos) as k, arg_min(ts_ms, pos) as ts_ms from m where objection_type is not null group by chat_id),
conv0 as (select f.chat_id, n, f.ts_ms, first_objection_idx, first_objection_type, first_objection_idx + 3 as resolution_idx, (f.k % 4 + f.chat_id % 4) % 4 as conversion_score, f.chat_id as conv_order, first_objection_type as objection_type
  from f join (select chat_id, count(*) as n from m group by chat_id) z on z.chat_id = f.chat_id),
conv as (select *, case when conversion_score >= 2 then 'booked' when conversion_score = 1 then 'lost' when chat_id % 2 = 0 then 'lost' else 'ambiguous' end as final_outcome from conv0),
turn as (select * from conv where first_objection_idx < n and conversion_score >= 2 and resolution_idx > first_objection_idx and resolution_idx < n and final_outcome = 'booked'),
lost as (select * from conv where first_objection_idx < n and conversion_score <= 1 and final_outcome = 'lost')"""
)
