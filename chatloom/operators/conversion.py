"""Conversions: turnarounds, lost deals, and which lost deals each turnaround is shown with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import domain
from ..functions.text import estimated_tokens, mentions_any, rendered, tokens_of, utc_date
from ..storage import saved
from .ordered import first_after, last_after, merged, windows_of, with_gaps
from .relational import numbered_within
from .scans import running


def _objection() -> Column:
    return F.col("first_objection_type").isNotNull() & F.col("first_objection_idx").isNotNull() & (F.col("first_objection_idx") >= 0) & (F.col("first_objection_idx") < F.col("n"))


def is_turnaround() -> Column:
    later = (F.col("resolution_idx") > F.col("first_objection_idx")) & (F.col("resolution_idx") < F.col("n"))
    return F.coalesce(_objection() & (F.col("conversion_score") >= 2) & later & (F.col("final_outcome") == "booked"), F.lit(False))


def is_lost_deal() -> Column:
    return F.coalesce(~is_turnaround() & _objection() & (F.col("conversion_score") <= 1) & (F.col("final_outcome") == "lost"), F.lit(False))


def paired(turnarounds: DataFrame, lost: DataFrame) -> DataFrame:
    """Add ``paired_lost_deals`` to ``turnarounds(chat_id, objection_type, conv_order)``.

    The lost deals of a type, by date, form a pool of size p. The k-th turnaround of the type
    gets places 2k and 2k+1 while there are such, the last and first at an odd end, then the
    first two for good.
    """
    pool = numbered_within(lost.select("objection_type", "date", "conv_order", "chat_id"), "objection_type", ["date", "conv_order"], "_slot").select("objection_type", "_slot", F.col("chat_id").alias("_lost"))
    sizes = pool.groupBy("objection_type").agg(F.count(F.lit(1)).alias("_p"))
    slim = turnarounds.select("chat_id", "objection_type", "conv_order")
    rows = numbered_within(slim, "objection_type", ["conv_order"], "_k").join(sizes, "objection_type", "left").withColumn("_p", F.coalesce("_p", F.lit(0)))
    i = F.col("_k") * 2
    slots = (
        F.when(F.col("_p") == 0, F.array().cast("array<bigint>"))
        .when(F.col("_p") == 1, F.array(F.lit(0).cast("long")))
        .when(i + 1 < F.col("_p"), F.array(i, i + 1))
        .when(i == F.col("_p") - 1, F.array(F.col("_p") - 1, F.lit(0).cast("long")))
        .otherwise(F.array(F.lit(0).cast("long"), F.lit(1).cast("long")))
    )
    wanted = rows.select("chat_id", "objection_type", "conv_order", F.posexplode_outer(slots).alias("_at", "_slot"))
    found = wanted.join(pool, ["objection_type", "_slot"], "left")
    ids = F.transform(F.array_sort(F.collect_list(F.when(F.col("_lost").isNotNull(), F.struct("_at", "_lost")))), lambda s: s["_lost"])
    return found.groupBy("chat_id", "objection_type", "conv_order").agg(ids.alias("paired_lost_deals"))


def located(detections: DataFrame, messages: DataFrame) -> DataFrame:
    """Message ids of a detection as places in its chat, with the winning reply's excerpt."""
    at = messages.select("chat_id", "msg_id", F.col("pos").cast("int").alias("pos"), "text")
    out = detections.join(at.select("chat_id", F.col("msg_id").alias("objection_msg_id"), F.col("pos").alias("first_objection_idx")), ["chat_id", "objection_msg_id"], "left")
    out = out.join(at.select("chat_id", F.col("msg_id").alias("resolution_msg_id"), F.col("pos").alias("resolution_idx"), F.col("text").alias("_reply")), ["chat_id", "resolution_msg_id"], "left")
    return out.withColumn("winning_reply_excerpt", F.substring(F.coalesce("winning_reply_excerpt", "_reply"), 1, domain.EXCERPT_CHARS)).drop("_reply")


def _line() -> Column:
    return rendered(F.col("msg_id"), F.col("from_me"), F.coalesce("text", F.lit("")))


def _gap_line() -> Column:
    """Fixed value: how messages that are left out read."""
    return F.concat(F.lit("[... "), F.col("gap").cast("string"), F.lit(" mensagens ...]"))


def shrunk_radius(chats: DataFrame, objections: DataFrame, messages: DataFrame, budget: int = domain.TOKEN_BUDGET, most: int = domain.RADIUS) -> DataFrame:
    """``chat_id, radius``: the widest windows around objections whose written transcript fits the budget, at least 0.

    The estimate of a text's tokens needs its characters alone, and these add up: lines, lines that
    tell a gap, and the ends of lines. All radii are tried at once: windows carry theirs, and a
    window costs the difference of two running sums.
    """
    lengths = messages.select("chat_id", "pos", (F.char_length(_line()) + 1).alias("chars"))
    sums = running(lengths, "chat_id", ["pos"], sums={"upto": F.col("chars")}).select("chat_id", (F.col("pos") + 1).alias("at"), "upto")
    tried = chats.select("chat_id", "n", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("radius"))
    spans = with_gaps(merged(windows_of(tried, objections, radius="radius")))
    told = F.when(F.col("gap") > 0, F.char_length(_gap_line()) + 1).otherwise(0)
    ends = F.array(F.struct(F.col("a").alias("at"), F.lit(-1).alias("sign"), told.alias("told")), F.struct(F.col("b").alias("at"), F.lit(1).alias("sign"), F.lit(0).alias("told")))
    edges = spans.select("chat_id", "radius", F.explode(ends).alias("e")).select("chat_id", "radius", "e.*")
    chars = edges.join(sums, ["chat_id", "at"], "left").groupBy("chat_id", "radius").agg((F.sum(F.col("sign") * F.coalesce("upto", F.lit(0)) + F.col("told")) - 1).alias("chars"))
    fits = tokens_of(F.col("chars")) <= budget
    return chars.groupBy("chat_id").agg(F.coalesce(F.max(F.when(fits, F.col("radius"))), F.lit(0)).alias("radius"))


def written(messages: DataFrame, objections: DataFrame, radius: DataFrame) -> DataFrame:
    """``chat_id, radius, transcript`` of the chats of ``radius(chat_id, n, radius)``."""
    spans = with_gaps(merged(windows_of(radius, objections, radius="radius")))
    places = spans.select("chat_id", "radius", "gap", F.posexplode(F.sequence("a", F.col("b") - 1)).alias("_k", "pos"))
    told = F.when((F.col("_k") == 0) & (F.col("gap") > 0), F.concat(_gap_line(), F.lit("\n"), _line())).otherwise(_line())
    said = messages.select("chat_id", "pos", "msg_id", "from_me", "text")
    lines = said.join(places, ["chat_id", "pos"]).select("chat_id", "radius", F.struct("pos", told.alias("line")).alias("s"))
    return lines.groupBy("chat_id", "radius").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["line"]), "\n").alias("transcript"))


def transcripts(messages: DataFrame, objections: DataFrame, budget: int = domain.TOKEN_BUDGET, tokens: Callable[[Column], Column] | None = None, most: int = domain.RADIUS) -> DataFrame:
    """``chat_id, radius, transcript, tokens`` of ``messages`` with ``pos``: the lines of the merged windows, gaps between them told.

    The radius is the widest at which the whole written text holds at most the budget; only at
    radius 0 may the head, the tail and the objections alone exceed it. ``tokens`` counts the tokens
    of a text. Without it they are estimated, and the radius is known before anything is written.
    A counter is asked about whole texts, as parts of a text may have fewer or more tokens than it has:
    all chats are written at the full radius, and those that don't fit again, each time one step
    narrower, until they do.
    """
    sizes = messages.groupBy("chat_id").agg(F.count(F.lit(1)).alias("n"))
    if tokens is None:
        out = written(messages, objections, sizes.join(shrunk_radius(sizes, objections, messages, budget, most), "chat_id"))
        return out.withColumn("tokens", estimated_tokens(F.col("transcript")))
    left, done = sizes, None
    for radius in range(most, -1, -1):
        tried = saved(written(messages, objections, left.withColumn("radius", F.lit(radius))).withColumn("tokens", tokens(F.col("transcript"))), f"transcripts-{radius}")
        fits = tried if radius == 0 else tried.filter(F.col("tokens") <= budget)
        done = fits if done is None else done.unionByName(fits)
        over = tried.filter(F.col("tokens") > budget).select("chat_id")
        if radius == 0 or over.isEmpty():
            break
        left = sizes.join(over, "chat_id")
    return done


def deals(conversions: DataFrame, messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turnarounds with their paired lost deals, and lost deals, of ``conversions`` in ``conv_order``.

    ``messages`` have ``pos``. A turnaround shows the objection, the reply that resolved it and the
    first confirmation after that; a lost deal the objection and the last reply after it.
    """
    sizes = messages.groupBy("chat_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("phone", "pos").alias("phone"))
    at = messages.select("chat_id", F.col("pos").alias("first_objection_idx"), "ts_ms", F.col("text").alias("customer_message"))
    rows = conversions.drop("phone", "n", "ts_ms").withColumn("first_objection_idx", F.col("first_objection_idx").cast("long")).join(sizes, "chat_id").join(at, ["chat_id", "first_objection_idx"])
    rows = saved(rows.withColumns({"date": utc_date(F.col("ts_ms")), "objection_type": F.col("first_objection_type")}), "deals")
    won, lost = rows.filter(is_turnaround()), rows.filter(is_lost_deal())
    reply = messages.select("chat_id", F.col("pos").alias("resolution_idx"), F.col("text").alias("winning_reply"), F.col("msg_id").alias("winning_reply_msg_id"))
    won = won.drop("winning_reply_excerpt").withColumn("resolution_idx", F.col("resolution_idx").cast("long")).join(reply, ["chat_id", "resolution_idx"])
    sure = first_after(messages, won.select("chat_id", F.col("resolution_idx").alias("mark")), ~F.col("from_me") & mentions_any(F.col("text"), list(domain.CONFIRMATIONS)))
    won = won.join(sure.select("chat_id", F.col("mark").alias("resolution_idx"), F.col("text").alias("confirmation")), ["chat_id", "resolution_idx"])
    last = last_after(messages, lost.select("chat_id", F.col("first_objection_idx").alias("mark")), F.col("from_me"))
    lost = lost.join(last.select("chat_id", F.col("mark").alias("first_objection_idx"), F.col("text").alias("winning_reply")), ["chat_id", "first_objection_idx"])
    shown = ["conv_order", "chat_id", "phone", "date", "objection_type", "customer_message", "winning_reply"]
    pairs = paired(won, lost).select("chat_id", "conv_order", "paired_lost_deals")
    won = won.select(*shown, "winning_reply_msg_id", "confirmation").join(pairs, ["chat_id", "conv_order"])
    return won, lost.select(*shown, F.lit("").alias("confirmation"))


def objections_by_chat(labelled: DataFrame) -> DataFrame:
    """``chat_id, objections``: a map from message to objection type, of customers' messages."""
    rows = labelled.filter("objection_type is not null and not from_me").groupBy("chat_id", "msg_id").agg(F.max("objection_type").alias("objection_type"))
    return rows.groupBy("chat_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("msg_id", "objection_type")))).alias("objections"))
