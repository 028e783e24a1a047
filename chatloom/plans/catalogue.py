"""The operators as queries over the generic tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import clusters, conversion, enrichment, evaluation, ordered, relational, reporting, templates
from ..storage import saved, table
from .adapters import CHAT_SQL, CONVERSION_SQL, EVENT_SQL, chat_messages, event_conversions, event_messages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _parents(spark: SparkSession, d: str) -> DataFrame:
    return ordered.with_parent_step(event_messages(spark, d))


_PARENT = EVENT_SQL + ", p as (select *, coalesce(last_value(step_id ignore nulls) over (partition by chat_id order by ts_ms, msg_id rows between unbounded preceding and current row), 'unknown') as parent_step from m)"


@query(f"with {_PARENT} select chat_id, msg_id, parent_step from p")
def parent_step_asof(spark: SparkSession, d: str) -> DataFrame:
    return _parents(spark, d).select("chat_id", "msg_id", "parent_step")


@query(f"with {_PARENT} select parent_step, count(*) filter (where step_context = 'on_script') as on_script_count, count(*) filter (where step_context = 'off_script') as off_script_count, count(intent) as intents, count(objection_type) as objections from p where not from_me and parent_step <> 'unknown' group by parent_step")
def per_step_counts(spark: SparkSession, d: str) -> DataFrame:
    return clusters.step_counts(_parents(spark, d))


def _top_sql(value: str) -> str:
    return f"""with {_PARENT}, n as (select parent_step, {value}, count(*) as n, min(msg_id) as f from p where not from_me and {value} is not null group by all)
select parent_step, {value}, n, rank from (select *, row_number() over (partition by parent_step order by n desc, f) as rank from n) where rank <= 5"""


@query(_top_sql("intent"))
def top_values_per_step(spark: SparkSession, d: str) -> DataFrame:
    return templates.top_values(_parents(spark, d).filter("not from_me"), "parent_step", "intent", "msg_id")


@query(_top_sql("objection_type"))
def top_objections_per_step(spark: SparkSession, d: str) -> DataFrame:
    return templates.top_values(_parents(spark, d).filter("not from_me"), "parent_step", "objection_type", "msg_id")


@query(f"""with {CHAT_SQL}, a as (select chat_id, pos, substring(trim(text), 1, 140) as t from c where from_me and trim(text) <> ''),
h as (select c.chat_id, c.msg_id, a.pos as ap, t, row_number() over (partition by c.chat_id, c.msg_id order by a.pos desc) as r from c left join a on a.chat_id = c.chat_id and a.pos < c.pos where not from_me)
select chat_id, msg_id, coalesce(string_agg(t, ' | ' order by ap), '') as hints from h where r <= 3 group by chat_id, msg_id""")
def agent_hint_last3(spark: SparkSession, d: str) -> DataFrame:
    return ordered.with_hints(chat_messages(spark, d))


@query(f"with {EVENT_SQL} select chat_id, msg_id, pos from m")
def message_positions(spark: SparkSession, d: str) -> DataFrame:
    return ordered.positioned(event_messages(spark, d)).select("chat_id", "msg_id", "pos")


@query(r"select page_id, trim(regexp_replace(regexp_replace('see ' || url || '  now ' || html, 'https?://[^\s\x1c-\x1f\x85\x{a0}\x{2028}\x{2029}\x{202f}\x{3000}]+', '', 'g'), '[\s\x0b\x1c-\x1f\x85\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1680}]+', ' ', 'g')) as cleaned from pages")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", tx.clean_text(F.concat(F.lit("see "), "url", F.lit("  now "), "html")).alias("cleaned"))


@query(r"select doc_id, norm from (select doc_id, trim(lower(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') as norm from documents) where norm <> ''")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.ascii_fold(F.col("text")).alias("norm")).filter("norm <> ''")


@query("""select l_orderkey, l_linenumber, l_partkey, c_name, c_nationkey from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
where l_returnflag = 'A' and l_shipdate >= timestamp '1996-01-01' and o_orderstatus = 'F' and l_quantity is not null""")
def base_scan_join(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.when(F.col("l_returnflag") == "A", 0).otherwise(1).alias("message_type"), F.col("l_quantity").alias("text_data"), F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp"), F.col("l_orderkey").alias("chat_row_id"), "l_linenumber", "l_partkey")
    chats = table(spark, d, "orders").select(F.col("o_orderkey").alias("_id"), F.col("o_custkey").alias("jid_row_id"), F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("group_type"))
    jids = table(spark, d, "customer").select(F.col("c_custkey").alias("_id"), F.col("c_name").alias("user"), "c_nationkey")
    out = relational.base_scan(lines, chats, jids, from_ms=820454400000)
    return out.join(jids.select(F.col("_id").alias("jid_row_id"), "c_nationkey"), "jid_row_id").select(F.col("chat_row_id").alias("l_orderkey"), "l_linenumber", "l_partkey", F.col("phone").alias("c_name"), "c_nationkey")


def _excluded(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("label_id"))
    labels = table(spark, d, "nation").select(F.col("n_nationkey").alias("label_id"), F.col("n_name").alias("label_name"))
    return relational.excluded_keys(links, labels, ["NATION_1", "NATION_5", "NATION_9"], "c_custkey", "label_id")


_EXCLUDED = "(select c_custkey from customer join nation on n_nationkey = c_nationkey where trim(n_name) in ('NATION_1', 'NATION_5', 'NATION_9'))"


@query(f"select o_orderkey, o_custkey from orders where o_custkey not in {_EXCLUDED}")
def exclude_labelled(spark: SparkSession, d: str) -> DataFrame:
    return relational.without(table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), _excluded(spark, d), "c_custkey").withColumnRenamed("c_custkey", "o_custkey")


@query(f"select count(distinct o_custkey) as excluded_chats from orders where o_custkey in {_EXCLUDED}")
def excluded_distinct_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).join(_excluded(spark, d), "c_custkey", "left_semi").agg(F.count_distinct("c_custkey").alias("excluded_chats"))


@query("select s_nationkey, string_agg(distinct r, ';' order by r) as labels from (select s_nationkey, n_name || '/' || r_name as r from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey) group by 1")
def labels_per_entity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return relational.labels_per_key(rows.withColumn("r", F.concat_ws("/", "n_name", "r_name")), "s_nationkey", "r")


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def missing_keys(spark: SparkSession, d: str) -> DataFrame:
    return relational.without(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING' and c_acctbal > 5000)")
def phones_semi_filter(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING' and c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(wanted, "o_custkey", "left_semi")


@query("select user_id as chat_id, count(*) as n_messages, count(*) >= 60 as long from events group by user_id")
def long_short_split(spark: SparkSession, d: str) -> DataFrame:
    return relational.long_chats(event_messages(spark, d), 0).withColumn("long", F.col("n_messages") >= 60)


@query("select event_id as msg_id, user_id as chat_id from events where user_id in (select user_id from events group by user_id having count(*) >= 60 order by user_id limit 10)")
def chat_limit_first_n(spark: SparkSession, d: str) -> DataFrame:
    m = event_messages(spark, d).select("msg_id", "chat_id")
    return m.join(relational.long_chats(m, 60, limit=10), "chat_id", "left_semi")


@query("select user_id as chat_id, count(*) as n_messages from events where ts >= timestamp '2024-01-10' group by user_id having count(*) >= 40")
def date_filter_then_threshold(spark: SparkSession, d: str) -> DataFrame:
    return relational.long_chats(event_messages(spark, d).filter(F.col("ts_ms") >= 1704844800000), 40)


@query(f"with {CHAT_SQL} select chat_id, msg_id, cast((row_number() over (order by chat_id, ts_ms, msg_id) - 1) // 15 as bigint) as batch from c where not from_me")
def batch_packing(spark: SparkSession, d: str) -> DataFrame:
    rows = relational.numbered(chat_messages(spark, d).filter("not from_me").select("chat_id", "ts_ms", "msg_id"), [F.col("chat_id"), F.col("ts_ms"), F.col("msg_id")])
    return ordered.batches(rows, 15).select("chat_id", "msg_id", "batch")


@query(f"""with {CHAT_SQL} select msg_id, chat_id, from_me, case when from_me and quality is not null then 'q' || quality end as step_id,
coalesce(case when from_me then case quality when 1 then 'on_script' when 0 then 'off_script' end else case when toxic = 1 then 'off_script' when toxic = 0 then 'on_script' end end, 'unknown') as step_context
from c left join labels on doc_id = msg_id % 997""")
def merge_label_left_joins(spark: SparkSession, d: str) -> DataFrame:
    m = chat_messages(spark, d)
    labels = table(spark, d, "labels")
    known = labels.select(F.col("doc_id").alias("template_id"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("step_id"), (F.col("quality") == 1).alias("matches_script"), F.lit(None).cast("string").alias("deviation_note"))
    theirs = m.select("msg_id", (F.col("msg_id") % 997).alias("doc_id")).join(labels, "doc_id").select("msg_id", F.when(F.col("toxic") == 1, "off_script").otherwise("on_script").alias("step_context"), *[F.lit(None).cast("string").alias(c) for c in ("intent", "objection_type", "sentiment")])
    out = enrichment.merged_labels(m, m.select("msg_id", (F.col("msg_id") % 997).alias("template_id")), known, theirs)
    return out.select("msg_id", "chat_id", "from_me", "step_id", "step_context")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def resume_pending_anti(spark: SparkSession, d: str) -> DataFrame:
    return enrichment.pending(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


_MENTIONS = "contains(lower(text), 'the ') or contains(lower(text), ' en ')"


@query(f"with {CHAT_SQL} select chat_id, msg_id, pos, text from c where not from_me and ({_MENTIONS})")
def objection_rows(spark: SparkSession, d: str) -> DataFrame:
    return ordered.positioned(chat_messages(spark, d)).filter(~F.col("from_me") & tx.mentions_any(F.col("text"), ["the ", " en "])).select("chat_id", "msg_id", "pos", "text")


def _windows(spark: SparkSession, d: str) -> DataFrame:
    m = ordered.positioned(event_messages(spark, d))
    return ordered.merged(ordered.windows_of(m.groupBy("chat_id").agg(F.count(F.lit(1)).alias("n")), m.filter("objection_type is not null").select("chat_id", "pos")))


_ISLANDS = EVENT_SQL + """, z as (select chat_id, count(*) as n from m group by chat_id),
w0 as (select chat_id, n, 0 as a, 15 as b from z union all select chat_id, n, n - 15, n from z union all select m.chat_id, n, pos - 10, pos + 11 from m join z on z.chat_id = m.chat_id where objection_type is not null),
w as (select chat_id, greatest(a, 0) as a, least(b, n) as b from w0 where greatest(a, 0) < least(b, n)),
w1 as (select *, max(b) over (partition by chat_id order by a, b rows between unbounded preceding and 1 preceding) as r from w),
w2 as (select *, sum(case when r is null or a > r then 1 else 0 end) over (partition by chat_id order by a, b rows unbounded preceding) as i from w1),
isl as (select chat_id, min(a)::bigint as a, max(b)::bigint as b from w2 group by chat_id, i)"""


@query(f"with {_ISLANDS} select * from isl")
def window_merge_islands(spark: SparkSession, d: str) -> DataFrame:
    return _windows(spark, d)


@query(f"with {_ISLANDS} select *, coalesce(a - lag(b) over (partition by chat_id order by a), 0)::bigint as gap from isl")
def window_gaps(spark: SparkSession, d: str) -> DataFrame:
    return ordered.with_gaps(_windows(spark, d))


#: The text of every transcript at every radius, written out.
_WRITTEN = EVENT_SQL + """, z as (select chat_id, count(*) as n from m group by chat_id), r as (select unnest(range(0, 11)) as radius),
o as (select chat_id, pos from m where objection_type is not null),
w as (select z.chat_id, radius, 0 as a, least(15, n) as b from z, r union all select z.chat_id, radius, greatest(n - 15, 0), n from z, r union all select o.chat_id, radius, greatest(pos - radius, 0), least(pos + radius + 1, n) from o join z on z.chat_id = o.chat_id, r),
x as (select distinct w.chat_id, radius, pos, '[' || msg_id || '] ' || case when from_me then 'spa' else 'cli' end || ': ' || text as line from w join m on m.chat_id = w.chat_id and pos >= a and pos < b),
y as (select *, pos - lag(pos) over (partition by chat_id, radius order by pos) - 1 as gap from x),
t as (select chat_id, radius, string_agg(case when gap > 0 then '[... ' || gap || ' mensagens ...]' || chr(10) || line else line end, chr(10) order by pos) as transcript from y group by chat_id, radius),
best as (select chat_id, coalesce(max(radius) filter (where greatest(1, length(transcript) // 4) <= 260), 0)::integer as radius from t group by chat_id)"""


@query(f"with {_WRITTEN} select * from best")
def transcript_radius(spark: SparkSession, d: str) -> DataFrame:
    m = ordered.positioned(event_messages(spark, d))
    sizes = m.groupBy("chat_id").agg(F.count(F.lit(1)).alias("n"))
    return conversion.shrunk_radius(sizes, m.filter("objection_type is not null").select("chat_id", "pos"), m, budget=260)


@query(f"with {_WRITTEN} select t.*, greatest(1, length(transcript) // 4)::bigint as tokens from t join best on best.chat_id = t.chat_id and best.radius = t.radius")
def transcripts_in_budget(spark: SparkSession, d: str) -> DataFrame:
    m = ordered.positioned(event_messages(spark, d))
    return conversion.transcripts(m, m.filter("objection_type is not null").select("chat_id", "pos"), budget=260)


@query(f"with {_ISLANDS} select m.chat_id, msg_id, '[' || msg_id || '] ' || case when from_me then 'spa' else 'cli' end || ': ' || text as line from m join isl on isl.chat_id = m.chat_id and pos >= a and pos < b")
def transcript_slice(spark: SparkSession, d: str) -> DataFrame:
    m = ordered.positioned(event_messages(spark, d))
    # Islands become positions, so that the join is on equal keys.
    places = _windows(spark, d).select("chat_id", F.explode(F.sequence(F.col("a"), F.col("b") - 1)).alias("pos"))
    return m.join(places, ["chat_id", "pos"]).select("chat_id", "msg_id", tx.rendered(F.col("msg_id"), F.col("from_me"), F.col("text")).alias("line"))


_DEAL = "chat_id, first_objection_idx, resolution_idx, conversion_score, first_objection_type"


@query(f"with {CONVERSION_SQL} select {_DEAL} from turn")
def turnaround_rows(spark: SparkSession, d: str) -> DataFrame:
    return event_conversions(spark, d).filter(conversion.is_turnaround()).select(*_DEAL.split(", "))


@query(f"with {CONVERSION_SQL} select {_DEAL} from lost")
def lost_deal_rows(spark: SparkSession, d: str) -> DataFrame:
    return event_conversions(spark, d).filter(conversion.is_lost_deal()).select(*_DEAL.split(", "))


@query(f"with {CHAT_SQL}, k as (select chat_id, min(pos) as mark from c where from_me group by chat_id) select k.chat_id, k.mark, coalesce((select arg_min(text, pos) from c where c.chat_id = k.chat_id and pos > k.mark and not from_me and ({_MENTIONS})), '') as text from k")
def first_confirmation_after(spark: SparkSession, d: str) -> DataFrame:
    c = ordered.positioned(chat_messages(spark, d))
    return ordered.first_after(c, c.filter("from_me").groupBy("chat_id").agg(F.min("pos").alias("mark")), ~F.col("from_me") & tx.mentions_any(F.col("text"), ["the ", " en "]))


@query(f"with {CONVERSION_SQL} select l.chat_id, l.first_objection_idx as mark, coalesce((select arg_max(text, pos) from m where m.chat_id = l.chat_id and pos > l.first_objection_idx and from_me), '') as text from lost l")
def last_reply_after(spark: SparkSession, d: str) -> DataFrame:
    marks = event_conversions(spark, d).filter(conversion.is_lost_deal()).select("chat_id", F.col("first_objection_idx").alias("mark"))
    return ordered.last_after(ordered.positioned(event_messages(spark, d)), marks, F.col("from_me"))


@query(f"""with {CONVERSION_SQL}, pool as (select objection_type, chat_id, row_number() over (partition by objection_type order by strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d'), conv_order) - 1 as s from lost),
t as (select turn.chat_id, turn.objection_type, row_number() over (partition by turn.objection_type order by conv_order) - 1 as k, coalesce((select count(*) from pool where pool.objection_type = turn.objection_type), 0) as p from turn),
s as (select *, case when p = 0 then [] when p = 1 then [0] when 2 * k + 1 < p then [2 * k, 2 * k + 1] when 2 * k = p - 1 then [p - 1, 0] else [0, 1] end as slots from t),
x as (select s.chat_id, s.objection_type, i, pool.chat_id as lost_id from s, unnest(range(1, greatest(len(slots), 1) + 1)) as u(i) left join pool on pool.objection_type = s.objection_type and pool.s = slots[i])
select chat_id, objection_type, coalesce(string_agg(lost_id::varchar, ',' order by i), '') as paired from x group by all""")
def turnaround_pairing(spark: SparkSession, d: str) -> DataFrame:
    rows = saved(event_conversions(spark, d).withColumn("date", tx.utc_date(F.col("ts_ms"))), "conversions")
    out = conversion.paired(rows.filter(conversion.is_turnaround()), rows.filter(conversion.is_lost_deal()))
    return out.select("chat_id", "objection_type", F.array_join(F.transform("paired_lost_deals", lambda x: x.cast("string")), ",").alias("paired"))


@query(f"with {CONVERSION_SQL} select count(*) filter (where final_outcome = 'booked') as booked, count(*) filter (where final_outcome = 'lost') as lost, count(*) filter (where final_outcome = 'ambiguous') as ambiguous, count(*) as total from conv")
def outcome_counts(spark: SparkSession, d: str) -> DataFrame:
    return reporting.outcome_counts(event_conversions(spark, d))


_TEMPLATE = """with g as (select text, count(*) as instance_count, min(doc_id) as least, max(doc_id) as last_seen_ts from documents where text is not null group by text)
select row_number() over (order by instance_count desc, least) - 1 as template_id, text as canonical_text, instance_count, least as first_seen_ts, last_seen_ts,
(select string_agg(doc_id::varchar, ',' order by doc_id) from (select doc_id from documents e where e.text = g.text order by doc_id limit 5)) as examples from g"""


@query(_TEMPLATE)
def exact_dup_templates(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter("text is not null").select(F.col("doc_id").alias("load_idx"), F.col("doc_id").alias("msg_id"), F.col("doc_id").alias("ts_ms"), "text", F.sha2("text", 256).alias("key"))
    out = templates.template_rows(rows, "key")
    return out.select("template_id", "canonical_text", "instance_count", "first_seen_ts", "last_seen_ts", F.array_join(F.transform("example_msg_ids", lambda x: x.cast("string")), ",").alias("examples"))


@query("with g as (select text, count(*) as n, min(doc_id) as least from documents where text is not null group by text), t as (select text, row_number() over (order by n desc, least) - 1 as template_id from g) select doc_id as msg_id, template_id from documents join t using (text)")
def template_map(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter("text is not null")
    rows = rows.select(F.col("doc_id").alias("load_idx"), F.col("doc_id").alias("msg_id"), F.col("doc_id").alias("ts_ms"), "text", F.sha2("text", 256).alias("key"))
    return rows.select("key", "msg_id").join(templates.template_rows(rows, "key").select("key", "template_id"), "key").select("msg_id", "template_id")


#: Stars of four documents: an edge rule that covers all of them and leaves many components.
_EDGES = "select doc_id as a, cast(floor(doc_id / 4) * 4 + 1 as bigint) as b from documents"


@query(f"with recursive e0 as ({_EDGES}), e as (select a, b from e0 where a <> b union select b, a from e0 where a <> b), r(id, x) as (select a, a from e union select r.id, e.b from r join e on e.a = r.x) select id, min(x) as component from r group by id")
def connected_components(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.graph import components

    return components(table(spark, d, "documents").select(F.col("doc_id").alias("a"), (F.floor(F.col("doc_id") / 4) * 4 + 1).alias("b")))


@query(r"""with t as (select item_id, list_sort(list_distinct(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''))) as w from benchmark), u as (select conv_id * 1000 + turn as msg_id, list_sort(list_distinct(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''))) as w from conversations where role <> 'system')
select item_id, msg_id, len(list_intersect(t.w, u.w))::integer as shared from t join u on len(list_intersect(t.w, u.w)) >= 8""")
def token_containment_pairs(spark: SparkSession, d: str) -> DataFrame:
    return templates.sharing_words(table(spark, d, "benchmark"), "item_id", chat_messages(spark, d), "msg_id", 8)


def _fuzzy_input(spark: SparkSession, d: str) -> DataFrame:
    """Texts no longer than a message can be, which is what templates are made of."""
    rows = table(spark, d, "documents").filter("n_chars <= 1500").select(F.col("doc_id").alias("msg_id"), "text")
    return rows.withColumn("load_idx", F.col("msg_id")).withColumn("ts_ms", F.col("msg_id")).withColumn("norm", tx.ascii_fold(F.col("text")))


@query()
def fuzzy_templates(spark: SparkSession, d: str) -> DataFrame:
    out, _ = templates.fuzzy_templates(saved(_fuzzy_input(spark, d), "fuzzy-input"))
    return out.select("template_id", "canonical_text", "instance_count", "first_seen_ts", "last_seen_ts")


@query()
def fuzzy_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = saved(_fuzzy_input(spark, d).filter("norm <> ''").groupBy("norm").agg(F.min("load_idx").alias("id")), "fuzzy-input")
    return templates.fuzzy_links(rows).select("a", "b", F.round("score", 4).alias("score"))


@query(r"""with v as (select norm, min(doc_id) as id from (select doc_id, trim(lower(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') as norm from documents where n_chars <= 1500) where norm <> '' group by norm),
l as (select *, length(array_to_string(w, ' ')) as n from (select id, list_sort(list_distinct(list_filter(string_split_regex(norm, '\s+'), lambda x: x <> ''))) as w from v) where len(w) > 0),
p as (select a.id as a, b.id as b, a.n as la, b.n as lb, least(len(a.w), len(b.w)) as k, list_sort(list_intersect(a.w, b.w)) as i from l a join l b on a.id < b.id),
s as (select a, b, case when len(i) = k then 100.0 else greatest(200.0 * c / (c + la), 200.0 * c / (c + lb)) end as score from (select *, length(array_to_string(i, ' ')) as c from p) where len(i) > 0)
select a, b, round(score, 4)::double as score from s where score >= 87.5""")
def fuzzy_links_by_words(spark: SparkSession, d: str) -> DataFrame:
    """The links that word containment and length ratios give; those by letters alone are beyond SQL."""
    rows = _fuzzy_input(spark, d).filter("norm <> ''").groupBy("norm").agg(F.min("load_idx").alias("id"))
    return templates.links_by_words(saved(templates.worded(rows), "fuzzy-words"), 87.5).select("a", "b", F.round("score", 4).alias("score"))


_UNIT = "u as (select vec_id, label, list_transform(embedding, lambda x: x::double / nullif(sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double))), 0)) as v from embeddings)"


@query(f"with {_UNIT}, c as (select a.label, a.vec_id, sum(1 - list_dot_product(a.v, b.v)) as s from u a join u b on a.label = b.label group by all) select label, arg_min(vec_id, (round(s, 6), vec_id)) as medoid, count(*) as size from c group by label")
def cosine_medoid(spark: SparkSession, d: str) -> DataFrame:
    return clusters.medoids(table(spark, d, "embeddings"), "label", "vec_id", "embedding")


@query(f"with {_UNIT} select a.label, a.vec_id, round(min(1 - list_dot_product(a.v, b.v)), 6) as core from u a join u b on a.label = b.label and a.vec_id <> b.vec_id group by all")
def core_distance(spark: SparkSession, d: str) -> DataFrame:
    return clusters.nearest_distance(table(spark, d, "embeddings"), "label", "vec_id", "embedding")


@query(f"""with recursive {_UNIT}, n as (select *, row_number() over (partition by label order by vec_id) as i from u),
d as (select a.label, a.i, list(greatest(1 - list_dot_product(a.v, b.v), 0) order by b.i) as ds from n a join n b on a.label = b.label group by all),
prim(label, edges, weight, best) as (
  select label, 0, 0.0::double, list_transform(ds, lambda x, k: case when k > 1 then x end) from d where i = 1
  union all
  select p.label, edges + 1, weight + list_min(best), list_transform(best, lambda x, k: case when x is not null and k <> j then least(x, ds[k]) end)
  from (select *, list_position(best, list_min(best)) as j from prim where list_min(best) is not null) p join d on d.label = p.label and d.i = p.j)
select label, max(edges)::bigint as edges, round(max(weight), 5) as weight from prim group by label having max(edges) > 0""")
def density_tree(spark: SparkSession, d: str) -> DataFrame:
    """The least spanning tree of each bucket, block by block."""
    tree = clusters.spanning_tree(table(spark, d, "embeddings"), "label", "vec_id", "embedding", block=64)
    return tree.groupBy("label").agg(F.count(F.lit(1)).alias("edges"), F.round(F.sum("w"), 5).alias("weight"))


@query()
def hdbscan_per_bucket(spark: SparkSession, d: str) -> DataFrame:
    return clusters.density_clusters(table(spark, d, "embeddings"), "label", "vec_id", "embedding")


def _scored(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("template_id"), F.col("n_chars").alias("instance_count"))
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("template_id"), (F.col("doc_id") % 5 + 1).alias("warmth"), F.when(F.col("quality") == 0, "neg").when(F.col("toxic") == 1, "neu").otherwise("pos").alias("polarity"))
    return templates.scored_templates(docs, labels)


_SCORED = "with s as (select documents.doc_id as template_id, coalesce(case when quality = 0 then -1 when toxic = 1 then 0 when quality is not null then 1 end * n_chars * (documents.doc_id % 5 + 1), 0)::double as score from documents left join labels using (doc_id)) select * from s order by score"


@query(f"{_SCORED} desc, template_id limit 10")
def template_score_top(spark: SparkSession, d: str) -> DataFrame:
    return templates.top_templates(_scored(spark, d)).select("template_id", "score")


@query(f"{_SCORED}, template_id limit 10")
def template_score_bottom(spark: SparkSession, d: str) -> DataFrame:
    return templates.top_templates(_scored(spark, d), worst=True).select("template_id", "score")


@query(f"with {CONVERSION_SQL} select conv.chat_id, c_name as phone, strftime(make_timestamp(conv.ts_ms * 1000), '%Y-%m-%d') as date, first_objection_type, coalesce(n_name, '') as labels from turn as conv join customer on c_custkey = conv.chat_id left join nation on n_nationkey = c_nationkey and n_regionkey > 1")
def report_csv_rows(spark: SparkSession, d: str) -> DataFrame:
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation").filter("n_regionkey > 1")
    deals = event_conversions(spark, d).filter(conversion.is_turnaround()).join(customer.select(F.col("c_custkey").alias("chat_id"), F.col("c_name").alias("phone"), "c_nationkey"), "chat_id")
    labels = relational.labels_per_key(customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")), "c_name", "n_name").withColumnRenamed("c_name", "phone")
    return reporting.deal_rows(deals, labels).select("chat_id", "phone", "date", "first_objection_type", "labels")


@query("select n_regionkey, substring(sha256(string_agg(distinct n_name, ',' order by n_name)), 1, 16) as hash from nation group by n_regionkey")
def set_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").groupBy("n_regionkey").agg(tx.set_hash(F.col("n_name")).alias("hash"))


@query("select role, count(*) as calls, sum(greatest(1, length(text) // 4))::bigint as tokens, round(sum((greatest(1, length(text) // 4) * p + 100 * 4.0) / 1e6), 6) as cost from conversations join (values ('user', 0.8), ('assistant', 3.0), ('system', 0.0)) as v(role, p) using (role) group by role")
def call_cost(spark: SparkSession, d: str) -> DataFrame:
    prices = spark.createDataFrame([("user", 0.8), ("assistant", 3.0), ("system", 0.0)], "role string, price double")
    rows = table(spark, d, "conversations").join(F.broadcast(prices), "role").withColumn("t", tx.estimated_tokens(F.col("text")))
    spent = enrichment.cost(F.col("t"), F.lit(100), F.col("price"), F.lit(4.0))
    return rows.groupBy("role").agg(F.count(F.lit(1)).alias("calls"), F.sum("t").alias("tokens"), F.round(F.sum(spent), 6).alias("cost"))


@query("with s as (select conv_id as chat_id, count(*) as n from conversations group by conv_id), r as (select *, row_number() over (order by n, chat_id) - 1 as i, count(*) over () as t from s) select chat_id, n, case when i < t // 3 then 0 when i < 2 * t // 3 then 1 else 2 end as stratum from r")
def stratified_tertiles(spark: SparkSession, d: str) -> DataFrame:
    chats = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("chat_id")).agg(F.count(F.lit(1)).alias("n"))
    return ordered.tertiles(chats, "n", "chat_id").select("chat_id", "n", "stratum")


@query("select round(avg((quality = 1)::int), 6) as good, count(*) as n from labels")
def coverage_ratio(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.coverage(table(spark, d, "labels"), F.col("quality") == 1, "good")


@query("""with t as (select doc_id, case when quality = 1 then 'booked' when toxic = 1 then 'ambiguous' else 'lost' end as t, case when doc_id % 4 = 0 then 'ambiguous' when doc_id % 3 = 0 then 'lost' else 'booked' end as p from labels)
select count(*) filter (where t <> 'ambiguous' and p <> 'ambiguous' and t = p) as matches, count(*) filter (where t <> 'ambiguous' and p <> 'ambiguous') as compared, count(*) as n, round(count(*) filter (where t <> 'ambiguous' and p <> 'ambiguous' and t = p) / count(*) filter (where t <> 'ambiguous' and p <> 'ambiguous'), 6) as accuracy from t""")
def accuracy_excl_ambiguous(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    truth = labels.select("doc_id", F.when(F.col("quality") == 1, "booked").when(F.col("toxic") == 1, "ambiguous").otherwise("lost").alias("outcome"))
    guess = labels.select("doc_id", F.when(F.col("doc_id") % 4 == 0, "ambiguous").when(F.col("doc_id") % 3 == 0, "lost").otherwise("booked").alias("outcome"))
    return evaluation.accuracy(truth, guess, "doc_id")


@query(f"""with {CHAT_SQL} select msg_id, case when contains(lower(text), 'the ') then '1' when contains(lower(text), 'der ') then '2' end as step_id, case when contains(lower(text), ' en ') then 'price' end as objection_type,
case when contains(lower(text), ' is ') then 'pos' when contains(lower(text), ' and ') then 'neg' else 'neu' end as sentiment from c where not from_me""")
def enrich_rule_labels(spark: SparkSession, d: str) -> DataFrame:
    provider = enrichment.KeywordProvider({"1": ["the "], "2": ["der "]}, {"price": [" en "]}, [" is "], [" and "])
    items = relational.numbered(chat_messages(spark, d).filter("not from_me").select("chat_id", "msg_id", "text"), [F.col("msg_id")]).select("idx", "msg_id", "text")
    return enrichment.enrich(items, provider, "msg_id", "msg_id long, step_id string, objection_type string, sentiment string", 15)


@query("""select doc_id, case when not (doc_id % 7 + quality between 1 and 5) then 'warmth' when not (doc_id % 6 + 1 between 1 and 5) then 'clarity' when not (toxic = 0) then 'polarity' end as reject from labels""")
def validation_rejects(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels").select("doc_id", (F.col("doc_id") % 7 + F.col("quality")).alias("warmth"), (F.col("doc_id") % 6 + 1).alias("clarity"), F.lit(3).alias("script_adherence"), F.when(F.col("toxic") == 0, "pos").otherwise("bad").alias("polarity"))
    return enrichment.checked(rows, enrichment.sentiment_rules()).select("doc_id", "reject")


@query(f"with {CHAT_SQL} select chat_id, count(*) as n_messages, count(*) filter (where from_me) as agent, count(*) filter (where not from_me) as customer from c group by chat_id order by n_messages desc, chat_id limit 5")
def busiest_chats(spark: SparkSession, d: str) -> DataFrame:
    return relational.busiest(chat_messages(spark, d), 5)


@query(f"with {EVENT_SQL} select objection_type, count(*) as n from m where objection_type is not null and not from_me group by objection_type")
def objection_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reporting.histogram(event_messages(spark, d).filter("not from_me"), "objection_type")


@query(f"with {EVENT_SQL} select chat_id, count(*) as n, string_agg(msg_id || '=' || objection_type, ',' order by msg_id) as objections from m where objection_type is not null and not from_me group by chat_id")
def objections_per_chat(spark: SparkSession, d: str) -> DataFrame:
    out = conversion.objections_by_chat(event_messages(spark, d))
    listed = F.transform(F.map_entries("objections"), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"]))
    return out.select("chat_id", F.size("objections").cast("long").alias("n"), F.array_join(listed, ",").alias("objections"))


@query(f"with {EVENT_SQL} select chat_id, msg_id, pos, objection_type from m where objection_type is not null and not from_me")
def objection_positions(spark: SparkSession, d: str) -> DataFrame:
    m = event_messages(spark, d)
    marks = m.filter("objection_type is not null and not from_me").select("chat_id", "msg_id", "objection_type")
    return ordered.positioned(m.drop("objection_type")).select("chat_id", "msg_id", "pos").join(marks, ["chat_id", "msg_id"])


#: A detection names the first objection of a chat and the message two places after it.
_DETECTED = CONVERSION_SQL + """, det as (select conv.*, a.msg_id as objection_msg_id, b.msg_id as resolution_msg_id from conv
  join m a on a.chat_id = conv.chat_id and a.pos = first_objection_idx left join m b on b.chat_id = conv.chat_id and b.pos = resolution_idx)"""


@query(f"with {_DETECTED} select d.chat_id, a.pos::integer as first_objection_idx, b.pos::integer as resolution_idx, substring(b.text, 1, 200) as winning_reply_excerpt from det d left join m a on a.chat_id = d.chat_id and a.msg_id = d.objection_msg_id left join m b on b.chat_id = d.chat_id and b.msg_id = d.resolution_msg_id")
def detections_located(spark: SparkSession, d: str) -> DataFrame:
    m = ordered.positioned(event_messages(spark, d))
    conv = event_conversions(spark, d)
    at = m.select("chat_id", F.col("pos").alias("first_objection_idx"), F.col("msg_id").alias("objection_msg_id"))
    to = m.select("chat_id", F.col("pos").alias("resolution_idx"), F.col("msg_id").alias("resolution_msg_id"))
    found = conv.join(at, ["chat_id", "first_objection_idx"]).join(to, ["chat_id", "resolution_idx"], "left").select("chat_id", "objection_msg_id", "resolution_msg_id", F.lit(None).cast("string").alias("winning_reply_excerpt"))
    return conversion.located(found, m).select("chat_id", "first_objection_idx", "resolution_idx", "winning_reply_excerpt")


def _deals(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    m = ordered.positioned(event_messages(spark, d)).withColumn("phone", F.col("chat_id").cast("string")).withColumn("text", F.concat("text", F.lit(" "), F.col("k").cast("string"), F.when(F.col("k") % 3 == 0, " ok").otherwise("")))
    return conversion.deals(event_conversions(spark, d), m)


_DEAL_TEXT = CONVERSION_SQL + """, mt as (select *, text || ' ' || k || case when k % 3 = 0 then ' ok' else '' end as said, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') as date from m)"""


@query(f"""with {_DEAL_TEXT} select t.chat_id, t.chat_id::varchar as phone, a.date, t.objection_type, a.said as customer_message, b.said as winning_reply, b.msg_id as winning_reply_msg_id,
coalesce((select arg_min(said, pos) from mt where mt.chat_id = t.chat_id and pos > t.resolution_idx and not from_me and (contains(said, 'ok') or contains(said, 'show'))), '') as confirmation
from turn t join mt a on a.chat_id = t.chat_id and a.pos = t.first_objection_idx join mt b on b.chat_id = t.chat_id and b.pos = t.resolution_idx""")
def turnaround_details(spark: SparkSession, d: str) -> DataFrame:
    return _deals(spark, d)[0].drop("conv_order", "paired_lost_deals")


@query(f"""with {_DEAL_TEXT} select l.chat_id, l.chat_id::varchar as phone, a.date, l.objection_type, a.said as customer_message,
coalesce((select arg_max(said, pos) from mt where mt.chat_id = l.chat_id and pos > l.first_objection_idx and from_me), '') as winning_reply, '' as confirmation
from lost l join mt a on a.chat_id = l.chat_id and a.pos = l.first_objection_idx""")
def lost_deal_details(spark: SparkSession, d: str) -> DataFrame:
    return _deals(spark, d)[1].drop("conv_order")


@query(f"with {_PARENT} select msg_id, parent_step, trim(text) as text from p where not from_me and step_context = 'off_script' and trim(text) <> ''")
def off_script_texts(spark: SparkSession, d: str) -> DataFrame:
    return clusters.off_script(_parents(spark, d), event_messages(spark, d))


@query(f"with {_PARENT} select chat_id, msg_id, parent_step from p where not from_me")
def customer_parents(spark: SparkSession, d: str) -> DataFrame:
    m = event_messages(spark, d)
    timed = m.select("chat_id", "msg_id", "from_me", "step_id").join(m.select("chat_id", "msg_id", "ts_ms"), ["chat_id", "msg_id"])
    return ordered.with_parent_step(timed).filter("not from_me").select("chat_id", "msg_id", "parent_step")


@query(f"""with {CHAT_SQL}, r as (select *, case msg_id % 3 when 0 then 'raw ' || text || ' ' when 1 then '' end as text_raw from c)
select chat_id, 'chat_id=' || chat_id || '  phone=+' || chat_id || '  msgs=' || count(*) || chr(10) || repeat('-', 60) || chr(10) ||
string_agg('[' || strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M') || '] ' || case when from_me then 'ME  ' else 'THEM' end || ': ' || rtrim(replace(coalesce(nullif(text_raw, ''), text, ''), chr(13), '')), chr(10) order by ts_ms, msg_id) as chat from r group by chat_id""")
def chats_written_out(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("msg_id") % 3 == 0, F.concat(F.lit("raw "), "text", F.lit(" "))).when(F.col("msg_id") % 3 == 1, "")
    return ordered.written_out(chat_messages(spark, d).withColumns({"phone": F.concat(F.lit("+"), F.col("chat_id").cast("string")), "text_raw": raw}))


@query(f"with {CHAT_SQL} select chat_id, count(*) as n_messages, string_agg(msg_id::varchar, ',' order by ts_ms, msg_id) as ids from c group by chat_id")
def nested_conversations(spark: SparkSession, d: str) -> DataFrame:
    rows = ordered.nested(chat_messages(spark, d))
    return rows.select("chat_id", F.size("messages").cast("long").alias("n_messages"), F.array_join(F.transform("messages", lambda m: m["msg_id"].cast("string")), ",").alias("ids"))


@query("select doc_id, quality, toxic from labels where doc_id not in (select doc_id from documents)")
def truth_without_chat(spark: SparkSession, d: str) -> DataFrame:
    return enrichment.pending(table(spark, d, "labels").select("doc_id", "quality", "toxic"), table(spark, d, "documents"), "doc_id")


@query("select lang, count(*) as templates, sum(n_chars)::bigint as instances from documents where lang is not null group by lang order by instances desc, lang")
def volume_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter("lang is not null")
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("templates"), F.sum("n_chars").alias("instances"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_step_counts(spark, sf_dir)
