"""The whole analysis: from a SQLite export to labels, conversions, aggregations, report and CSVs.

Stages keep their tables as Parquet in ``data`` (so that any stage can be run again on its own)
and hand small documents to people as JSON, Markdown and CSV.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import domain
from ..functions import prompts
from ..functions import text as tx
from ..functions.formats import chosen_numbers, json_object, without_fence
from ..operators import clusters, conversion, enrichment, evaluation, ordered, relational, reporting, templates
from ..sources import csv_file, files, sqlite
from ..storage import Folder, saved
from .runner import Runner, Stage

#: Characters of a template that are scored, and templates or messages of a call.
SCORED_CHARS, TEMPLATE_BATCH = 1200, 10
RECORDS = {
    "template": "template_id long, step_id string, matches_script boolean, deviation_note string",
    "customer": "msg_id long, step_context string, intent string, objection_type string, sentiment string",
    "score": "template_id long, warmth int, clarity int, script_adherence int, polarity string, critique string",
    "conversion": "chat_id long, conversion_score int, conversion_evidence string, objection_msg_id long, first_objection_type string, resolution_msg_id long, winning_reply_excerpt string, final_outcome string",
}


@dataclass(frozen=True)
class Settings:
    """Where an analysis reads and writes, and what it leaves out."""

    db: Path
    script: Path
    folder: str | Path
    phones: tuple[str, ...] | None = None
    excluded_labels: tuple[str, ...] = ()
    from_date: str | None = None
    chat_limit: int | None = None
    budget: float | None = None
    prompts: Path | None = None
    data_folder: str | Path | None = None
    output_folder: str | Path | None = None

    def __post_init__(self) -> None:
        if self.phones is not None and self.chat_limit is not None:
            raise ValueError("a limit of chats and a list of phones exclude each other")

    @property
    def data(self) -> str:
        return str(self.data_folder or f"{self.folder}/data").rstrip("/")

    @property
    def output(self) -> str:
        return str(self.output_folder or f"{self.folder}/output").rstrip("/")

    def fingerprint(self) -> dict[str, Any]:
        inputs = [files.file_hash(self.db), files.file_hash(self.script), *self.excluded_labels, self.from_date or ""]
        return {"inputs": files.names_hash([f"{i}:{x}" for i, x in enumerate(inputs)]), "chat_limit": self.chat_limit, "phones": files.names_hash(list(self.phones)) if self.phones is not None else None}

    @staticmethod
    def load(db: Path, script: Path, folder: str | Path, config: Path | None = None, phones: Path | None = None, labels: Path | None = None, **more: Any) -> Settings:
        """Settings from files of phones, of labels to leave out and of the first day."""
        return Settings(
            Path(db),
            Path(script),
            folder,
            phones=tuple(files.phone_list(phones)) if phones else None,
            excluded_labels=tuple(files.line_list(labels)) if labels else (),
            from_date=files.configured_date(config) if config else None,
            **more,
        )


class Placed(Folder):
    """A folder some of whose parts may be elsewhere."""

    def __init__(self, spark: SparkSession, root: str | Path, parts: dict[str, str]) -> None:
        super().__init__(spark, str(root))
        self.parts = parts

    def path(self, name: str) -> str:
        for start, place in self.parts.items():
            if name.startswith(start):
                return f"{place}/{name.removeprefix(start)}"
        return super().path(name)


@dataclass
class Analysis:
    """The stages over one export. ``providers`` answer by task; the script's own words are the default."""

    spark: SparkSession
    settings: Settings
    providers: dict[str, enrichment.Provider] = field(default_factory=dict)
    embedder: Callable[[DataFrame, str], DataFrame] | None = None
    tokens: Callable[[Column], Column] | None = None
    expand: Callable[[dict[str, Any]], dict[str, Any]] | None = None
    write: Callable[[str], str] | None = None

    # Tables and small documents of the stages.

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.data.path(name))

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.data.path(name))
        return self.table(name)

    def _document(self, name: str) -> Any:
        """A small document of the data; an empty one where it is missing or broken."""
        try:
            return json.loads(self.data.text(name) or "{}")
        except ValueError:
            return {}

    @property
    def data(self) -> Folder:
        return Folder(self.spark, self.settings.data)

    @property
    def output(self) -> Folder:
        return Folder(self.spark, self.settings.output)

    def script(self) -> dict[str, Any]:
        return files.with_extensions(files.load_script(self.settings.script), self.data.text("script_extensions.yaml"))

    def provider(self, task: str) -> enrichment.Provider:
        return self.providers.get(task) or enrichment.ScriptProvider(self.script(), task)

    def _asked(self, task: str, items: DataFrame, order: list, key: str, size: int, rules: dict, stub: Column | None = None, skip_errors: bool = False) -> DataFrame:
        """All records of ``task`` for ``items``: those known that are no stub stay, the rest is asked for.

        Records are known by the content of their item and outlive a stage's outputs. What is asked is
        kept call by call, so a run that broke off, at whatever call, asks for nothing twice.
        """
        content = F.sha2(F.to_json(F.struct(*[c for c in items.columns if c != key])), 256)
        items = saved(items.withColumn("item", content), f"{task}-items")
        store, fields = f"records/{task}", RECORDS[task] + ", item string"
        known = saved(self.spark.read.schema(fields).parquet(self.data.path(store)) if self.data.exists(store) else self.spark.createDataFrame([], fields), f"{task}-known")
        done = known.join(items.select(key, "item"), [key, "item"], "left_semi")
        done = saved(done if stub is None else done.filter(~F.coalesce(stub, F.lit(False))), f"{task}-done")
        left = relational.numbered(enrichment.pending(items, done, key), order).select("idx", *[c for c in items.columns if c != "item"])
        left = saved(left, f"{task}-left")
        provider = self.provider(task)
        usage = self._document("usage.json")
        calls = enrichment.enrich_cached(
            left, provider, key, size, self.data.path("cache"), version=json.dumps(self.settings.fingerprint()), skip_errors=skip_errors, spend=lambda dollars: enrichment.guard(usage.get("cost", 0.0), dollars, self.settings.budget)
        )
        found = enrichment.strict(enrichment.records(calls, RECORDS[task]), rules).join(items.select(key, "item"), key)
        found = saved(found, f"{task}-found")
        self._keep(enrichment.pending(known, found, key).unionByName(found), f"records/{task}")
        out = self._keep(done.unionByName(found).drop("item"), task)
        use = {r["bucket"]: r.asDict() for r in enrichment.usage(calls, enrichment.prices(provider)).collect()}  # a row for each provider
        usage.setdefault("stages", {})[task] = use
        usage["cost"] = usage.get("cost", 0.0) + sum(u["cost"] for u in use.values())
        self.data.put("usage.json", json.dumps(usage, ensure_ascii=False, indent=2))
        return out

    # Stages.

    def load(self, _: Any = None) -> dict[str, Any]:
        """Messages of the chats that stay, their phones' labels, and how many chats were left out."""
        s = self.settings
        message, chat, jid = (sqlite.read(self.spark, str(s.db), t) for t in ("message", "chat", "jid"))
        rows = relational.base_scan(message, chat, jid, files.iso_ms(s.from_date) if s.from_date else None, list(s.phones) if s.phones is not None else None)
        links, labels = self._labels()
        out_of = sorted({n.strip() for n in s.excluded_labels})
        barred = relational.excluded_keys(links, labels.filter("type = 0").select("label_id", "label_name"), out_of, "jid_row_id", "label_id")
        rows = relational.without(rows, barred, "jid_row_id")
        m = rows.select(F.col("chat_row_id").alias("chat_id"), F.col("_id").alias("msg_id"), F.col("timestamp").alias("ts_ms"), (F.col("from_me") != 0).alias("from_me"), tx.clean_text(F.col("text_data")).alias("text"), F.col("text_data").alias("text_raw"), "phone")
        m = saved(relational.sized(m), "analysis-messages")
        if s.phones is None:
            chosen = relational.long_chats(m, domain.MIN_MESSAGES, s.chat_limit)
            kept = m.join(chosen.select("chat_id"), "chat_id", "left_semi")
            self._keep(m.filter(F.col("n_messages") < domain.MIN_MESSAGES).drop("n_messages"), "messages_short")
        else:
            kept = m
        kept = self._keep(kept.drop("n_messages"), "messages")
        phones = m.filter("phone <> ''").select("phone").distinct()
        names = links.join(labels.filter("type = 0").select("label_id", "label_name"), "label_id").join(jid.select(F.col("_id").alias("jid_row_id"), F.col("user").alias("phone")), "jid_row_id").join(phones, "phone", "left_semi")
        self._keep(relational.labels_per_key(names, "phone", "label_name"), "chat_labels")
        excluded = chat.filter("group_type = 0").join(barred, "jid_row_id", "left_semi").agg(F.count_distinct("_id").alias("n")).first()["n"]
        files.write_jsonl(self.conversations(), self.data.path("conversations.jsonl"), ["chat_id"])
        summary = {"excluded_labels": list(s.excluded_labels), "excluded_chats_count": excluded, "kept_chats_count": kept.select("chat_id").distinct().count(), "from_date": s.from_date}
        self.data.put("stage1_summary.json", json.dumps(summary, ensure_ascii=False, indent=2))
        present = labels.filter("type = 0").select(F.trim(F.coalesce("label_name", F.lit(""))).alias("name")).distinct()
        missing = self._missing(out_of, present, "name")
        unknown = self._missing(list(s.phones or ()), kept.select("phone").distinct(), "phone")
        return {**summary, "missing_labels": missing, "missing_phones": unknown}

    def _labels(self) -> tuple[DataFrame, DataFrame]:
        known = sqlite.tables(str(self.settings.db))
        if not {"labels", "labeled_jid"} <= known:
            return self.spark.createDataFrame([], "jid_row_id long, label_id long"), self.spark.createDataFrame([], "label_id long, label_name string, type long")
        labels = sqlite.read(self.spark, str(self.settings.db), "labels").withColumnRenamed("_id", "label_id")
        return sqlite.read(self.spark, str(self.settings.db), "labeled_jid").select("jid_row_id", "label_id"), labels

    def _missing(self, wanted: list[str], present: DataFrame, key: str) -> list[str]:
        """Of a list from the settings, what the data lack."""
        asked = self.spark.createDataFrame([(w,) for w in wanted], f"{key} string")
        return sorted(r[0] for r in relational.without(asked, present, key).collect())

    def conversations(self) -> DataFrame:
        """``chat_id, phone, messages``: each chat with its messages in order."""
        one = F.struct("ts_ms", "msg_id", "from_me", "text", "text_raw")
        rows = self.table("messages").groupBy("chat_id").agg(F.min_by("phone", F.struct("ts_ms", "msg_id")).alias("phone"), F.array_sort(F.collect_list(one)).alias("m"))
        return rows.select("chat_id", "phone", F.transform("m", lambda x: F.struct(x["msg_id"].alias("msg_id"), x["ts_ms"].alias("ts_ms"), x["from_me"].alias("from_me"), x["text"].alias("text"), x["text_raw"].alias("text_raw"))).alias("messages"))

    def dedupe(self, _: Any = None) -> dict[str, Any]:
        """Templates of agents' messages, and each message's template."""
        said = self.table("messages").filter("from_me").withColumn("norm", tx.ascii_fold(F.col("text")))
        said = saved(relational.numbered(said, [F.col("chat_id"), F.col("ts_ms"), F.col("msg_id")], "load_idx"), "analysis-agent")
        out, of = templates.fuzzy_templates(said.select("load_idx", "msg_id", "ts_ms", "text", "norm"))
        self._keep(of, "template_map")
        return {"templates": self._keep(out, "templates").count()}

    def extend(self, _: Any = None) -> dict[str, Any]:
        """The script's extensions: replies to objections, checked to cover each type once."""
        made = (self.expand or _plain_replies)(self.script())
        self.data.put("script_extensions.yaml", files.yaml_text(files.checked_replies(made)))
        return {"replies": len(made["objection_replies"])}

    def label(self, _: Any = None) -> dict[str, Any]:
        """Steps of templates, labels of customers' messages, and both on every message."""
        items = self.table("templates").select("template_id", F.col("canonical_text").alias("text"))
        of_templates = self._asked("template", items, [F.col("template_id")], "template_id", TEMPLATE_BATCH, enrichment.template_rules())
        messages = self.table("messages")
        said = messages.filter("not from_me").withColumn("text", tx.stripped(F.col("text"))).filter("text <> ''").select("chat_id", "ts_ms", "msg_id", "text")
        said = said.join(ordered.with_hints(messages), ["chat_id", "msg_id"])
        of_customers = self._asked("customer", said, [F.col("chat_id"), F.col("ts_ms"), F.col("msg_id")], "msg_id", domain.CUSTOMER_BATCH, enrichment.customer_rules())
        out = self._keep(enrichment.merged_labels(messages, self.table("template_map"), of_templates, of_customers), "labelled")
        lacking = enrichment.unanswered(items, of_templates, "template_id").count() + enrichment.unanswered(said, of_customers, "msg_id").count()
        return {"labelled": out.count(), "unanswered": lacking}

    def score(self, _: Any = None) -> dict[str, Any]:
        """Tone and clarity of templates; what can't be answered is left out."""
        items = self.table("templates").select("template_id", F.substring("canonical_text", 1, SCORED_CHARS).alias("text"))
        out = self._asked("score", items, [F.col("template_id")], "template_id", domain.SENTIMENT_BATCH, enrichment.sentiment_rules(), F.col("critique") == domain.STUB_CRITIQUE, skip_errors=True)
        return {"scored": out.count()}

    def convert(self, _: Any = None) -> dict[str, Any]:
        """What became of each chat, turnarounds and lost deals."""
        m = saved(ordered.positioned(self.table("messages")), "analysis-positions")
        objections = self.table("labelled").filter("objection_type is not null and not from_me").select("chat_id", "msg_id").join(m.select("chat_id", "msg_id", "pos"), ["chat_id", "msg_id"]).select("chat_id", "pos")
        texts = conversion.transcripts(m, objections, tokens=self.tokens).select("chat_id", "transcript")
        rules = enrichment.conversion_rules()
        found = self._asked("conversion", texts, [F.col("chat_id")], "chat_id", 1, rules, F.col("conversion_evidence") == domain.STUB_EVIDENCE)
        found = found.withColumn("objection_msg_id", F.when(F.col("first_objection_type").isNotNull(), F.col("objection_msg_id")))
        phones = m.groupBy("chat_id").agg(F.min_by("phone", "pos").alias("phone"))
        placed = conversion.located(found, m).join(phones, "chat_id")
        names = [f.split()[0] for f in domain.SCHEMAS["conversion"].split(", ")]
        placed = self._keep(placed.select(*names), "conversions")
        won, lost = conversion.deals(placed.withColumn("conv_order", F.col("chat_id")), m)
        return {"conversions": placed.count(), "turnarounds": self._keep(won, "turnarounds").count(), "lost_deals": self._keep(lost, "lost_deals").count()}

    def aggregate(self, _: Any = None) -> dict[str, Any]:
        """Counts and clusters for each step of the script; texts are embedded as all messages teach."""
        embedder = self.embedder or clusters.learned_embedder(self.table("messages"))
        steps, found = clusters.aggregations(self.table("labelled"), self.table("messages"), embedder)
        return {"steps": self._keep(steps, "per_step").count(), "clusters": self._keep(found, "clusters").count()}

    def payload(self) -> dict[str, Any]:
        """What the report is written from: counts, steps, best and worst templates, first deals."""
        conversions, won, lost = (self.table(t) for t in ("conversions", "turnarounds", "lost_deals"))
        scored = templates.scored_templates(self.table("templates"), self.table("score"))
        first = self._document("stage1_summary.json")
        tops = {name: [r.asDict(True) for r in templates.top_templates(scored, worst=worst).collect()] for name, worst in (("top_positive_templates", False), ("top_negative_templates", True))}
        outcomes = reporting.outcome_counts(conversions).first().asDict()
        total = outcomes.pop("total")
        return {
            "volumes": {"conversations": total, "templates": scored.count(), "turnarounds": won.count(), "lost_deals": lost.count(), "excluded_chats_count": first.get("excluded_chats_count", 0), "kept_chats_count": first.get("kept_chats_count", total)},
            "from_date": first.get("from_date") or self.settings.from_date,
            "excluded_labels": first.get("excluded_labels", list(self.settings.excluded_labels)),
            "per_step": {r["step_id"]: r.asDict(True) for r in self.table("per_step").orderBy("step_id").toLocalIterator()},
            "off_script_clusters_global": [r.asDict(True) for r in self.table("clusters").filter(F.col("step_id") == domain.UNKNOWN).orderBy("rank").limit(domain.TOP_DEALS).collect()],
            **tops,
            "top_turnarounds": [r.asDict(True) for r in won.orderBy("conv_order").limit(domain.TOP_DEALS).collect()],
            "lost_deals_sample": [r.asDict(True) for r in lost.orderBy("conv_order").limit(domain.TOP_DEALS).collect()],
            "conversion_summary": outcomes,
        }

    def report(self, _: Any = None) -> dict[str, Any]:
        """The report with its sections in order, and the five tables."""
        payload = self.payload()
        question = prompts.question({"DATA": payload})
        text = (self.write or (lambda _: _plain_report(payload)))(question)
        self.output.put("report.md", reporting.repaired_headers(text, list(domain.SECTIONS)))
        written = {name: csv_file.write(rows, self.output.path(name), domain.CSV_COLUMNS[name]) for name, rows in self.csv_tables().items()}
        return {"rows": written}

    def csv_tables(self) -> dict[str, DataFrame]:
        """The rows of each CSV, in order."""
        labels = self.table("chat_labels")

        def deals(name: str) -> DataFrame:
            rows = self.table(name).join(labels, "phone", "left").orderBy("conv_order")
            return rows.select("phone", "date", "objection_type", "customer_message", "winning_reply", "confirmation", F.coalesce("labels", F.lit("")).alias("labels"))

        found = self.table("clusters")
        own = F.struct("step_id", "medoid_text", "size", "example_msg_ids")
        of_step = found.groupBy("step_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", own.alias("c")))), lambda x: x["c"]).alias("clusters"))
        steps = self.table("per_step").join(of_step, "step_id", "left").orderBy("step_id")
        none = {n: F.coalesce(n, F.from_json(F.lit("[]"), steps.schema[n].dataType)) for n in ("top_intents", "top_objections", "clusters")}
        scored = self.table("templates").join(self.table("score"), "template_id", "left").orderBy("template_id")
        return {
            "turnarounds.csv": deals("turnarounds"),
            "lost_deals.csv": deals("lost_deals"),
            "per_step.csv": steps.withColumns(none).select("step_id", "on_script_count", "off_script_count", *none),
            "spa_templates_scored.csv": scored.select(*domain.CSV_COLUMNS["spa_templates_scored.csv"]),
            "off_script_clusters.csv": found.filter(F.col("step_id") == domain.UNKNOWN).orderBy("rank").select("step_id", "medoid_text", "size", "example_msg_ids"),
        }

    def sample_for_truth(self, path: str, counts: tuple[int, int, int] = (6, 8, 6)) -> list[int]:
        """Write chats of all sizes out for people to judge, a text file each; their ids."""
        messages = self.table("messages")
        sizes = messages.groupBy("chat_id").agg(F.count(F.lit(1)).alias("n"))
        chosen = evaluation.stratified_sample(sizes, "n", "chat_id", counts).select("chat_id")
        rows = ordered.written_out(messages.join(F.broadcast(chosen), "chat_id")).orderBy("chat_id").collect()  # a few chats
        for r in rows:
            Folder(self.spark, path).put(f"{r['chat_id']}.txt", r["chat"] + "\n")
        return [r["chat_id"] for r in rows]

    def judged(self, path: str, chat_id: int, outcome: str, notes: str = "") -> None:
        """Add what a person found of a chat to a file of ground truth."""
        if outcome not in domain.OUTCOMES:
            raise ValueError(f"no outcome: {outcome}")
        phone = self.table("messages").filter(F.col("chat_id") == chat_id).select("phone").first()
        files.append_csv(path, ["chat_id", "phone", "outcome", "notes"], [(chat_id, phone["phone"] if phone else "", outcome, notes)])

    def compared(self, path: str) -> dict[str, Any]:
        """How often the outcomes found are those that people found; ambiguous ones count on neither side."""
        truth = files.read_ground_truth(self.spark, path).select("chat_id", "outcome").dropDuplicates(["chat_id"])
        found = self.table("conversions").select("chat_id", F.col("final_outcome").alias("outcome"))
        return evaluation.accuracy(truth, found, "chat_id").first().asDict()

    def runner(self, tries: int = 1) -> Runner:
        """The stages with what each needs and leaves."""
        d, o = "data/", "output/"
        stages = [
            Stage(1, "load", self.load, [], [d + "messages", d + "chat_labels", d + "stage1_summary.json", d + "conversations.jsonl"]),
            Stage(2, "dedupe", self.dedupe, [d + "messages"], [d + "templates", d + "template_map"]),
            Stage(3, "extend", self.extend, [], [d + "script_extensions.yaml"]),
            Stage(4, "label", self.label, [d + "templates", d + "template_map"], [d + "template", d + "customer", d + "labelled"]),
            Stage(5, "score", self.score, [d + "templates"], [d + "score"]),
            Stage(6, "convert", self.convert, [d + "messages", d + "labelled"], [d + "conversion", d + "conversions", d + "turnarounds", d + "lost_deals"]),
            Stage(7, "aggregate", self.aggregate, [d + "messages", d + "labelled"], [d + "per_step", d + "clusters"]),
            Stage(8, "report", self.report, [d + "templates", d + "score", d + "conversions", d + "turnarounds", d + "lost_deals", d + "per_step", d + "clusters", d + "chat_labels"], [o + "report.md", *(o + n for n in domain.CSV_COLUMNS)]),
        ]
        folder = Placed(self.spark, self.settings.folder, {d: self.settings.data, o: self.settings.output})
        return Runner(folder, stages, self.settings.fingerprint(), tries)


#: What a model is told besides the items of each task.
TOLD = {"template": ("STEPS",), "customer": ("STEPS", "OBJECTIONS"), "score": (), "conversion": ("OBJECTIONS",)}


def asking(spark: SparkSession, settings: Settings, asks: list[Callable[[str, str], str]], **more: Any) -> Analysis:
    """An analysis whose stages ask models: functions of instructions and a question to a text, the first first.

    The instructions are files of ``settings.prompts``, one a task: ``template.md``, ``customer.md``,
    ``score.md``, ``conversion.md``, ``extend.md`` and ``report.md``. Each function is asked again when
    its answer can't be used, and is followed by the next. It may have prices (``price_in``,
    ``price_out``, dollars of a million tokens; ``price``, dollars of a call).
    """
    script = files.load_script(settings.script)
    blocks = {"STEPS": prompts.steps_block(script), "OBJECTIONS": prompts.objections_block(script)}

    def provider(task: str) -> enrichment.Chain:
        text = prompts.instructions(settings.prompts, f"{task}.md")
        fields = tuple(f.split()[0] for f in RECORDS[task].split(", "))
        made = []
        for ask in asks:
            one = enrichment.Asking(getattr(ask, "__name__", type(ask).__name__), ask, text, fields, {n: blocks[n] for n in TOLD[task]})
            for n in ("price", "price_in", "price_out"):
                setattr(one, n, float(getattr(ask, n, 0.0)))
            made.append(one)
        return enrichment.Chain(made, prompt=text)

    def extended(known: dict[str, Any]) -> dict[str, Any]:
        told, asked = prompts.instructions(settings.prompts, "extend.md"), prompts.question({"SCRIPT": {k: v for k, v in known.items() if k != "extensions"}})
        for ask in asks:
            try:
                return files.checked_replies(json.loads(json_object(ask(told, asked))))
            except (ValueError, KeyError, TypeError, enrichment.ProviderError):  # the next one is asked
                continue
        raise enrichment.ProviderError("no usable extensions of the script")

    return Analysis(spark, settings, {t: provider(t) for t in TOLD}, expand=extended, write=lambda q: asks[0](prompts.instructions(settings.prompts, "report.md"), q), **more)


def prepare(spark: SparkSession, settings: Settings, labels: str, day: str | None, labels_file: Path, config: Path) -> list[str]:
    """Write the files of labels to leave out and of the first day, and forget the first stage.

    ``labels`` are numbers from the catalogue of labels, as ``1, 3``; their names are returned.
    """
    known = [r["label_name"] for r in sqlite.label_catalogue(spark, str(settings.db)).collect()]  # names that people gave
    names = [known[i - 1] for i in chosen_numbers(labels, len(known))]
    files.replace_text(labels_file, "".join(f"{n}\n" for n in names))
    files.write_configured_date(config, files.user_date(day))
    runner = Analysis(spark, settings).runner()
    runner.invalidate(runner.stages[0])
    return names


def draft_script(text: str, write: Callable[[str], str], path: Path) -> dict[str, Any]:
    """A script written by ``write`` from a text for people, kept if it has all steps and objection types."""
    part = path.with_name(f"{path.name}.draft")
    files.replace_text(part, without_fence(write(text)) + "\n")
    script = files.load_script(part)
    part.replace(path)
    return script


def _plain_replies(script: dict[str, Any]) -> dict[str, Any]:
    """Offline: each objection type's name as a reply to write."""
    names = {o["id"]: o.get("name_pt") or o["id"] for o in script.get("objection_taxonomy") or []}
    return {"objection_replies": [{"objection_id": i, "reply": f"({names.get(i, i)})"} for i in domain.OBJECTION_IDS], "fup_templates": [], "inconsistencies": []}


def _plain_report(payload: dict[str, Any]) -> str:
    """Offline: the numbers under the first sections; the others are filled in as empty."""
    v, c = payload["volumes"], payload["conversion_summary"]
    lines = [domain.SECTIONS[0], "", f"{v['conversations']} conversas, {v['templates']} templates; {c['booked']} agendadas, {c['lost']} perdidas, {c['ambiguous']} ambíguas.", "", domain.SECTIONS[1], ""]
    lines += [f"- {step}: {p['on_script_count']} no script, {p['off_script_count']} fora" for step, p in payload["per_step"].items()]
    return "\n".join(lines)
