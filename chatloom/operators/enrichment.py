"""Enrichment: records from a pluggable provider, packed, cached, retried, checked and joined back."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import domain
from ..functions.formats import json_object
from ..functions.prompts import question
from ..functions.text import AGENT, CUSTOMER, tokens_of
from ..storage import arrow_url, delete, exists, saved


class Provider(Protocol):
    """A pure function of a batch of items to records; it is pickled to the executors.

    ``prompt`` tells providers that ask a model what to do with the items.
    """

    name: str

    def complete(self, items: list[dict[str, Any]]) -> list[dict[str, Any]]: ...


class ProviderError(RuntimeError):
    """An answer that can't be used; asking again may help."""


class QuotaError(ProviderError):
    """A provider that is spent until ``until`` (seconds of the clock)."""

    def __init__(self, message: str, until: float | None = None) -> None:
        super().__init__(message)
        self.until = until


class BudgetExceeded(RuntimeError):
    pass


class Chain:
    """Providers in order: each is tried ``tries`` times before the next; a spent one rests."""

    name = "chain"
    #: Seconds that a spent provider rests when it doesn't say how long.
    REST = 3600.0

    def __init__(self, providers: list[Provider], tries: int = 2, prompt: str = "") -> None:
        self.providers, self.tries, self.prompt = providers, tries, prompt
        self.resting: dict[int, float] = {}
        self.fallbacks: list[str] = []
        #: The provider of the latest answer: usage is counted by it.
        self.answered: str | None = None

    def complete(self, items: list[dict[str, Any]]) -> list[dict[str, Any]]:
        last: Exception | None = None
        for i, provider in enumerate(self.providers):
            if time.time() < self.resting.get(i, 0.0):
                continue
            for _ in range(self.tries):
                try:
                    out = provider.complete(items)
                    self.answered = provider.name
                    return out
                except QuotaError as e:
                    last = e
                    self.resting[i] = e.until or time.time() + self.REST
                    break
                except ProviderError as e:
                    last = e
            self.fallbacks.append(f"{provider.name}: {last}")
        raise ProviderError("no provider answered") from last


class Patient:
    """A provider that is asked up to ``tries`` times, with twice the wait each time."""

    def __init__(self, provider: Provider, tries: int = 5, wait: float = 1.0) -> None:
        self.provider, self.tries, self.wait, self.name = provider, tries, wait, provider.name

    def complete(self, items: list[dict[str, Any]]) -> list[dict[str, Any]]:
        for k in range(self.tries):
            try:
                return self.provider.complete(items)
            except QuotaError:
                raise
            except ProviderError:
                if k == self.tries - 1:
                    raise
                time.sleep(self.wait * 2**k)
        raise AssertionError


class Asking:
    """A provider over any function from instructions and a question to a text.

    The text has to hold a JSON object with a list ``items`` of records that have all ``fields``;
    anything else is a ``ProviderError``, and may be asked again.
    """

    def __init__(self, name: str, ask: Callable[[str, str], str], prompt: str, fields: tuple[str, ...], context: dict[str, Any] | None = None) -> None:
        self.name, self.ask, self.prompt, self.fields, self.context = name, ask, prompt, fields, context or {}

    def complete(self, items: list[dict[str, Any]]) -> list[dict[str, Any]]:
        text = self.ask(self.prompt, question({**self.context, "ITEMS": items}))
        try:
            found = json.loads(json_object(text))["items"]
        except (ValueError, KeyError, TypeError) as e:
            raise ProviderError(f"no items in {text[:200]!r}") from e
        lacking = [r for r in found if not isinstance(r, dict) or any(f not in r for f in self.fields)] if isinstance(found, list) else [found]
        if lacking:
            raise ProviderError(f"not a record: {str(lacking[0])[:200]}")
        return found


def cost(tokens_in: Column, tokens_out: Column, price_in: Column, price_out: Column) -> Column:
    """Price of a call in dollars from prices of a million tokens; unknown prices cost nothing."""
    return F.coalesce((tokens_in * price_in + tokens_out * price_out) / F.lit(1e6), F.lit(0.0))


def guard(spent: float, projected: float, budget: float | None) -> None:
    """Refuse a wave of calls before it starts."""
    if budget is not None and spent + projected > budget:
        raise BudgetExceeded(f"{spent + projected:.4f} of {budget:.4f}")


def cache_key(name: str, item: Column) -> Column:
    return F.sha2(F.concat(F.lit(name + "\n"), item), 256)


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items without a stored record."""
    return items.join(done.select(key), key, "left_anti")


def packed(items: DataFrame, size: int, number: str = "idx") -> DataFrame:
    """``batch, items`` (JSON, in order): ``size`` consecutive items each, by ``number``."""
    names = [c for c in items.columns if c != number]
    return items.groupBy(F.floor(F.col(number) / size).alias("batch")).agg(F.to_json(F.array_sort(F.collect_list(F.struct(number, *names)))).alias("items"))


CALL = "batch long, cache_key string, bucket string, calls int, tokens_in long, tokens_out long, error string, records array<string>"
NAMES = [f.split()[0] for f in CALL.split(", ")]


class Journal:
    """Answered calls, a file each, in a folder that all executors write to.

    A file is written beside its place and renamed, so it is there whole or not at all. A task that
    is run again, or a later run, finds what was answered before it asks.
    """

    def __init__(self, url: str) -> None:
        self.url = url

    @staticmethod
    def beside(spark: SparkSession, path: str) -> Journal | None:
        """The journal of the table at ``path``; None where only Spark reaches the file system, and a wave is the least that is kept."""
        journal = Journal(arrow_url(spark, f"{path}-journal"))
        try:
            journal._folder()
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
            return None
        return journal

    def _folder(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.url)

    def find(self, key: str) -> list | None:
        files, root = self._folder()
        try:
            with files.open_input_stream(f"{root}/{key[:2]}/{key}.json") as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def keep(self, key: str, row: list) -> None:
        files, root = self._folder()
        files.create_dir(f"{root}/{key[:2]}")
        part = f"{root}/{key[:2]}/{key}-{uuid.uuid4().hex}.part"
        with files.open_output_stream(part) as f:
            f.write(json.dumps(row, ensure_ascii=False).encode())
        files.move(part, f"{root}/{key[:2]}/{key}.json")


def called(batches: DataFrame, provider: Provider, key: str, journal: Journal | None = None) -> DataFrame:
    """A row for each batch, asked once, with the records for its own keys (JSON) and the usage.

    Unknown keys are dropped, the last of repeated ones stays. A batch that the provider can't
    answer keeps its error and no records, so that the other answers of the wave are stored. With a
    ``journal`` an answer is kept as soon as it is there, by the batch's ``cache_key``.
    """

    def answer(batch: int, cached: str | None, text: str) -> list:
        if journal is not None and (known := journal.find(cached)) is not None:
            return [batch, *known]
        asked = json.loads(text)
        keys = {i[key] for i in asked}
        why, latest = None, {}
        try:
            latest = {r[key]: r for r in provider.complete(asked) if r.get(key) in keys}
        except ProviderError as e:
            why = str(e)
        found = [json.dumps(r, ensure_ascii=False) for r in latest.values()]
        row = [cached, getattr(provider, "answered", None) or provider.name, 1, max(1, len(text) // 4), sum(len(a) for a in found) // 4, why, found]
        if journal is not None and why is None:
            journal.keep(cached, row)
        return [batch, *row]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame([answer(*r) for r in zip(pdf["batch"], pdf["cache_key"], pdf["items"], strict=True)], columns=NAMES)

    # A call costs money: its answer is stored before anything reads it twice.
    return saved(batches.select("batch", "cache_key", "items").mapInPandas(run, CALL), "calls")


def refuse_errors(calls: DataFrame) -> DataFrame:
    """The calls, unless one has an error; then that is raised, after all answers are stored."""
    if (broken := calls.filter("error is not null").orderBy("batch").select("batch", "error").first()) is not None:
        raise ProviderError(f"batch {broken['batch']}: {broken['error']}")
    return calls


def records(calls: DataFrame, schema: str) -> DataFrame:
    return calls.select(F.explode("records").alias("r")).select(F.from_json("r", schema).alias("r")).select("r.*")


def prices(provider: Provider) -> dict[str, tuple[float, float, float]]:
    """By bucket: dollars of a call, of a million tokens asked and of a million answered."""
    if isinstance(provider, Chain):
        return {k: v for p in provider.providers for k, v in prices(p).items()}
    if isinstance(provider, Patient):
        return prices(provider.provider)
    return {provider.name: tuple(float(getattr(provider, n, 0.0)) for n in ("price", "price_in", "price_out"))}


def usage(calls: DataFrame, of: dict[str, tuple[float, float, float]] | None = None) -> DataFrame:
    """Calls, tokens, errors and cost by bucket: each provider that answered, and the cache."""
    rows = calls.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("calls", "tokens_in", "tokens_out")], F.count("error").alias("errors"))
    each = F.lit(0.0)
    for name, (call, asked, answered) in (of or {}).items():
        each = F.when(F.col("bucket") == name, F.col("calls") * call + cost(F.col("tokens_in"), F.col("tokens_out"), F.lit(asked), F.lit(answered))).otherwise(each)
    return rows.withColumn("cost", each)


def projected(batches: DataFrame, provider: Provider) -> float:
    """What asking for ``batches`` costs at most before answers: calls and tokens asked, at the dearest of the provider's prices."""
    n, tokens = batches.agg(F.count(F.lit(1)), F.coalesce(F.sum(tokens_of(F.char_length("items"))), F.lit(0))).first()
    return max((n * call + tokens * asked / 1e6 for call, asked, _ in prices(provider).values()), default=0.0)


def enrich(items: DataFrame, provider: Provider, key: str, schema: str, size: int, number: str = "idx") -> DataFrame:
    """Records of ``items``, made ``size`` items at a time (by ``number``), unknown keys dropped.

    Batches are consecutive; a batch never crosses tasks.
    """
    batches = packed(items, size, number).withColumn("cache_key", F.lit(None).cast("string"))
    return records(refuse_errors(called(batches, provider, key)), schema)


def enrich_cached(items: DataFrame, provider: Provider, key: str, size: int, cache: str, version: str = "", number: str = "idx", skip_errors: bool = False, spend: Callable[[float], None] = lambda _: None) -> DataFrame:
    """The calls for ``items``; batches that the table at ``cache`` has are not asked again.

    A batch's key hashes its items, the provider's name and prompt, and ``version``. Answers are
    kept one by one in a journal beside the cache while a wave runs, and the wave's answers without
    error go to the cache, even if others have errors; only then are errors raised, unless they are
    to be skipped. ``spend`` gets what is to be asked at the providers' prices and may refuse.
    """
    spark = items.sparkSession
    name = "\n".join([provider.name, getattr(provider, "prompt", ""), version])
    batches = saved(packed(items, size, number).withColumn("cache_key", cache_key(name, F.col("items"))), "batches")
    known = spark.read.schema(CALL).parquet(cache).dropDuplicates(["cache_key"]) if exists(spark, cache) else spark.createDataFrame([], CALL)
    hits = batches.select("batch", "cache_key").join(known.drop("batch"), "cache_key").withColumns({"bucket": F.lit("cache"), "calls": F.lit(1), "tokens_in": F.lit(0).cast("long"), "tokens_out": F.lit(0).cast("long")})
    hits = saved(hits.select(*NAMES), "cached")
    fresh = saved(batches.join(known, "cache_key", "left_anti"), "to-ask")
    spend(projected(fresh, provider))
    journal = Journal.beside(spark, cache)
    calls = called(fresh, provider, key, journal)
    calls.filter("error is null").write.mode("append").parquet(cache)
    if journal is not None:
        delete(spark, f"{cache}-journal")
    return hits.unionByName(calls if skip_errors else refuse_errors(calls))


def unanswered(items: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys that were asked for and have no record."""
    return items.select(key).join(found.select(key), key, "left_anti")


def checked(records: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``reject``: the first rule a record breaks, or null."""
    why = F.lit(None).cast("string")
    for name, rule in reversed(rules.items()):
        why = F.when(~F.coalesce(rule, F.lit(True)), name).otherwise(why)
    return records.withColumn("reject", why)


def strict(records: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The records, or an error at the first that breaks a rule."""
    rows = checked(records, rules)
    broken = F.raise_error(F.concat(F.lit("record breaks the rule "), F.col("reject"), F.lit(": "), F.to_json(F.struct(*records.columns))))
    # The check stands in a column that is used, so that it can't be pruned.
    first = records.columns[0]
    return rows.withColumn(first, F.when(F.col("reject").isNull(), F.col(first)).otherwise(broken.cast(dict(records.dtypes)[first]))).drop("reject")


def template_rules() -> dict[str, Column]:
    return {"step_id": F.col("step_id").isNotNull() & F.col("step_id").isin(*domain.STEP_IDS)}


def customer_rules() -> dict[str, Column]:
    return {"step_context": F.col("step_context").isin(*domain.STEP_CONTEXTS), "objection_type": F.col("objection_type").isin(*domain.OBJECTION_IDS), "sentiment": F.col("sentiment").isin(*domain.POLARITIES)}


def sentiment_rules() -> dict[str, Column]:
    return {**{n: F.col(n).between(1, 5) for n in ("warmth", "clarity", "script_adherence")}, "polarity": F.col("polarity").isin(*domain.POLARITIES)}


def conversion_rules() -> dict[str, Column]:
    return {"conversion_score": F.col("conversion_score").between(0, 3), "final_outcome": F.col("final_outcome").isin(*domain.OUTCOMES), "first_objection_type": F.col("first_objection_type").isin(*domain.OBJECTION_IDS)}


class KeywordProvider:
    """Deterministic offline labels: a step and an objection by keywords, tone by marks."""

    name = "keywords"

    def __init__(self, steps: dict[str, list[str]], objections: dict[str, list[str]], positive: list[str], negative: list[str]) -> None:
        self.steps, self.objections, self.positive, self.negative = steps, objections, positive, negative

    def labels(self, text: str) -> tuple[str | None, str | None, str]:
        low = text.lower()

        def hit(table: dict[str, list[str]]) -> str | None:
            return next((k for k, words in table.items() if any(w in low for w in words)), None)

        tone = "pos" if any(w in low for w in self.positive) else "neg" if any(w in low for w in self.negative) else "neu"
        return hit(self.steps), hit(self.objections), tone

    def complete(self, items: list[dict[str, Any]]) -> list[dict[str, Any]]:
        out = []
        for item in items:
            step, objection, tone = self.labels(item.get("text") or "")
            out.append({**item, "step_id": step, "matches_script": step is not None, "step_context": "on_script" if step else "off_script", "intent": objection or step, "objection_type": objection, "sentiment": tone})
        return out


class ScriptProvider(KeywordProvider):
    """Offline answers to every question of the analysis, from the script's own words.

    ``task`` is one of template, customer, score, conversion. A step is the one whose canonical
    texts share most words with a text, an objection the first whose trigger a text holds.
    """

    POSITIVE = ("obrigad", "perfeito", "ótimo", "otimo", "adorei", "maravilh", "😊", "❤")
    NEGATIVE = ("caro", "ruim", "não quero", "nao quero", "reclama", "péssim")

    def __init__(self, script: dict[str, Any], task: str) -> None:
        triggers = {o["id"]: [str(t).lower() for t in o.get("triggers") or []] for o in script.get("objection_taxonomy") or [] if o.get("id") in domain.OBJECTION_IDS}
        super().__init__({}, triggers, list(self.POSITIVE), list(self.NEGATIVE))
        self.task, self.name = task, f"script-{task}"
        self.canon = [(str(s["id"]), [set(str(t).lower().split()) for t in s.get("canonical_texts") or []]) for s in script.get("steps") or []]

    def step(self, text: str) -> tuple[str, float]:
        words = set(text.lower().split())
        best = max(((len(words & c) / len(words | c) if words | c else 0.0, -i, sid) for i, (sid, texts) in enumerate(self.canon) for c in texts), default=(0.0, 0, domain.STEP_IDS[0]))
        return best[2], best[0]

    def complete(self, items: list[dict[str, Any]]) -> list[dict[str, Any]]:
        return [getattr(self, f"_{self.task}")(item) for item in items]

    def _template(self, item: dict[str, Any]) -> dict[str, Any]:
        step, share = self.step(item["text"])
        return {"template_id": item["template_id"], "step_id": step, "matches_script": share >= 0.5, "deviation_note": None if share >= 0.5 else f"{share:.2f} of the words"}

    def _customer(self, item: dict[str, Any]) -> dict[str, Any]:
        _, objection, tone = self.labels(item["text"])
        context = "off_script" if objection else "on_script" if item.get("hints") else "unknown"
        return {"msg_id": item["msg_id"], "step_context": context, "intent": objection or ("question" if "?" in item["text"] else "statement"), "objection_type": objection, "sentiment": tone}

    def _score(self, item: dict[str, Any]) -> dict[str, Any]:
        _, _, tone = self.labels(item["text"])
        _, share = self.step(item["text"])
        return {"template_id": item["template_id"], "warmth": {"pos": 5, "neu": 3, "neg": 1}[tone], "clarity": 5 if len(item["text"]) < 200 else 3, "script_adherence": 1 + round(4 * share), "polarity": tone, "critique": ""}

    def _conversion(self, item: dict[str, Any]) -> dict[str, Any]:
        parts = map(self._line, item["transcript"].splitlines())
        lines = [(int(p[0]), p[1], p[2]) for p in parts if p]
        objection = next(((i, k) for i, who, text in lines if who == CUSTOMER and (k := self.labels(text)[1])), (None, None))
        after = [line for line in lines if objection[0] is not None and line[0] > objection[0]]
        reply = next((i for i, who, _ in after if who == AGENT), None)
        booked = any(who == CUSTOMER and any(p in text.lower() for p in domain.CONFIRMATIONS) for _, who, text in (after or lines))
        outcome = "booked" if booked else "lost" if objection[0] is not None else "ambiguous"
        return {
            "chat_id": item["chat_id"],
            "conversion_score": 3 if booked else 0 if outcome == "lost" else 1,
            "conversion_evidence": "a confirmation" if booked else "none",
            "objection_msg_id": objection[0],
            "first_objection_type": objection[1],
            "resolution_msg_id": reply if booked else None,
            "winning_reply_excerpt": None,
            "final_outcome": outcome,
        }

    @staticmethod
    def _line(line: str) -> tuple[str, str, str] | None:
        head, _, text = line.partition(": ")
        number, _, who = head.partition("] ")
        return (number[1:], who, text) if number[:1] == "[" and number[1:].isdecimal() and who in (AGENT, CUSTOMER) else None


def merged_labels(messages: DataFrame, template_map: DataFrame, template_labels: DataFrame, customer_labels: DataFrame) -> DataFrame:
    """Labelled messages: agents through their template, customers directly; without a label, unknown."""
    rows = messages.join(template_map, "msg_id", "left").join(template_labels.withColumnRenamed("step_id", "_step"), "template_id", "left")
    rows = rows.join(customer_labels.select("msg_id", F.col("step_context").alias("_context"), "intent", "objection_type", "sentiment"), "msg_id", "left")
    me = F.col("from_me")
    context = F.when(me, F.when(F.col("matches_script"), "on_script").when(~F.col("matches_script"), "off_script")).otherwise(F.col("_context"))
    mine = [F.when(me, F.col(c)).alias(c) for c in ("matches_script", "deviation_note")]
    theirs = [F.when(~me, F.col(c)).alias(c) for c in ("intent", "objection_type", "sentiment")]
    return rows.select("msg_id", "chat_id", "from_me", F.when(me, F.col("_step")).alias("step_id"), F.coalesce(context, F.lit(domain.UNKNOWN)).alias("step_context"), *theirs, *mine)
