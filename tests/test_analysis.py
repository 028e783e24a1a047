"""The analysis end to end, from a SQLite export to five CSVs, and what its parts do at the edges."""

import csv
import json
import pathlib
import sqlite3
import sys

import numpy as np
import pytest
import yaml
from pyspark import cloudpickle
from pyspark.sql import functions as F

from chatloom import domain, storage
from chatloom.functions import formats, prompts
from chatloom.functions import text as tx
from chatloom.operators import clusters, conversion, enrichment, evaluation, ordered, relational
from chatloom.plans import analysis
from chatloom.plans.analysis import RECORDS, Analysis, Settings
from chatloom.sources import files
from chatloom.sources import sqlite as source

DAY = 1_700_000_000_000
# Executors can't import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def export(path):
    """Four chats: a booked one, a lost one, a short one, and one with a label."""
    with sqlite3.connect(path) as c:
        c.execute("create table message(_id integer primary key, chat_row_id integer, from_me integer, timestamp integer, message_type integer, text_data text)")
        c.execute("create table chat(_id integer primary key, jid_row_id integer, group_type integer)")
        c.execute("create table jid(_id integer primary key, user text)")
        c.execute("create table labels(_id integer primary key, label_name text, type integer, sort_id integer)")
        c.execute("create table labeled_jid(jid_row_id integer, label_id integer)")
        c.executemany("insert into jid values (?, ?)", [(i, f"551100000000{i}") for i in range(1, 5)])
        c.executemany("insert into chat values (?, ?, ?)", [(i, i, 0) for i in range(1, 5)] + [(9, 1, 1)])
        c.executemany("insert into labels values (?, ?, ?, ?)", [(1, " Staff ", 0, 2), (2, "VIP", 0, 1), (3, "other", 1, 3), (4, "", 0, 4)])
        c.executemany("insert into labeled_jid values (?, ?)", [(4, 1), (1, 2), (2, 3), (None, 1)])
        rows, n = [], 0

        def say(chat, i, me, text, kind=0):
            nonlocal n
            n += 1
            rows.append((n, chat, int(me), DAY + chat * 86_400_000 + i * 1000, kind, text))

        for chat, last in ((1, "perfeito, fechado!"), (2, "vou ver")):
            for i in range(22):
                say(chat, i, i % 2, f"Olá,  tudo bem {chat}? https://x.y/{i}" if i % 2 else f"quero saber {i}")
            say(chat, 22, False, "achei muito caro")
            say(chat, 23, True, f"temos desconto para o cliente {chat}")
            say(chat, 24, False, last)
        say(1, 30, True, None)
        say(1, 31, True, "a picture", 1)
        for i in range(5):
            say(3, i, i % 2, f"stub {i}")
        for i in range(25):
            say(4, i, i % 2, f"staff {i}")
        say(9, 0, True, "a group")
        c.executemany("insert into message values (?, ?, ?, ?, ?, ?)", rows)


def script(path):
    steps = [{"id": i, "name": f"step {i}", "canonical_texts": ["Olá, tudo bem 1?" if i == "1" else f"texto {i}"]} for i in domain.STEP_IDS]
    kinds = [{"id": i, "name_pt": i, "triggers": ["caro", "valor"] if i == "price" else [f"gatilho {i}"]} for i in domain.OBJECTION_IDS]
    path.write_text(yaml.safe_dump({"steps": steps, "objection_taxonomy": kinds}, allow_unicode=True))


@pytest.fixture()
def made(tmp_path):
    export(tmp_path / "a.db")
    script(tmp_path / "script.yaml")
    return tmp_path


def settings(made, **more):
    return Settings(made / "a.db", made / "script.yaml", made / "out", excluded_labels=("Staff", "gone"), **more)


def test_end_to_end(spark, made):
    a = Analysis(spark, settings(made))
    results = a.runner().run()
    assert results[1]["kept_chats_count"] == 2 and results[1]["excluded_chats_count"] == 1 and results[1]["missing_labels"] == ["gone"]
    m = a.table("messages")
    assert {r.chat_id for r in m.select("chat_id").distinct().collect()} == {1, 2} and m.filter("text like '%http%' or text like '%  %'").isEmpty()
    assert a.table("messages_short").count() == 5
    lines = [json.loads(x) for part in sorted((made / "out/data/conversations.jsonl").glob("part-*")) for x in part.read_text().splitlines()]
    assert [c["chat_id"] for c in lines] == [1, 2] and len(lines[0]["messages"]) == 25 and lines[0]["phone"] == "5511000000001"
    assert [x["msg_id"] for x in lines[0]["messages"]] == sorted(x["msg_id"] for x in lines[0]["messages"])
    found = {r.chat_id: r for r in a.table("conversions").collect()}
    assert (found[1].final_outcome, found[1].first_objection_type, found[1].first_objection_idx, found[1].resolution_idx) == ("booked", "price", 22, 23)
    assert found[2].final_outcome == "lost" and found[1].winning_reply_excerpt == "temos desconto para o cliente 1"
    won = a.table("turnarounds").first()
    assert (won.customer_message, won.winning_reply, won.confirmation, won.date, won.paired_lost_deals) == ("achei muito caro", "temos desconto para o cliente 1", "perfeito, fechado!", "2023-11-15", [2])
    assert a.table("lost_deals").first().winning_reply == "temos desconto para o cliente 2"
    tables = {}
    for name, header in domain.CSV_COLUMNS.items():
        with (made / "out/output" / name).open(encoding="utf-8", newline="") as f:
            rows = list(csv.reader(f))
        assert tuple(rows[0]) == header
        tables[name] = rows[1:]
    assert tables["turnarounds.csv"] == [["5511000000001", "2023-11-15", "price", "achei muito caro", "temos desconto para o cliente 1", "perfeito, fechado!", "VIP"]]
    assert [r[0] for r in tables["per_step.csv"]] == sorted(r[0] for r in tables["per_step.csv"]) and json.loads(tables["per_step.csv"][0][4])
    customers = a.table("labelled").filter("not from_me")
    counted = sum(int(r[1]) + int(r[2]) for r in tables["per_step.csv"])
    assert 0 < counted <= customers.count() and len(tables["spa_templates_scored.csv"]) == a.table("templates").count()
    text = (made / "out/output/report.md").read_text()
    assert [line for line in text.splitlines() if line.startswith("## ")] == list(domain.SECTIONS)
    payload = a.payload()
    assert payload["volumes"]["turnarounds"] == 1 and payload["conversion_summary"] == {"booked": 1, "lost": 1, "ambiguous": 0}
    assert a.runner().run() == {}


def test_folders_by_url(spark, made):
    """Tables, documents, calls and CSVs under a URL of a file system."""
    s = Settings(made / "a.db", made / "script.yaml", f"file://{made}/far/away", excluded_labels=("Staff",))
    Analysis(spark, s).runner().run()
    far = made / "far" / "away"
    assert len(list(far.glob("stage*.done"))) == 8 and (far / "output" / "per_step.csv").exists() and (far / "data" / "cache").is_dir()
    assert Analysis(spark, s).runner().chosen() == [] and not list(far.rglob("*.part")) and not (made / "file:").exists()
    assert not any(p.name.startswith(".") and p.suffix == ".part" for p in far.rglob("*"))
    folder = storage.Folder(spark, f"file://{made}/docs")
    assert folder.text("a/b.txt") is None
    for text in ("é 💛", "", "again"):
        folder.put("a/b.txt", text)
        assert folder.text("a/b.txt") == text and (made / "docs/a/b.txt").read_text() == text


def test_limits_and_phones(spark, made):
    assert Analysis(spark, settings(made, chat_limit=1)).load()["kept_chats_count"] == 1
    got = Analysis(spark, settings(made, phones=("5511000000003", "5599000000000"))).load()
    assert got["kept_chats_count"] == 1 and got["missing_phones"] == ["5599000000000"]
    late = Analysis(spark, settings(made, from_date="2023-11-16")).load()
    assert late["kept_chats_count"] == 1 and late["from_date"] == "2023-11-16"
    with pytest.raises(ValueError):
        settings(made, chat_limit=1, phones=("5511000000003",))


class Counting:
    """Answers from a list of functions, one a call, the last for good; calls are lines of a file."""

    def __init__(self, path, name="counting", fail=0, price=0.0):
        self.path, self.name, self.fail, self.price = str(path), name, fail, price

    def complete(self, items):
        with open(self.path, "a+") as f:
            f.seek(0)
            n = len(f.readlines())
            f.write(f"{len(items)}\n")
        if n < self.fail:
            raise enrichment.ProviderError("no JSON")
        return [{"template_id": i["template_id"], "warmth": 4, "clarity": 4, "script_adherence": 4, "polarity": "pos", "critique": ""} for i in items] + [{"template_id": -5}]


def test_cache_retries_and_errors(spark, tmp_path):
    items = spark.createDataFrame([(i, i, f"t{i}") for i in range(25)], "idx long, template_id long, text string")
    log = tmp_path / "log"
    for asked in ("provider", "cache"):
        calls = enrichment.enrich_cached(items, Counting(log), "template_id", 10, str(tmp_path / "cache"))
        assert enrichment.records(calls, RECORDS["score"]).count() == 25
        assert {r.bucket: r.calls for r in enrichment.usage(calls).collect()} == {"counting" if asked == "provider" else "cache": 3}
    assert sorted(log.read_text().split()) == ["10", "10", "5"]
    more = enrichment.enrich_cached(items, Counting(tmp_path / "log2", fail=9), "template_id", 30, str(tmp_path / "cache"), skip_errors=True)
    assert enrichment.records(more, RECORDS["score"]).count() == 0 and enrichment.usage(more).first().errors == 1
    again = enrichment.enrich_cached(items, enrichment.Patient(Counting(tmp_path / "log3", fail=2), wait=0.0), "template_id", 30, str(tmp_path / "cache"))
    assert enrichment.records(again, RECORDS["score"]).count() == 25
    assert enrichment.unanswered(items, enrichment.records(more, RECORDS["score"]), "template_id").count() == 25


def test_chain_rests_spent_providers():
    class Spent:
        name, calls = "spent", 0

        def complete(self, items):
            self.calls += 1
            raise enrichment.QuotaError("spent")

    class Fine:
        name = "fine"

        def complete(self, items):
            return items

    spent = Spent()
    chain = enrichment.Chain([spent, Fine()])
    assert chain.complete([{"a": 1}]) == chain.complete([{"a": 1}]) == [{"a": 1}]
    assert spent.calls == 1 and chain.fallbacks


def test_asking():
    def ask(prompt, question):
        return {"none": "sorry", "odd": '{"items": [{"a": 1}]}'}.get(prompt, f'Here: ```json\n{{"items": [{{"a": 1, "b": {len(question)}}}]}}\n```')

    assert enrichment.Asking("x", ask, "good", ("a", "b"), {"STEPS": "s"}).complete([{"a": 1}]) == [{"a": 1, "b": len('STEPS:\ns\n\nITEMS:\n[{"a": 1}]')}]
    for prompt in ("none", "odd"):
        with pytest.raises(enrichment.ProviderError):
            enrichment.Asking("x", ask, prompt, ("a", "b")).complete([{"a": 1}])


def test_prepare_and_draft(spark, made):
    a = settings(made)
    Analysis(spark, a).runner().run(last=1)
    names = analysis.prepare(spark, a, "2,1", "16.11.2023", made / "labels.txt", made / "c.yaml")
    assert names == [" Staff ", "VIP"] and files.line_list(made / "labels.txt") == ["Staff", "VIP"] and files.configured_date(made / "c.yaml") == "2023-11-16"
    assert not (made / "out/data/messages").exists()
    text = (made / "script.yaml").read_text()
    assert len(analysis.draft_script("a script", lambda t: f"```yaml\n{text}```", made / "new.yaml")["steps"]) == 9
    with pytest.raises(ValueError):
        analysis.draft_script("a script", lambda t: "steps: []", made / "bad.yaml")
    assert not (made / "bad.yaml").exists()


def test_numbers_within_groups(spark):
    rows = spark.createDataFrame([(i % 3, i * 7 % 50, i) for i in range(50)], "g int, k long, id long")
    got = relational.numbered_within(rows, "g", ["k"], "n").collect()
    for g in range(3):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.k)
        assert [r.n for r in mine] == list(range(len(mine)))


def test_nearest_distance_by_blocks(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (60, 4))
    rows = spark.createDataFrame([(int(i % 2), i, [float(v) for v in x[i]]) for i in range(60)] + [(7, 99, [1.0, 0.0, 0.0, 0.0])], "g int, id long, v array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    for block in (7, 2048):
        got = {r.id: r.core for r in clusters.nearest_distance(rows, "g", "id", "v", block).collect()}
        assert got[99] is None
        for i in range(60):
            assert got[i] == pytest.approx(min(1 - u[i] @ u[j] for j in range(60) if j != i and j % 2 == i % 2), abs=1e-6)


def test_fold_and_count(spark):
    df = spark.createDataFrame([("\x1c Plain\tTEXT \x0b",), (" Ébène ﬁn\u00a0",), (None,), ("😊",)], "t string")
    assert [r[0] for r in df.select(tx.ascii_fold(F.col("t"))).collect()] == ["plain\ttext", "ebene fin", None, ""]
    assert [r[0] for r in df.select(tx.counted_tokens(lambda ts: [len(t.split()) for t in ts])(F.col("t"))).collect()] == [2, 2, 0, 1]


class Breaking:
    """Answers with the keys; breaks at the item 30 while ``broken``, by an error of its own or of another kind."""

    def __init__(self, log, kind, broken=True):
        self.log, self.kind, self.broken, self.name = log, kind, broken, "breaking"

    def complete(self, items):
        with open(self.log, "a") as f:
            f.write(f"{items[0]['template_id']}\n")
        if self.broken and any(i["template_id"] == 30 for i in items):
            raise (enrichment.ProviderError if self.kind == "own" else ZeroDivisionError)("broken")
        return [{"template_id": i["template_id"], "warmth": 1, "clarity": 1, "script_adherence": 1, "polarity": "neu", "critique": ""} for i in items]


@pytest.mark.parametrize("kind", ["own", "other"])
def test_answers_survive_a_broken_wave(spark, tmp_path, kind):
    """Four batches in one task; the third breaks the run; the first two are asked for once in all."""
    log, cache = tmp_path / "log", str(tmp_path / "cache")
    items = spark.createDataFrame([(i, i, f"t{i}") for i in range(40)], "idx long, template_id long, text string").coalesce(1)
    with pytest.raises(Exception, match="broken|division"):
        enrichment.enrich_cached(items, Breaking(log, kind), "template_id", 10, cache)
    first = log.read_text().split()
    calls = enrichment.enrich_cached(items, Breaking(log, kind, broken=False), "template_id", 10, cache)
    assert enrichment.records(calls, RECORDS["score"]).count() == 40
    asked = log.read_text().split()
    assert len(asked) == len(set(asked) | {"30"}) + 1 and asked.count("30") == 2 and len(first) >= 1
    assert not pathlib.Path(f"{cache}-journal").exists()
    enrichment.enrich_cached(items, Breaking(log, kind), "template_id", 10, cache)
    assert log.read_text().split() == asked


def test_journal_keeps_whole_files(spark, tmp_path):
    journal = enrichment.Journal.beside(spark, str(tmp_path / "c"))
    assert journal.find("ab12") is None
    journal.keep("ab12", ["ab12", "é", 1])
    journal.keep("ab12", ["ab12", "é", 2])
    assert journal.find("ab12") == ["ab12", "é", 2] and [x.name for x in (tmp_path / "c-journal" / "ab").iterdir()] == ["ab12.json"]


def test_prices_by_tokens_and_provider(spark):
    class Primary:
        name, price_in, price_out = "primary", 1000.0, 2000.0

        def complete(self, items):
            raise enrichment.ProviderError("no")

    class Second(Primary):
        name, price, price_in, price_out = "second", 0.5, 100.0, 0.0

        def complete(self, items):
            return [{"msg_id": i["msg_id"], "text": "x" * 40} for i in items]

    chain = enrichment.Chain([Primary(), Second()], tries=1)
    items = spark.createDataFrame([(i, i, "y" * 200) for i in range(4)], "idx long, msg_id long, text string")
    batches = enrichment.packed(items, 2).withColumn("cache_key", F.lit("k"))
    calls = enrichment.called(batches, chain, "msg_id")
    use = enrichment.usage(calls, enrichment.prices(chain)).collect()
    assert [(r.bucket, r.calls) for r in use] == [("second", 2)]
    assert use[0].cost == pytest.approx(2 * 0.5 + use[0].tokens_in * 100 / 1e6)
    assert enrichment.projected(batches, chain) == pytest.approx(max(1000 * use[0].tokens_in / 1e6, 1.0 + 100 * use[0].tokens_in / 1e6))


def test_a_forced_stage_asks_for_nothing_known(spark, made):
    a = Analysis(spark, settings(made), providers={"score": Counting(made / "log")})
    for stage in (a.load, a.dedupe, a.score):
        stage()
    asked = (made / "log").read_text()
    runner = a.runner()
    runner.invalidate(runner.stages[4])
    assert not a.data.exists("score")
    a.data.delete("cache")
    assert a.score()["scored"] == a.table("templates").count() and (made / "log").read_text() == asked


def test_budget_and_stubs(spark, made):
    a = Analysis(spark, settings(made, budget=0.5), providers={"score": Counting(made / "log", price=1.0)})
    a.load()
    a.dedupe()
    with pytest.raises(enrichment.BudgetExceeded):
        a.score()
    b = Analysis(spark, settings(made), providers={"score": Counting(made / "log")})
    n = b.table("templates").count()
    b.score()
    stub = storage.saved(b.table("records/score").withColumn("critique", F.when(F.col("template_id") == 0, domain.STUB_CRITIQUE).otherwise(F.col("critique"))).withColumn("warmth", F.lit(3)), "stub")
    b._keep(stub, "records/score")
    b.data.delete("cache")
    assert b.score() == {"scored": n} and b.table("score").filter("template_id = 0").first().warmth == 4


def test_strict(spark):
    rows = spark.createDataFrame([(1, 3, "booked", None), (2, 7, "booked", None)], "chat_id long, conversion_score int, final_outcome string, first_objection_type string")
    assert enrichment.strict(rows.filter("chat_id = 1"), enrichment.conversion_rules()).count() == 1
    with pytest.raises(Exception, match="breaks the rule conversion_score"):
        enrichment.strict(rows, enrichment.conversion_rules()).collect()


def test_transcripts(spark):
    rows = [(1, i, i * 1000, i % 2 == 1, f"m{i}", "p") for i in range(100)]
    m = ordered.positioned(spark.createDataFrame(rows, "chat_id long, msg_id long, ts_ms long, from_me boolean, text string, phone string"))
    marks = spark.createDataFrame([(1, 50)], "chat_id long, pos long")
    text = conversion.transcripts(m, marks).first().transcript.splitlines()
    assert text[0] == "[0] cli: m0" and text[15] == "[... 25 mensagens ...]" and text[16] == "[40] cli: m40" and text[37] == "[... 24 mensagens ...]" and len(text) == 53
    small = conversion.transcripts(m, marks, budget=120).first()
    lines = small.transcript.splitlines()
    assert small.radius == 0 and [x for x in lines if "mensagens" in x] == ["[... 35 mensagens ...]", "[... 34 mensagens ...]"] and "[50] cli: m50" in lines


def plain_transcript(texts, marks, radius, head=15, tail=15):
    n = len(texts)
    shown = sorted({p for lo, hi in [(0, head), (n - tail, n), *((m - radius, m + radius + 1) for m in marks)] for p in range(max(lo, 0), min(hi, n))})
    out = []
    for k, p in enumerate(shown):
        if k and p > shown[k - 1] + 1:
            out.append(f"[... {p - shown[k - 1] - 1} mensagens ...]")
        out.append(f"[{p}] {'spa' if p % 2 else 'cli'}: {texts[p] or ''}")
    return "\n".join(out)


def uneven(texts):
    """Tokens that don't add up: line ends cost more in a long text."""
    return [len(t) // 4 + t.count("\n") * (1 + (len(t) > 1200)) for t in texts]


@pytest.mark.parametrize("budget", [60, 250, 400, 900, 4000])
def test_whole_transcripts_keep_to_the_budget(spark, budget):
    rng = np.random.default_rng(budget)
    chats = {c: ["m" * int(x) for x in rng.integers(0, 9, n)] for c, n in enumerate((400, 400, 37, 3))}
    chats[3][1] = None
    marks = {c: sorted(rng.choice(len(t), min(10, len(t)), replace=False).tolist()) for c, t in chats.items()}
    m = spark.createDataFrame([(c, i, i, i % 2 == 1, x, i) for c, t in chats.items() for i, x in enumerate(t)], "chat_id long, msg_id long, ts_ms long, from_me boolean, text string, pos long")
    at = spark.createDataFrame([(c, p) for c, ps in marks.items() for p in ps], "chat_id long, pos long")
    for tokens, count in ((None, lambda t: max(1, len(t) // 4)), (tx.counted_tokens(uneven), lambda t: uneven([t])[0])):
        got = {r.chat_id: r for r in conversion.transcripts(m, at, budget, tokens).collect()}
        assert set(got) == set(chats)
        for c, texts in chats.items():
            every = [plain_transcript(texts, marks[c], r) for r in range(domain.RADIUS + 1)]
            radius = next((r for r in range(domain.RADIUS, -1, -1) if count(every[r]) <= budget), 0)
            assert (got[c].radius, got[c].transcript, got[c].tokens) == (radius, every[radius], count(every[radius]))
            assert got[c].tokens <= budget or got[c].radius == 0


def test_tokens_by_vocabulary(spark):
    public = pytest.importorskip("public_tokenizers")
    df = spark.createDataFrame([("hello hello",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(tx.vocabulary_tokens(public.path("byte_bpe_50k.json"))(F.col("t"))).collect()]
    assert got[0] >= 2 and got[1:] == [0, 0]


def test_numbers_are_gapless_on_large_tables(spark):
    n = 1_200_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.col("id").alias("a"), F.repeat(F.lit("x"), 10).alias("b"))
    got = relational.numbered(rows, [F.col("k")])
    assert got.agg(F.count_if(F.col("idx") == F.col("k")).alias("same"), F.count_distinct("idx").alias("n")).first() == (n, n)


def test_formats(spark):
    assert formats.json_object('x ```json\n{"a": {"b": 1}}\n``` y') == '{"a": {"b": 1}}' == formats.json_object('so: {"a": {"b": 1}} done')
    assert [formats.json_object(t) for t in ('see {this}: {"a": "}"} and {"b": 2}', " none ", "{1} {", '{"open": ')] == ['{"a": "}"}', "none", "{1} {", '{"open":']
    assert [formats.without_fence(t) for t in ("```\na: 1", "```yaml\na: 1\n  b: 2\n  ```  \n", "x ``` y", "```")] == ["a: 1", "a: 1\n  b: 2", "x ``` y", "```"]
    assert formats.without_fence("```yaml\na: 1\n```\n") == "a: 1" == formats.without_fence(" a: 1 ")
    assert formats.chosen_numbers("2, 1,,2", 3) == [2, 1]
    for bad in ("0", "4", "x"):
        with pytest.raises(ValueError):
            formats.chosen_numbers(bad, 3)
    line = spark.createDataFrame([(60_000, True, "a\r \n"), (0, False, None)], "t long, me boolean, x string").select(formats.chat_line(F.col("t"), F.col("me"), F.col("x"))).collect()
    assert [r[0] for r in line] == ["[1970-01-01 00:01] ME  : a", "[1970-01-01 00:00] THEM: "]


def test_prompts(tmp_path):
    script(tmp_path / "s.yaml")
    found = files.load_script(tmp_path / "s.yaml")
    assert prompts.steps_block(found).splitlines()[:2] == ["- step 1: step 1", "  e.g. Olá, tudo bem 1?"]
    assert prompts.objections_block(found).splitlines()[0] == "- price (price): caro, valor" and prompts.objections_block({}) == "(none)"
    assert prompts.question({"A": "x", "B": [{"é": 1}]}) == 'A:\nx\n\nB:\n[{"é": 1}]'
    with pytest.raises(FileNotFoundError):
        prompts.instructions(tmp_path, "none.md")


def test_more_files(spark, tmp_path):
    script(tmp_path / "s.yaml")
    (tmp_path / "x.yaml").write_text("")
    assert files.load_script(tmp_path / "s.yaml", tmp_path / "x.yaml")["extensions"] == {}
    (tmp_path / "bad.yaml").write_text("steps: [{id: '1'}]")
    with pytest.raises(ValueError, match="3.5"):
        files.load_script(tmp_path / "bad.yaml")
    with pytest.raises(ValueError):
        files.checked_replies({"objection_replies": [{"objection_id": "price"}]})
    files.write_configured_date(tmp_path / "c.yaml", "2026-04-20")
    assert files.configured_date(tmp_path / "c.yaml") == "2026-04-20" and files.configured_date(tmp_path / "none.yaml") is None
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n{}\n{"a": 2, "b": "x"}\n')
    assert sorted(r.a or 0 for r in files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a long, b string").collect()) == [0, 1, 2]
    assert files.read_jsonl(spark, str(tmp_path / "no.jsonl"), "a long", missing_ok=True).count() == 0
    files.write_jsonl(spark.createDataFrame([(1, None)], "a long, b string"), str(tmp_path / "j"))
    assert files.read_jsonl(spark, str(tmp_path / "j"), "a long, b string").first() == (1, None)
    files.write_json(tmp_path / "m.json", {"7": 1, "8": 2})
    assert {tuple(r) for r in files.read_json_map(spark, tmp_path / "m.json", "msg_id", "template_id").collect()} == {(7, 1), (8, 2)}
    for _ in range(2):
        files.append_csv(tmp_path / "t.csv", ["chat_id", "phone", "outcome", "notes"], [(1, "5", "booked", 'a "b"'), ("x", "5", "lost", ""), (2, "5", "odd", "")])
    assert [tuple(r) for r in files.read_ground_truth(spark, str(tmp_path / "t.csv")).collect()] == [(1, "5", "booked", 'a "b"')] * 2
    assert files.tolerant_json(tmp_path / "t.csv") == {} == files.tolerant_json(tmp_path / "none.json")


def test_sqlite_filters(spark, made):
    df = source.read(spark, str(made / "a.db"), "message").filter("message_type = 0 and text_data is not null and chat_row_id in (1, 2)")
    assert df.count() == 50 and df.filter("timestamp >= 1700086422000 and chat_row_id = 1").count() == 3
    assert [r.label_name for r in source.label_catalogue(spark, str(made / "a.db")).collect()] == ["VIP", " Staff "]


def test_command_line(spark, made, capsys):
    from chatloom.__main__ import main

    argv = ["--db", str(made / "a.db"), "--script", str(made / "script.yaml"), "--folder", str(made / "out")]
    assert main([*argv, "--dry-run"]) == 0 and json.loads(capsys.readouterr().out) == ["load", "dedupe", "extend", "label", "score", "convert", "aggregate", "report"]
    assert main([*argv, "--to", "2"]) == 0 and set(json.loads(capsys.readouterr().out)) == {"1", "2"}
    assert main([*argv, "--to", "3", "--dry-run"]) == 0 and json.loads(capsys.readouterr().out) == ["extend"]
    for wrong in (["--ask", "json:dumps"], ["--phones", "x", "--chat-limit", "1"]):
        with pytest.raises(SystemExit):
            main([*argv, *wrong])


def test_restart(spark, made):
    a = Analysis(spark, settings(made))
    r = a.runner()
    r.run(last=2)
    assert [x.number for x in r.chosen()] == [3, 4, 5, 6, 7, 8] and [x.number for x in r.chosen(2, 3, force=True)] == [2, 3] and r.chosen(only=1) == []
    (made / "out/notes.csv").write_text("stays")
    r.restart()
    assert not (made / "out/data/messages").exists() and (made / "out/notes.csv").exists()


def test_stratified_sample(spark):
    chats = spark.createDataFrame([(i, i * i % 97) for i in range(40)], "chat_id long, n long")
    got = evaluation.stratified_sample(chats, "n", "chat_id").collect()
    assert got == evaluation.stratified_sample(chats.repartition(3), "n", "chat_id").collect() and len({r.chat_id for r in got}) == 20
    order = sorted((i * i % 97, i) for i in range(40))
    assert [sum(r.stratum == s for r in got) for s in range(3)] == [6, 8, 6]
    assert all(r.stratum == (0 if (at := order.index((r.n, r.chat_id))) < 13 else 1 if at < 26 else 2) for r in got)


class Model:
    """Answers every task of the analysis from the question alone, with words around the answer."""

    __name__ = "model"
    price_in = 2.0

    def __call__(self, instructions, question):
        parts = dict(p.split(":\n", 1) for p in question.split("\n\n") if ":\n" in p)
        if instructions == "do extend":
            return "here: " + json.dumps({"objection_replies": [{"objection_id": i, "reply": "sim"} for i in domain.OBJECTION_IDS]}) + " done"
        if instructions == "do report":
            return f"  {domain.SECTIONS[0]}\ntext\n"
        items = json.loads(parts["ITEMS"])
        assert ("STEPS" in parts) == (instructions in ("do template", "do customer")) and ("OBJECTIONS" in parts) == (instructions in ("do customer", "do conversion"))
        made = {
            "do template": lambda i: {"template_id": i["template_id"], "step_id": "1", "matches_script": True, "deviation_note": None},
            "do customer": lambda i: {"msg_id": i["msg_id"], "step_context": "off_script", "intent": "x", "objection_type": "price" if "caro" in i["text"] else None, "sentiment": "neu"},
            "do score": lambda i: {"template_id": i["template_id"], "warmth": 5, "clarity": 5, "script_adherence": 5, "polarity": "pos", "critique": ""},
            "do conversion": lambda i: {"chat_id": i["chat_id"], "conversion_score": 3, "conversion_evidence": "e", "objection_msg_id": None, "first_objection_type": None, "resolution_msg_id": None, "winning_reply_excerpt": None, "final_outcome": "booked"},
        }[instructions]
        return "```json\n" + json.dumps({"items": [made(i) for i in items]}) + "\n```"


def refusing(instructions, question):
    return "I can't"


def test_models_answer_all_stages(spark, made):
    for task in (*RECORDS, "extend", "report"):
        files.replace_text(made / "prompts" / f"{task}.md", f"do {task}")
    a = analysis.asking(spark, settings(made, prompts=made / "prompts", data_folder=made / "tables", output_folder=made / "shown"), [refusing, Model()])
    a.runner().run()
    assert a.table("labelled").filter("step_id = '1' and step_context = 'on_script'").count() > 0 and a.table("labelled").filter("objection_type = 'price'").count() > 0
    assert {r.final_outcome for r in a.table("conversions").collect()} == {"booked"}
    usage = files.tolerant_json(made / "tables" / "usage.json")
    assert set(usage["stages"]) == set(RECORDS) and all(set(u) == {"model"} for u in usage["stages"].values())
    assert usage["cost"] == pytest.approx(sum(u["model"]["tokens_in"] for u in usage["stages"].values()) * 2 / 1e6) and usage["cost"] > 0
    text = (made / "shown" / "report.md").read_text()
    assert [x for x in text.splitlines() if x.startswith("## ")] == list(domain.SECTIONS) and not (made / "out").joinpath("data").exists()
    ids = a.sample_for_truth(str(made / "judge"), (1, 1, 1))
    first = (made / "judge" / f"{ids[0]}.txt").read_text().splitlines()
    assert first[0].startswith(f"chat_id={ids[0]}  phone=55") and first[1] == "-" * 60
    for chat, outcome in zip(ids, ("booked", "lost"), strict=False):
        a.judged(str(made / "truth.csv"), chat, outcome)
    assert a.compared(str(made / "truth.csv")) == {"matches": 1, "compared": len(ids), "n": len(ids), "accuracy": round(1 / len(ids), 6)}
    with pytest.raises(ValueError):
        a.judged(str(made / "truth.csv"), 1, "odd")


def test_saved_and_discarded(spark):
    kept = storage.saved(spark.range(5), "test-kept")
    folder = pathlib.Path(storage.shared_dir(spark).removeprefix("file:"))
    assert kept.count() == 5 and folder.exists()
    storage.discard(spark)
    assert not folder.exists()
