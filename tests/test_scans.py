"""Ordered operators on chats of which one holds half of all rows, in segments and in one window."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom import domain
from chatloom.operators import ordered, scans


@pytest.fixture(scope="module")
def chats():
    """Chat 1 holds half of all messages; times repeat and may be null; another chat has no id."""
    rng = np.random.default_rng(4)
    out = {1: 3000, None: 400, **{c: int(n) for c, n in zip(range(2, 40), rng.integers(1, 140, 38), strict=True)}}
    rows, at = [], 0
    for chat, n in out.items():
        for i in range(n):
            me = bool(rng.random() < 0.3)
            rows.append((chat, at, None if i < 2 else int(rng.integers(0, n)), me, rng.choice(["", " a ", f"text {at}", None]), rng.choice(["", "1", "2", None]) if me else "7"))
            at += 1
    return [rows[i] for i in rng.permutation(len(rows))]


def table(spark, chats):
    return spark.createDataFrame(chats, "chat_id long, msg_id long, ts_ms long, from_me boolean, text string, step_id string").repartition(4)


def in_order(chats):
    by = {}
    for r in sorted(chats, key=lambda r: (r[0] is not None, r[0] or 0, r[2] is not None, r[2] or 0, r[1])):
        by.setdefault(r[0], []).append(r)
    return by


@pytest.mark.parametrize("most", [250, 1_000_000])
def test_positions_steps_and_hints(spark, chats, monkeypatch, most):
    monkeypatch.setattr(scans, "SEGMENT", most)
    m = table(spark, chats)
    pos = {r.msg_id: r.pos for r in ordered.positioned(m).collect()}
    step = {r.msg_id: r.parent_step for r in ordered.with_parent_step(m).collect()}
    hints = {(r.chat_id, r.msg_id): r.hints for r in ordered.with_hints(m).collect()}
    seen = 0
    for chat, rows in in_order(chats).items():
        at, said = domain.UNKNOWN, []
        for i, (_, msg, _, me, text, of) in enumerate(rows):
            assert pos[msg] == i
            at = of if me and of else at
            assert step[msg] == at
            if me and (text or "").strip():
                said.append(text.strip()[: domain.HINT_CHARS])
            if not me:
                assert hints[chat, msg] == " | ".join(said[-domain.HINT_MESSAGES :])
                seen += 1
    assert len(hints) == seen and len(pos) == len(step) == len(chats)


@pytest.mark.parametrize("most", [250, 1_000_000])
def test_as_of_by_one_pass(spark, chats, monkeypatch, most):
    monkeypatch.setattr(scans, "SEGMENT", most)
    m = table(spark, [r for r in chats if r[0] is not None])
    m = ordered.positioned(m)
    places = {r.msg_id: r.pos for r in m.collect()}
    by = {c: [(places[r[1]], r[3], r[4]) for r in rows] for c, rows in in_order(chats).items() if c is not None}
    marks = [(c, p) for c, rows in by.items() for p in range(-1, len(rows) + 1, 3)] + [(999, 5), (2, None), (2, 2), (2, 2)]
    asked = spark.createDataFrame(marks, "chat_id long, mark long")
    wanted = F.col("from_me") & F.coalesce(F.col("text"), F.lit("x")).contains("t")
    good = {c: [(p, t) for p, me, t in rows if me and "t" in (t or "x")] for c, rows in by.items()}

    def plain(c, mark, last):
        after = [t for p, t in good.get(c, []) if mark is not None and p > mark]
        return (after[-1 if last else 0] or "") if after else ""

    for f, last in ((ordered.first_after, False), (ordered.last_after, True)):
        got = sorted((r.chat_id, -9 if r.mark is None else r.mark, r.text) for r in f(m, asked, wanted).collect())
        assert got == sorted((c, -9 if k is None else k, plain(c, k, last)) for c, k in marks)


def test_segments_are_bounded_and_in_order(spark, chats):
    rows, several = scans.segmented(table(spark, chats), "chat_id", ["ts_ms", "msg_id"], 250)
    sizes = {(r.chat_id, r._seg): r["count"] for r in rows.groupBy("chat_id", "_seg").count().collect()}
    assert several and max(sizes.values()) < 3 * 250 and sum(sizes.values()) == len(chats) and sum(c == 1 for c, _ in sizes) > 10
    assert scans.segmented(table(spark, chats), "chat_id", ["ts_ms", "msg_id"], 5000)[1] is False
    ends = rows.filter("chat_id = 1").groupBy("_seg").agg(F.min(F.struct("ts_ms", "msg_id")).alias("lo"), F.max(F.struct("ts_ms", "msg_id")).alias("hi")).orderBy("_seg").collect()
    at = lambda s: (s.ts_ms is not None, s.ts_ms or 0, s.msg_id)
    assert all(at(a.hi) < at(b.lo) for a, b in zip(ends, ends[1:], strict=False))


def test_one_pass_joins_no_messages_to_marks(spark, chats):
    m = ordered.positioned(table(spark, chats))
    plan = ordered.first_after(m, spark.createDataFrame([(1, 5)], "chat_id long, mark long"), F.col("from_me"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Window ") >= 1
