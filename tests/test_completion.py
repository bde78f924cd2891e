import random

import pytest
from pyspark.sql import functions as F

from wayline.operators import completion

EVENTS = "session string, seq int, event_type string, blocks array<struct<type:string,id:string,text:string>>, call_id string"


def judged(events):
    """(status, reasons, last block, final text) of one session's events, read one after the other."""
    kinds = [e[2] or "" for e in events]
    if kinds[-1] in ("error", "cancel"):
        return "aborted", [f"terminal_event:{kinds[-1]}"], "", ""
    if kinds[-1] != "final_reply":
        return "incomplete", ["no_terminal_event"], "", ""
    held, last, calls, results = [], [], 0, 0
    for _, _, kind, blocks, call in events:
        if kind == "model_response":
            held += blocks or []
        elif kind == "tool_execution":
            results += bool(call)
        elif kind in completion.TERMINAL:
            calls += sum(b[0] in ("toolcall", "tool_call") and bool(b[1]) for b in held)
            last, held = held or last, []
    texts = [b[2] or "" for b in last if b[0] == "text"]
    final, block = texts[-1] if texts else "", (last[-1][0] or "") if last else ""
    thoughts = sum(len(b[2] or "") for b in last if b[0] == "thinking")
    reasons = ["last_block_is_call"] * (block in ("toolcall", "tool_call")) + ["calls_without_result"] * (calls > results and not final.endswith("."))
    reasons += ["last_text_incomplete"] * (block == "text" and final.endswith(",")) + ["thinking_only"] * (block == "thinking" and not texts and thoughts >= 5)
    return "incomplete" if reasons else "complete", reasons, block, final


def told(spark, rows):
    frame = spark.createDataFrame(rows, EVENTS).repartition(3)
    found = completion.completion(frame, lambda t: F.endswith(t, F.lit(",")), lambda t: F.endswith(t, F.lit(".")), thought=5)
    return {r.session: r for r in found.collect()}


def test_any_session_as_by_a_scan(spark):
    pick = random.Random(11)
    block = lambda: (pick.choice(["text", "text", "thinking", "toolcall", "tool_call", None]), pick.choice([None, "", "a", "b"]), pick.choice([None, "", "so,", "end.", "word"]))
    sessions = {}
    for s in range(150):
        rows = []
        for seq in range(pick.randrange(1, 9)):
            kind = pick.choice(["model_response", "model_response", "tool_execution", "final_reply", "final_reply", "error", None])
            rows.append((str(s), seq, kind, [block() for _ in range(pick.randrange(3))] if kind == "model_response" else None, pick.choice([None, "", "a"])))
        if pick.random() < 0.7:
            rows.append((str(s), 99, "final_reply", None, None))
        sessions[str(s)] = rows
    got = told(spark, [r for rows in sessions.values() for r in rows])
    assert {s: (r.status, r.reasons, r.last_block, r.final_text) for s, r in got.items()} == {s: judged(rows) for s, rows in sessions.items()}
    assert all(r.retryable == (r.status == "incomplete") for r in got.values())


@pytest.mark.parametrize(
    ("events", "want"),
    [
        ([("model_response", [("text", None, "done.")], None), ("final_reply", None, None)], "complete"),
        ([("final_reply", None, None)], "complete"),
        ([("final_reply", None, None), ("model_response", [("text", None, "more")], None)], "incomplete"),
        ([("model_response", [("toolcall", "a", None)], None), ("cancel", None, None)], "aborted"),
    ],
)
def test_ends(spark, events, want):
    rows = [("s", i, *e) for i, e in enumerate(events)]
    assert told(spark, rows)["s"].status == want


def test_no_events(spark):
    assert told(spark, []) == {}
