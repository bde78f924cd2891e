import json
import random

import pytest
from pyspark.sql import functions as F

from wayline.operators import chats

BLOCKS = "session string, message int, place int, role string, type string, id string, name string, text string, input string, state string"


def named(raw):
    return "call_unknown" if not raw else raw if raw.startswith("call_") else f"call_{raw}"


def folded(rows):
    """(session, role, content, reasoning, calls, call_id) of the messages, one block after the other."""
    out = []
    sessions = sorted({r[0] for r in rows})
    for session in sessions:
        for message in sorted({r[1] for r in rows if r[0] == session}):
            blocks = sorted((r for r in rows if r[0] == session and r[1] == message), key=lambda r: r[2])
            role = blocks[0][3]
            if role in ("user", "system", "tool"):
                text = "".join(b[7] or "" for b in blocks if b[4] == "text")
                out.append((session, role, text, None, [], named(blocks[0][5]) if role == "tool" else None))
            if role != "assistant":
                continue
            held = []
            for b in [*blocks, (session, message, None, role, "end", None, None, None, None, None)]:
                if b[4] in ("text", "thinking", "toolcall"):
                    held.append(b)
                if b[4] in ("toolresult", "end") and held:
                    thoughts = [x[7] or "" for x in held if x[4] == "thinking"]
                    calls = [(named(x[5]), x[6] or "", x[8]) for x in held if x[4] == "toolcall"]
                    out.append((session, role, "".join(x[7] or "" for x in held if x[4] == "text"), "".join(thoughts) if thoughts else None, calls, None))
                    held = []
                if b[4] == "toolresult":
                    out.append((session, "tool", b[7] or "", None, [], named(b[5])))
    return out


def broken(rows):
    """(session, step, id, state) of calls without a good result."""
    out = []
    for session in sorted({r[0] for r in rows}):
        blocks = sorted((r for r in rows if r[0] == session and r[4]), key=lambda r: (r[1], r[2]))
        mine = [(i, b) for i, b in enumerate(blocks) if b[3] == "assistant"]
        for k, (step, b) in enumerate(mine):
            if b[4] != "toolcall":
                continue
            state = None
            for _, later in mine[k + 1 :]:
                if later[4] not in ("toolcall", "toolresult"):
                    break
                if later[4] == "toolresult" and (later[5] or "") == (b[5] or ""):
                    state = later[9] or ""
                    break
            if state != "success":
                out.append((session, step, b[5] or "", state))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(6)
    out = []
    for session in "pqrs":
        for message in range(25):
            role = pick.choice(["user", "assistant", "assistant", "assistant", "system", "tool", "odd"])
            for place in range(pick.randrange(1, 9)):
                kind = pick.choice(["text", "thinking", "toolcall", "toolcall", "toolresult", "toolresult", "image", None])
                out.append((session, message, place, role, kind, pick.choice([None, "", "a", "call_b"]), pick.choice([None, "go", "look"]), pick.choice([None, "", "x", "y "]), pick.choice(['{"k": 1}', "[1]"]), pick.choice(["success", "success", "error", None])))
    return out


def test_messages_are_those_of_a_fold(spark, rows):
    made = chats.chat_messages(spark.createDataFrame(rows, BLOCKS).repartition(3)).orderBy("session", "seq").collect()
    assert [(r.session, r.role, r.content, r.reasoning, [tuple(c) for c in r.calls], r.call_id) for r in made] == folded(rows)


def test_breakpoints_are_those_of_a_scan(spark, rows):
    assert sorted(map(tuple, chats.breakpoints(spark.createDataFrame(rows, BLOCKS).repartition(3)).collect()), key=str) == broken(rows)


def test_broken_arguments_and_what_was_repaired(spark):
    rows = [
        ("s", 1, 0, "user", None, None, None, None, None, None),
        ("s", 2, 0, "assistant", "toolcall", "1", "go", None, '{"a": ', None),
        ("s", 2, 1, "assistant", "toolcall", "2", "look", None, None, None),
        ("s", 2, 2, "assistant", "toolresult", "1", "go", None, None, "success"),
        ("s", 3, 0, "assistant", "text", None, None, "", None, None),
        ("s", 3, 1, "assistant", "toolcall", "3", "go", None, "{}", None),
    ]
    frame = spark.createDataFrame(rows, BLOCKS)
    made = chats.chat_messages(frame).orderBy("seq").collect()
    assert [(r.role, r.content, r.filled) for r in made] == [("user", "", False), ("assistant", "", True), ("tool", "", False), ("assistant", "", False)]
    assert json.loads(made[1].calls[0].arguments) == {"raw": '{"a": '} and made[1].calls[1].arguments == "{}"
    assert tuple(chats.repairs(frame).first()) == ("s", 3, 1, 2, 1, 1, ["go", "look"])
    assert chats.chat_messages(frame.limit(0)).count() == 0


def distance(a, b):
    rows = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            rows[i][j] = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
    return rows[-1][-1]


def test_distance_of_calls(spark):
    pick = random.Random(7)
    some = lambda: [pick.choice(["go", "look", "wait", "go2", "é"]) for _ in range(pick.randrange(9))]
    pairs = [(some(), some()) for _ in range(60)] + [([f"n{i}" for i in range(300)], [f"n{i}" for i in range(299, -1, -1)])]
    got = spark.createDataFrame(pairs, "a array<string>, b array<string>").select(chats.call_distance(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [distance(a, b) for a, b in pairs]


def test_versions_of_a_session(spark):
    one = [("s", 1, 0, "user", "text", None, None, "goal", None, None), ("s", 2, 0, "assistant", "toolcall", "1", "go", None, "{}", None), ("s", 2, 1, "assistant", "toolresult", "1", "go", "r", None, "error"), ("s", 2, 2, "assistant", "text", None, None, "done", None, None)]
    good = [*one[:2], (*one[2][:-1], "success"), one[3]]
    records = "session string, status string, invalid boolean"
    told = lambda a, b, changes: tuple(chats.compared(spark.createDataFrame(a, BLOCKS), spark.createDataFrame(b, BLOCKS), spark.createDataFrame(changes, records)).first())
    assert told(one, good, []) == ("s", [], "pass", "improved", 0, "pass")
    assert told(good, one, [("s", "edited", False)]) == ("s", [], "pass", "degraded", 0, "fail")
    assert told(one, one[1:3], [("s", "needs_review", None)] * 2) == ("s", ["goal", "results"], "review", "unchanged", 0, "fail")
    assert told(one, [one[0], one[3]], [("s", "edited", True)]) == ("s", [], "fail", "improved", 1, "fail")
    assert told(one, one, [("s", "preserved", None), ("s", "untouched", None), ("s", "needs_review", None)])[2:] == ("review", "unchanged", 0, "pass")
    assert told(one, one, [("s", "needs_review", None)] * 3)[2] == "fail"
