import random
import re

import pytest
from pyspark.sql import functions as F

from wayline.operators import defects

BLOCKS = "session string, message int, place int, role string, type string, id string, name string, text string, input string, state string"
UNITS = ("days", "hours")


def block(kind, text=None, name=None, given="{}", state=None, role="assistant", message=1):
    return message, role, kind, name, text, given, state


def tagged(spark, blocks, **more):
    rows = [("s", m, i, role, kind, "", name, text, given, state) for i, (m, role, kind, name, text, given, state) in enumerate(blocks)]
    options = {"similar": lambda a, b: a == b, "tools": ["go", "look", "browser", "execute_shell_command"], "apis": ["OldApi"], "off_topic": ["look"], "units": UNITS} | more
    found = defects.defect_tags(spark.createDataFrame(rows, BLOCKS).repartition(2), **options)
    return {r.place: r.tags for r in found.collect()}


OK = block("toolresult", "3 days", "go", state="success")


@pytest.mark.parametrize(
    ("blocks", "want"),
    [
        ([block("thinking", "x" * 19), block("thinking", "x" * 20), block("thinking", "x" * 500), block("thinking", "x" * 501), block("thinking")], {0: ["thought_too_short"], 3: ["thought_too_long"], 4: ["thought_too_short"]}),
        ([block("toolcall", name="gone", given="{"), OK], {0: ["tool_json_invalid"]}),
        ([block("toolcall", name="gone", given='{"x": "oldAPI()"}'), OK], {0: ["api_hallucination", "tool_hallucinated"]}),
        ([block("toolcall", name=None), OK], {0: ["tool_hallucinated"]}),
        ([block("toolcall", name="look"), OK], {0: ["tool_off_topic"]}),
        ([block("toolcall", name="go", given=None), OK], {0: ["tool_json_invalid"]}),
        ([block("toolresult", "status: 503"), block("toolresult", "status: 200"), block("toolresult", "Traceback"), block("toolresult")], {0: ["obs_debug_leak"], 2: ["obs_debug_leak"]}),
        ([block("text", "9 days"), OK, block("text", "3days of 3 hours"), block("text", "3 days, 3.0 days"), block("text", "3 days"), block("toolresult", "7 hours"), block("text", "7 hours"), block("text")], {2: ["text_fact_hallucination"], 3: ["text_fact_hallucination"]}),
        ([OK, block("text", "9 days", message=2)], {}),
        ([block("toolcall", name="go"), OK] * 3, {0: ["repetitive_call"], 2: ["repetitive_call"], 4: ["repetitive_call"]}),
        ([block("toolcall", name="go", given=f"[{i}]") for i in (1, 1, 2, 1)] + [OK] * 4, {}),
        ([x for n in ("browser", "execute_shell_command", "browser", "execute_shell_command") for x in (block("toolcall", name=n), OK)], {i: ["context_switch_loop"] for i in range(8)}),
        ([block("toolcall", name="go"), block("toolresult", "no", state="error"), block("text", "well")], {i: ["message_unhealthy"] for i in range(3)}),
        ([block("toolcall", name="go")] + [block("toolresult", "no", state="error")] * 9 + [OK], {i: ["message_unhealthy"] for i in range(11)}),
        ([block("toolcall", "x", "gone", "{", role="user"), block(None)], {}),
    ],
)
def test_each_rule(spark, blocks, want):
    assert tagged(spark, blocks) == want


def test_planted_quantities_are_found_and_none_else(spark):
    pick = random.Random(8)
    rows, want = [], set()
    for message in range(40):
        seen, opened = set(), False
        for place in range(12):
            kind = pick.choice(["text", "toolresult", "toolcall"])
            text = " and ".join(f"{pick.choice(['1', '2', '2.5', '10'])}{pick.choice(['', ' '])}{pick.choice([*UNITS, 'weeks'])}" for _ in range(pick.randrange(3)))
            rows.append(("s", message, place, "assistant", kind, "", "go", text, "{}", "success"))
            said = set(re.findall(r"(\d+(?:\.\d+)?)\s*(days|hours)", text))
            if kind == "toolresult":
                seen, opened = seen | said, True
            elif kind == "text" and opened:
                want |= {("s", message, place, *q) for q in said - seen}
    found = defects.unverified_quantities(spark.createDataFrame(rows, BLOCKS).repartition(3), UNITS)
    assert {tuple(r) for r in found.collect()} == want and want
    assert found.count() == len(want)


def test_no_blocks_and_no_tools(spark):
    frame = spark.createDataFrame([], BLOCKS)
    assert defects.defect_tags(frame, lambda a, b: a == b).count() == 0
    assert tagged(spark, [block("toolcall", name="gone"), OK], tools=(), apis=(), off_topic=()) == {}
    assert defects.quantities(F.lit("30元 5 块 2小时")) is not None
