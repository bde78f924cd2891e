"""Defects of a session's blocks that rules alone can tell. blocks are those of operators.chats."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# What debug output shows, a quantity with its unit, and the tools between which a loop may switch.
DEBUG = r"DEBUG|Traceback|status:\s*5\d\d|Error:|\[API_MISUSE\]|FATAL|ModuleNotFoundError|IndentationError|SyntaxError"
UNITS = ("元", "块", "月", "天", "小时", "年")
SWITCHING = ("browser", "execute_shell_command")


@dataclass(frozen=True)
class Limits:
    """Where the rules begin to find something."""

    short_thought: int = 20
    long_thought: int = 500
    repeats: int = 3
    switches: int = 3
    failures: int = 8
    health: float = 0.3


def quantities(text: Column, units: Collection[str] = UNITS) -> Column:
    """The different quantities of a text, each as number|unit."""
    pattern = rf"(\d+(?:\.\d+)?)\s*({'|'.join(units)})"
    return F.array_distinct(F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("n"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("u")))


def unverified_quantities(blocks: DataFrame, units: Collection[str] = UNITS) -> DataFrame:
    """(session, message, place, number, unit) of what a text says and no result before it in its message does.

    Texts before the first result of their message are not asked. A quantity meets the first result that has it, so no text is compared with every result.
    """
    rows = blocks.where("role = 'assistant'").select("session", "message", "place", "type", F.coalesce("text", F.lit("")).alias("text"))
    each = rows.where("type IN ('text', 'toolresult')").select("session", "message", "place", "type", F.explode(quantities(F.col("text"), units)).alias("q"))
    each = each.select("session", "message", "place", "type", F.col("q.n").alias("number"), F.col("q.u").alias("unit"))
    said = each.where("type = 'text'").drop("type")
    seen = each.where("type = 'toolresult'").groupBy("session", "message", "number", "unit").agg(F.min("place").alias("first"))
    results = rows.where("type = 'toolresult'").groupBy("session", "message").agg(F.min("place").alias("opened"))
    met = said.join(results, ["session", "message"]).where("opened < place").join(seen, ["session", "message", "number", "unit"], "left")
    return met.where("first IS NULL OR first > place").select("session", "message", "place", "number", "unit")


def _call_tags(blocks: DataFrame, tools: Collection[str], apis: Collection[str], off_topic: Collection[str]) -> list[Column]:
    given = F.coalesce("input", F.lit(""))
    valid = F.try_parse_json(given).isNotNull()
    call = F.col("type") == "toolcall"
    names_api = F.lit(False)
    for api in apis:
        names_api = names_api | F.contains(F.lower(given), F.lit(api.lower()))
    unknown = ~F.coalesce(F.col("name").isin(*tools), F.lit(False)) if tools else F.lit(False)
    return [
        F.when(call & ~valid, "tool_json_invalid"),
        F.when(call & valid & unknown, "tool_hallucinated"),
        F.when(call & valid & names_api, "api_hallucination"),
        F.when(call & F.coalesce(F.col("name").isin(*off_topic), F.lit(False)), "tool_off_topic"),
    ]


def defect_tags(
    blocks: DataFrame,
    similar: Callable[[Column, Column], Column],
    tools: Collection[str] = (),
    apis: Collection[str] = (),
    off_topic: Collection[str] = (),
    units: Collection[str] = UNITS,
    limits: Limits = Limits(),
) -> DataFrame:
    """(session, message, place, type, tags) of the assistant's blocks with defects, tags in alphabetical order.

    Of a block by itself: thought_too_short, thought_too_long; tool_json_invalid, else tool_hallucinated (not one of `tools`, where any
    are given) and api_hallucination (the input names one of `apis`); tool_off_topic; obs_debug_leak. Of a text and the results before
    it: text_fact_hallucination. Of calls: repetitive_call, `repeats` and more in a row of one tool with inputs each similar to
    the one before. Of whole messages: context_switch_loop on all blocks, and message_unhealthy.
    """
    rows = blocks.where("role = 'assistant' AND type IS NOT NULL").withColumn("text", F.coalesce("text", F.lit("")))
    kind = F.col("type")
    own = [
        F.when((kind == "thinking") & (F.length("text") < limits.short_thought), "thought_too_short"),
        F.when((kind == "thinking") & (F.length("text") > limits.long_thought), "thought_too_long"),
        F.when((kind == "toolresult") & F.col("text").rlike(DEBUG), "obs_debug_leak"),
        *_call_tags(rows, tools, apis, off_topic),
    ]
    key = ["session", "message"]
    calls = rows.where("type = 'toolcall'")
    order = W.partitionBy(*key).orderBy("place")
    given = F.coalesce("input", F.lit(""))
    same = (F.col("name") == F.lag("name").over(order)) & similar(given, F.lag(given).over(order))
    calls = calls.withColumn("run", F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).over(order))
    to_and_fro = F.array_sort(F.array(F.col("name"), F.lag("name").over(order))) == F.array(*map(F.lit, sorted(SWITCHING)))
    calls = calls.withColumn("switched", F.coalesce(to_and_fro, F.lit(False)))
    calls = calls.withColumn("length", F.count("*").over(W.partitionBy(*key, "run")))
    repeated = calls.where(F.col("length") >= limits.repeats).select(*key, "place", F.lit("repetitive_call").alias("tag"))
    of_calls = calls.groupBy(*key).agg(F.count("*").alias("calls"), F.count_if("switched").alias("switches"), F.max(F.col("length") >= 3).alias("loop"))
    results = rows.where("type = 'toolresult'").withColumn("good", F.coalesce(F.col("state") == "success", F.lit(False)))
    results = results.withColumn("nth", F.row_number().over(order) - 1).groupBy(*key).agg(F.count_if("good").alias("good"), F.min(F.when(F.col("good"), F.col("nth"))).alias("first"))
    state = of_calls.join(results, key, "left")
    before = F.coalesce("first", "calls")
    switching = F.col("switches") >= limits.switches
    score = F.coalesce("good", F.lit(0)) / F.col("calls") - F.least(before / limits.failures, F.lit(1.0)) * 0.4 - F.when(F.col("loop"), 0.3).otherwise(0.0) - F.when(switching, 0.3).otherwise(0.0)
    unhealthy = (F.greatest(score, F.lit(0.0)) < limits.health) | (before > limits.failures)
    whole = state.select(*key, F.array_compact(F.array(F.when(switching, "context_switch_loop"), F.when(unhealthy, "message_unhealthy"))).alias("whole"))
    facts = unverified_quantities(blocks, units).select(*key, "place", F.lit("text_fact_hallucination").alias("tag"))
    others = repeated.unionByName(facts).groupBy(*key, "place").agg(F.collect_set("tag").alias("others"))
    none = F.array().cast("array<string>")
    joined = rows.select(*key, "place", "type", F.array_compact(F.array(*own)).alias("own")).join(others, [*key, "place"], "left").join(whole, key, "left")
    tags = F.array_sort(F.array_distinct(F.concat("own", F.coalesce("others", none), F.coalesce("whole", none))))
    return joined.select(*key, "place", "type", tags.alias("tags")).where(F.size("tags") > 0)
