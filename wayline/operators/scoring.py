"""Scores of samples from their checks, screens of action chains, and the entity gate of rationales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def component_score(has_outcome: Column, checks: Column) -> Column:
    """(score, kind) of a conclusion's checks(kind, tier): what is wrong decides, worst first; without anything wrong a check
    that cannot be told leaves the score open, else it is 5.

    Wrong checks of tier skip_record, or two and more wrong ones, give 1, of tier direction 2, one of tier premature 4, others 3.
    """
    wrong = F.filter(checks, lambda c: c["kind"] == "wrong")
    tier = lambda name: F.exists(wrong, lambda c: c["tier"] == name)
    one_early = F.size(F.filter(wrong, lambda c: c["tier"] == "premature")) == 1
    score = F.when(tier("skip_record") | (F.size(wrong) >= 2), 1).when(tier("direction"), 2).when(one_early, 4).otherwise(3)
    open_ = F.exists(checks, lambda c: c["kind"] == "undetermined")
    value = F.when(F.coalesce(has_outcome, F.lit(False)), F.when(F.size(wrong) > 0, score).when(~open_, 5))
    return F.struct(value.alias("score"), F.when(value.isNull(), "undetermined").otherwise("scored").alias("kind"))


def field_score(has_outcome: Column, fields: Column) -> Column:
    """(score, kind) of a record's required fields(kind): two and more missing give 2, one 3; a field that cannot be told
    leaves the score open, else it is 5."""
    count = lambda kind: F.size(F.filter(fields, lambda f: f["kind"] == kind))
    value = F.when(F.coalesce(has_outcome, F.lit(False)), F.when(count("missing") >= 2, 2).when(count("missing") == 1, 3).when(count("undetermined") == 0, 5))
    return F.struct(value.alias("score"), F.when(value.isNull(), "undetermined").otherwise("scored").alias("kind"))


def screened(steps: DataFrame, by: Sequence[str], order: str, landed: Column, same: Column, usable: Column) -> DataFrame:
    """(*by, state, points) of chains of visible steps: undetermined where a step's observation is unusable, else screenable
    with the suspicious points (step, code): a goto that did not land, and an action like the one before on the same page,
    unless that one is such a point already and nothing else is wrong.

    landed is null for other tools; same tells a step like the one before, from lag() columns or keys of the caller's.
    """
    place = W.partitionBy(*by).orderBy(order)
    # of a run of equal steps every second one is a point: the one after a point is none
    rows = steps.select(*by, order, F.coalesce(landed, F.lit(True)).alias("_landed"), F.coalesce(same, F.lit(False)).alias("_same"), F.coalesce(usable, F.lit(False)).alias("_usable"))
    rows = rows.withColumn("_run", F.sum(F.when(F.col("_same"), 0).otherwise(1)).over(place))
    nth = F.row_number().over(W.partitionBy(*by, "_run").orderBy(order))
    rows = rows.withColumn("_repeat", F.col("_same") & (~F.col("_landed") | (F.pmod(nth, F.lit(2)) == 0)))
    codes = F.array_compact(F.array(F.when(~F.col("_landed"), "goto_not_landed"), F.when(F.col("_repeat"), "repeat_action")))
    points = F.array_sort(F.flatten(F.collect_list(F.transform(codes, lambda c: F.struct(F.col(order).alias("step"), c.alias("code"))))))
    out = rows.groupBy(*by).agg(F.min("_usable").alias("ok"), points.alias("points"))
    empty = F.slice("points", 1, 0)
    return out.select(*by, F.when(F.col("ok"), "screenable").otherwise("undetermined").alias("state"), F.when(F.col("ok"), F.col("points")).otherwise(empty).alias("points"))


def unsupported_entities(mentions: DataFrame, observed: DataFrame, by: Sequence[str]) -> DataFrame:
    """(*by, step, entity, verdict) of mentions(*by, step, entity): what entities of a rationale rest on.

    observed(*by, at, entity, complete): entities of observations, seen from step `at` on. supported if an observation before
    the step has it; else undeterminable if none before is complete, or an incomplete later one has it; supported
    too if a complete later one has it, as it was there all the time; else unsupported. Steps with nothing before are not judged.
    """
    keys = [*by, "entity"]
    first = observed.groupBy(*keys).agg(F.min("at").alias("_first"), F.min(F.when(~F.col("complete"), F.col("at"))).alias("_shaky_first"), F.max(F.when(~F.col("complete"), F.col("at"))).alias("_shaky"), F.max(F.when(F.col("complete"), F.col("at"))).alias("_sure"))
    views = observed.groupBy(*by).agg(F.min("at").alias("_any"), F.min(F.when(F.col("complete"), F.col("at"))).alias("_complete"))
    rows = mentions.join(first, keys, "left").join(views, list(by), "left")
    before = lambda name: F.coalesce(F.col(name) < F.col("step"), F.lit(False))
    later = lambda name: F.coalesce(F.col(name) >= F.col("step"), F.lit(False))
    verdict = (
        F.when(before("_first"), "supported")
        .when(~before("_complete"), "undeterminable")
        .when(later("_shaky"), "undeterminable")
        .when(later("_sure"), "supported")
        .otherwise("unsupported")
    )
    return rows.where(before("_any")).select(*by, "step", "entity", verdict.alias("verdict"))


def gate_status(text: Column, findings: Column) -> Column:
    """not_run for an empty rationale, failed for a finding(severity) that is hard, else passed."""
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "not_run").when(F.exists(findings, lambda f: f["severity"] == "hard"), "failed").otherwise("passed")


def incomplete_session(blocks: DataFrame, key: str, closes: Column, cut: Column) -> DataFrame:
    """(key, reasons) of sessions that end incomplete, of blocks(key, message, at, role, type, name, text).

    The last block of the last assistant message decides: a call; results missing, unless it is a text that closes (closes);
    a text that is cut (cut). Sessions without an assistant's block, and complete ones, are left out.
    """
    counts = blocks.groupBy(key).agg(F.count(F.when(F.col("type") == "toolcall", 1)).alias("calls"), F.count(F.when(F.col("type") == "toolresult", 1)).alias("results"))
    spoken = blocks.where("role = 'assistant'").withColumn("_closes", closes).withColumn("_cut", cut)
    last = spoken.groupBy(key).agg(F.max(F.struct("message", "at", "type", "name", "_closes", "_cut")).alias("x"))
    rows = last.join(counts, key)
    is_text, missing = F.col("x.type") == "text", F.col("calls") > F.col("results")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("x.type") == "toolcall", F.concat(F.lit("last_is_call:"), F.coalesce("x.name", F.lit("?")))),
            F.when(missing & ~(is_text & F.coalesce("x._closes", F.lit(False))), F.concat(F.lit("mismatch:"), F.col("calls").cast("string"), F.lit("_vs_"), F.col("results").cast("string"))),
            F.when(is_text & F.coalesce("x._cut", F.lit(False)), F.lit("last_text_incomplete")),
        )
    )
    return rows.select(key, reasons.alias("reasons")).where(F.size("reasons") > 0)
