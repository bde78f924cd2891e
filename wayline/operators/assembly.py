"""From archives to samples and training views, with an account of everything left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.functions import urls
from wayline.operators import matching, sequence
from wayline.sources import archives as source

WARNING = "search failed"


def blocked_reason() -> Column:
    """Why an archive gives no sample: an untrusted judgement, or a search that was never decided; else null."""
    warned = F.exists(F.coalesce("doc.warnings", F.array().cast("array<string>")), lambda w: F.startswith(w, F.lit(WARNING)))
    return F.when(~F.coalesce("doc.judgement_trustworthy", F.lit(True)), "untrusted").when(F.coalesce("doc.search_blocked", F.lit("")) != "", "search_blocked").when(warned, "search_failed")


def samples(files: DataFrame, excluded: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(samples, account): one row per run that qualifies, and one per run that does not with its reason.

    A sample has its visits in order with their outcome and half-open range of steps, and the run's conclusion: the
    last outcome not on an excluded platform, null for success.
    """
    runs = source.parse_archives(files).withColumn("reason", F.coalesce("problem", blocked_reason()))
    good = runs.where("reason is null")
    outcomes = source.outcomes_of(good)
    visits = matching.match_visits(source.visits_of(good).fillna("", ["url", "landed_url", "player_url"]), outcomes)
    visits = sequence.step_ranges(visits, ["run"], ["visit"], "n_steps")
    branch = outcomes.select("run", F.col("idx").alias("outcome"), "branch")
    kept = visits.join(branch, ["run", "outcome"], "left").where(~urls.in_domains(urls.host(F.coalesce(F.nullif("landed_url", F.lit("")), "url")), excluded))
    sites = kept.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("visit", "url", "matched", "outcome", "branch", "start", "end"))).alias("sites"))
    ends = sequence.conclusion(outcomes, ~urls.in_domains(urls.host(F.col("url")), excluded)).withColumnRenamed("reason", "why")
    out = good.select("run", "doc.task_id", "doc.driver", "has_prompt").join(sites, "run", "left").join(ends, "run", "left")
    undecided = F.when(F.col("sites").isNull(), "no_site_left").when(F.col("branch").eqNullSafe("unresolved") & F.col("why").isNotNull(), "no_outcome_left")
    out = out.withColumn("reason", undecided)
    account = runs.where("reason is not null").select("run", "reason").unionByName(out.where("reason is not null").select("run", "reason"))
    return out.where("reason is null").drop("reason", "why"), account


def visible_steps(steps: DataFrame) -> DataFrame:
    """Steps of the model, numbered densely within their run; infrastructure steps leave no gap."""
    rows = steps.where("origin <> 'infrastructure'")
    seq = F.row_number().over(sequence.ordered(["run"], ["unit", "step"])) - 1
    return rows.withColumn("seq", seq)


def messages(steps: DataFrame, closing: DataFrame) -> DataFrame:
    """(run, messages): calls with dense ids and JSON arguments, their observations as tool messages, a closing text."""
    rows = visible_steps(steps)
    name = F.concat(F.lit("call_"), F.col("seq").cast("string"))
    args = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.coalesce("params", F.create_map().cast("map<string,string>"))))))
    call = F.struct(F.lit("assistant").alias("role"), F.lit("").alias("content"), F.struct(name.alias("id"), F.col("tool").alias("name"), args.alias("arguments")).alias("tool_call"))
    text = F.concat_ws("\n\n", F.concat(F.lit("url: "), "url"), F.nullif("body", F.lit("")), F.concat(F.lit("error: "), "error"))
    seen = F.struct(F.lit("tool").alias("role"), text.alias("content"), F.struct(name.alias("id"), F.col("tool").alias("name"), F.lit(None).cast("string").alias("arguments")).alias("tool_call"))
    pairs = rows.withColumn("pair", F.array(call, seen)).groupBy("run").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("seq", "pair"))), lambda x: x["pair"])).alias("messages"))
    last = closing.select("run", F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content"), F.lit(None).cast("struct<id:string,name:string,arguments:string>").alias("tool_call")).alias("last"))
    return pairs.join(last, "run").select("run", F.concat("messages", F.array("last")).alias("messages"))


def closing_text(outcomes: DataFrame) -> DataFrame:
    """(run, text): one sentence per host and result, in the order they were first seen."""
    result = F.coalesce("branch", F.lit("success"))
    line = F.concat(urls.host(F.col("url")), F.lit(": "), result)
    rows = outcomes.withColumn("line", line).groupBy("run", "line").agg(F.min("idx").alias("idx"))
    return rows.groupBy("run").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "line"))), lambda x: x["line"]), "; ").alias("text"))


def view_problems(views: DataFrame, tools: Sequence[str]) -> DataFrame:
    """Per run what is wrong with its messages: calls without an answer next to them, undeclared tools, bad arguments."""
    m = F.col("messages")
    at = F.sequence(F.lit(1), F.size(m) - 1)
    unanswered = F.exists(at, lambda i: (F.element_at(m, i)["role"] == "assistant") & F.element_at(m, i)["tool_call"].isNotNull() & ~(F.element_at(m, i + 1)["tool_call"]["id"].eqNullSafe(F.element_at(m, i)["tool_call"]["id"])))
    calls = F.filter(m, lambda x: (x["role"] == "assistant") & x["tool_call"].isNotNull())
    undeclared = F.array_except(F.transform(calls, lambda x: x["tool_call"]["name"]), F.array(*map(F.lit, tools)))
    broken = F.exists(calls, lambda x: F.json_object_keys(x["tool_call"]["arguments"]).isNull())
    return views.select("run", unanswered.alias("unanswered"), undeclared.alias("undeclared"), broken.alias("bad_arguments"))
