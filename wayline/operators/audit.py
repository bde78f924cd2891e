"""Audits of runs: asserts with what could not be tested, tallies, worklists, verdicts from several sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.operators.metrics import ratio


def run_asserts(rows: DataFrame, by: Sequence[str], clauses: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(by, clause, tested, failed, state): a clause is (applies, holds) of a row; without rows it applies to it is untestable."""
    counts = [F.count(F.when(applies, 1)).alias(f"_t{k}") for k, (applies, _) in enumerate(clauses.values())]
    counts += [F.count(F.when(applies & ~F.coalesce(holds, F.lit(False)), 1)).alias(f"_f{k}") for k, (applies, holds) in enumerate(clauses.values())]
    listed = F.array(*(F.struct(F.lit(name).alias("clause"), F.col(f"_t{k}").alias("tested"), F.col(f"_f{k}").alias("failed")) for k, name in enumerate(clauses)))
    out = rows.groupBy(*by).agg(*counts).select(*by, F.explode(listed).alias("c")).select(*by, "c.*")
    return out.withColumn("state", F.when(F.col("tested") == 0, "untestable").when(F.col("failed") > 0, "failed").otherwise("passed"))


def assert_summary(asserts: DataFrame) -> DataFrame:
    """Per clause how many runs passed, failed and were untestable, and the share that passed of the tested."""
    count = lambda state: F.count(F.when(F.col("state") == state, 1)).alias(state)
    out = asserts.groupBy("clause").agg(count("passed"), count("failed"), count("untestable"))
    return out.withColumn("share", ratio(F.col("passed"), F.col("passed") + F.col("failed")))


def disagreement_rate(rows: DataFrame, by: Sequence[str], gold: Column, pred: Column, line: float, least: int = 20) -> DataFrame:
    """Share of unequal pairs of groups that have any; only groups of `least` pairs can be over the line."""
    both = gold.isNotNull() & pred.isNotNull()
    out = rows.groupBy(*by).agg(F.count(F.when(both, 1)).alias("n"), F.count(F.when(both & (gold != pred), 1)).alias("disagree")).where("n > 0")
    out = out.withColumn("rate", F.col("disagree") / F.col("n"))
    return out.withColumn("over", (F.col("n") >= least) & (F.col("rate") > line))


def trajectory_agreement(rows: DataFrame, classes: dict[str, str], label: str, branch: str) -> DataFrame:
    """One row: how many labels equal the conclusion or are of its class; unknown labels disagree and are counted apart; no rows, ratio 0."""
    of = F.create_map(*(F.lit(x) for pair in classes.items() for x in pair))
    mine, code = F.col(label), F.coalesce(F.col(branch), F.lit("success"))
    a, b = F.try_element_at(of, mine), F.try_element_at(of, code)
    agree = a.isNotNull() & ((mine == code) | F.coalesce(a == b, F.lit(False)))
    out = rows.agg(F.count("*").alias("n"), F.count(F.when(agree, 1)).alias("agree"), F.count(F.when(a.isNull(), 1)).alias("unregistered"))
    return out.withColumn("agreement", F.coalesce(ratio(F.col("agree"), F.col("n")), F.lit(0.0)))


def prefilled(cards: DataFrame, key: str, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """cards(key) with the bucket that all matching rules name; several buckets or none suggest nothing, and people decide anyway."""
    buckets = F.array_distinct(F.filter(F.array(*(F.when(F.coalesce(test, F.lit(False)), bucket) for bucket, test in rules)), lambda x: x.isNotNull()))
    rows = cards.select(key, buckets.alias("_b"))
    return rows.select(key, F.when(F.size("_b") == 1, F.element_at("_b", 1)).alias("suggestion"), F.lit(True).alias("needs_human"))


def admitted_triage(rows: DataFrame, key: Sequence[str], filled: Sequence[str]) -> DataFrame:
    """(rows, blank, conflicts, admitted): a triage list is taken whole or not at all: every field filled, no key with two answers."""
    blank = F.lit(False)
    for name in filled:
        blank = blank | (F.trim(F.coalesce(F.col(name), F.lit(""))) == "")
    per_key = rows.groupBy(*key).agg(F.count("*").alias("n"), F.count(F.when(blank, 1)).alias("blank"), F.countDistinct(*filled).alias("answers"))
    out = per_key.agg(F.sum("n").alias("rows"), F.sum("blank").alias("blank"), F.count(F.when(F.col("answers") > 1, 1)).alias("conflicts"))
    return out.withColumn("admitted", F.coalesce((F.col("blank") == 0) & (F.col("conflicts") == 0), F.lit(False)))


def arbitrated(evidence: DataFrame, by: str, weights: dict[str, float], decisive: str) -> DataFrame:
    """(by, branch, score, agreed) from evidence(by, level, branch, confidence): the branch of most weight times confidence;
    evidence of the decisive level ends the matter; agreed where two levels name the branch. Ties go to the smaller name."""
    weight = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in weights.items() for x in pair)), F.col("level")), F.lit(0.0))
    per_branch = evidence.groupBy(by, "branch").agg(F.sum(weight * F.col("confidence")).alias("score"), F.countDistinct("level").alias("levels"), F.bool_or(F.col("level") == decisive).alias("sure"))
    best = F.row_number().over(W.partitionBy(by).orderBy(F.desc("sure"), F.desc(F.round("score", 9)), "branch"))
    out = per_branch.withColumn("_rank", best).where("_rank = 1")
    return out.select(by, "branch", "score", (F.col("sure") | (F.col("levels") >= 2)).alias("agreed"))


def quality_verdict(redline: Column, minimum_failed: Column, score: Column) -> Column:
    """reject for a redline; a failed minimum is drawn again at a score of 2 and less, else rejected; all else is accepted."""
    return F.when(redline, "reject").when(minimum_failed & (score <= 2), "resample").when(minimum_failed, "reject").otherwise("accept")


def converted(judged: DataFrame, index: DataFrame, skipped: Sequence[str]) -> DataFrame:
    """Judge rows with their gold id and what became of each: an explicit id wins, else the first row of its key.

    judged(row, golden_id, key, dimension, score), index(golden_id, key, seq).
    """
    first = index.groupBy("key").agg(F.min(F.struct("seq", "golden_id")).getField("golden_id").alias("_first"))
    known = index.select(F.col("golden_id").alias("_known")).distinct()
    rows = judged.join(first, "key", "left").withColumn("golden_id", F.coalesce("golden_id", "_first")).join(known, F.col("golden_id") == F.col("_known"), "left")
    state = F.when(F.col("dimension").isin(*skipped), "skipped").when(F.col("_known").isNull(), "unmatched").when(F.col("score").isNull(), "no_score").otherwise("taken")
    return rows.select("row", "golden_id", state.alias("state"))


def undeclared_calls(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """calls(id, tool, arguments) with what is wrong: unknown_tool, bad_json, extra_arguments or null; tools(tool, names)."""
    params = F.from_json("arguments", "map<string,string>")
    rows = calls.join(tools, "tool", "left")
    extra = F.size(F.array_except(F.map_keys(params), F.col("names"))) > 0
    problem = F.when(F.col("names").isNull(), "unknown_tool").when(F.try_parse_json("arguments").isNull(), "bad_json").when(extra, "extra_arguments")
    return rows.select("id", "tool", problem.alias("problem"))
