"""Release gates, corrections and classifications as ordered rules over columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.operators import metrics

MARK = "[was "


def first_rule(rules: Sequence[tuple[str, Column]], default: str | None = None) -> Column:
    """The name of the first rule that holds; a null test does not."""
    out = F.lit(default).cast("string")
    for name, test in reversed(list(rules)):
        out = F.when(F.coalesce(test, F.lit(False)), name).otherwise(out)
    return out


def known_label(label: Column, classes: dict[str, str]) -> Column:
    """The class of a label; an unknown one fails the job instead of becoming null."""
    table = F.create_map(*(F.lit(x) for pair in classes.items() for x in pair))
    found = F.try_element_at(table, label)
    return F.when(label.isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("unknown label: "), label)))


def hard_agreement(gold: Column, pred: Column) -> Column:
    """missing parts first, then agree or disagree."""
    return F.when(gold.isNull() & pred.isNull(), "both_missing").when(pred.isNull(), "pred_missing").when(gold.isNull(), "gold_missing").when(gold == pred, "agree").otherwise("disagree")


def tier_gap(a: Column, b: Column, low: int = 1, high: int = 5) -> Column:
    return F.when(a.between(low, high) & b.between(low, high), F.abs(a - b))


def scout_bucket(rows: DataFrame) -> DataFrame:
    """rows(reason, undetermined, veto, min_score) with their bucket: skip, quarantine, negative, positive."""
    rules = [("skip", F.col("reason").isNotNull()), ("quarantine", F.col("undetermined")), ("negative", F.col("veto") | (F.col("min_score") <= 2))]
    return rows.withColumn("bucket", first_rule(rules, "positive"))


def downgraded(outcomes: DataFrame, chosen: Column, branch: str) -> DataFrame:
    """outcomes with the chosen ones set to another branch; what it was first is kept, and marked ones are left alone."""
    evidence = F.coalesce("evidence", F.lit(""))
    change = chosen & ~F.startswith(evidence, F.lit(MARK))
    was = F.coalesce("branch", F.lit("success"))
    return outcomes.withColumns(
        {
            "branch_before": F.when(change, was).otherwise(F.col("branch_before")),
            "evidence": F.when(change, F.concat(F.lit(MARK), was, F.lit("] "), evidence)).otherwise(F.col("evidence")),
            "branch": F.when(change, F.lit(branch)).otherwise(F.col("branch")),
        }
    )


def reviewed(outcomes: DataFrame, verdicts: DataFrame, fits: dict[str, Sequence[str]], known: Sequence[str] | None = None, reviewable: Sequence[str] | None = None) -> DataFrame:
    """outcomes with people's verdicts: one that fits the question sets the branch, another is kept beside it.

    A verdict that is not among the known ones is an error; outcomes whose branch is not reviewable stay as they are.
    """
    if known is not None:
        stop = F.raise_error(F.concat(F.lit("unknown verdict: "), F.col("verdict"))).cast("string")
        verdicts = verdicts.withColumn("verdict", F.when(F.col("verdict").isNull() | F.col("verdict").isin(list(known)), F.col("verdict")).otherwise(stop))
    rows = outcomes.join(verdicts.select("run", "url", "verdict"), ["run", "url"], "left")
    if reviewable is not None:
        rows = rows.withColumn("verdict", F.when(F.col("branch").isin(list(reviewable)), F.col("verdict")))
    fit = F.lit(False)
    for question, labels in fits.items():
        fit = fit | ((F.col("question") == question) & F.col("verdict").isin(*labels))
    fit = F.coalesce(fit, F.lit(False))
    return rows.withColumns(
        {
            "branch_before_review": F.when(fit, F.col("branch")),
            "site_verdict": F.when(~fit, F.col("verdict")),
            "source": F.when(fit, "human").otherwise(F.col("source")),
            "branch": F.when(fit, F.col("verdict")).otherwise(F.col("branch")),
        }
    ).drop("verdict")


def gate(criteria: DataFrame) -> DataFrame:
    """One row from criteria(name, value, line, enforced): passes only if every enforced one is evaluable and met."""
    met = F.col("value") >= F.col("line")
    failed = F.col("enforced") & ~F.coalesce(met, F.lit(False))
    return criteria.agg(
        (~F.coalesce(F.bool_or(failed), F.lit(True))).alias("passed"),
        F.array_sort(F.collect_list(F.when(failed & F.col("value").isNotNull(), F.col("name")))).alias("missed"),
        F.array_sort(F.collect_list(F.when(F.col("enforced") & F.col("value").isNull(), F.col("name")))).alias("not_evaluable"),
    )


def dual_run(a: DataFrame, b: DataFrame, share_line: float = 0.05) -> DataFrame:
    """Branch shares of two corpora side by side and whether they differ by more than the line."""
    both = a.select("branch", F.lit("a").alias("side")).unionByName(b.select("branch", F.lit("b").alias("side")))
    counts = both.groupBy("branch", "side").agg(F.count("*").alias("n"))
    totals = both.groupBy("side").agg(F.count("*").alias("total"))  # two rows
    share = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n") / F.col("total"))), F.lit(0.0)).alias(side)
    rows = counts.join(F.broadcast(totals), "side").groupBy("branch").agg(share("a"), share("b"))
    return rows.withColumn("over", F.abs(F.col("a") - F.col("b")) > share_line)


def median_shift(a: DataFrame, b: DataFrame, value: str, by: str, line: float = 0.3) -> DataFrame:
    """Medians of two corpora by family side by side, their relative difference, and whether it is above the line; a family that
    only one corpus has, or whose first median is 0, has no difference."""
    half = lambda df, name: metrics.medians(df, value, by).where(F.col(by).isNotNull()).select(by, F.col("median").alias(name))
    rows = half(a, "a").join(half(b, "b"), by, "full")
    return rows.withColumn("difference", F.try_divide(F.abs(F.col("a") - F.col("b")), "a")).withColumn("over", F.coalesce(F.col("difference") > line, F.lit(False)))


def retest(rounds: DataFrame) -> DataFrame:
    """Kappa of labels between the first and second round of rounds(id, round, label)."""
    one = rounds.where("round = 1").select("id", F.col("label").alias("first"))
    two = rounds.where("round = 2").select("id", F.col("label").alias("second"))
    return metrics.cohen_kappa(one.join(two, "id"), "first", "second")


def clause_invariance(baseline: DataFrame, current: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Per clause how many predictions moved, and whether that is a violation: undeclared clauses may not move."""
    pairs = baseline.select("id", "clause", F.col("pred").alias("old")).join(current.select("id", "clause", F.col("pred").alias("new")), ["id", "clause"])
    moved = F.count(F.when(~F.col("old").eqNullSafe(F.col("new")), 1))
    out = pairs.groupBy("clause").agg(F.count("*").alias("n"), moved.alias("moved"))
    return out.withColumn("violation", (F.col("moved") > 0) & ~F.col("clause").isin(*declared))
