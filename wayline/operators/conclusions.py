"""Conclusions of visits: whether what they presuppose holds, and how often they are wrong."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The branch that presupposes a gate, those that presuppose that a click led elsewhere, and the one that is left.
GATED, ELSEWHERE, LEFT = "subscription_wall", ("component_unverified",), "unresolved"

#: A page as failed_precondition() compares it.
PAGE = "struct<url:string,body:string,elements:int>"


def same_page(before: Column, after: Column) -> Column:
    """Whether two pages are the same: address, body and number of elements; null counts as empty and as none."""
    text = lambda p, name: F.coalesce(p[name], F.lit(""))
    count = lambda p: F.coalesce(p["elements"], F.lit(0))
    return (text(before, "url") == text(after, "url")) & (text(before, "body") == text(after, "body")) & (count(before) == count(after))


def failed_precondition(branch: Column, page: Column, before: Column, quotes: Column, gate: Callable[[Column], Column], gated: str = GATED, elsewhere: Collection[str] = ELSEWHERE) -> Column:
    """Why a branch cannot be: no_gate where it presupposes a gate and neither the page nor what was quoted of it shows one; same_page
    where it presupposes that a click led elsewhere and the pages before and after are the same. '' where it can, and where page
    or branch are missing; without a page before, nothing can be the same."""
    shows = lambda text: F.coalesce(gate(F.coalesce(text, F.lit(""))), F.lit(False))
    quoted = F.array_join(F.coalesce(quotes, F.array().cast("array<string>")), " ")
    asked = page.isNotNull() & branch.isNotNull()
    return (
        F.when(asked & (branch == gated) & ~(shows(page["body"]) | shows(quoted)), "no_gate")
        .when(asked & branch.isin(*elsewhere) & before.isNotNull() & same_page(before, page), "same_page")
        .otherwise("")
    )


def guarded(outcomes: DataFrame, gate: Callable[[Column], Column], texts: Mapping[str, str], left: str = LEFT, **branches) -> DataFrame:
    """outcomes(branch, evidence, page PAGE, before PAGE, quotes, ...) where branches that cannot be become `left`.

    Of these branch_before_guard keeps the branch, and the evidence begins with why, as `texts` says it of no_gate and same_page; for the
    others branch_before_guard is null.
    """
    why = failed_precondition(F.col("branch"), F.col("page"), F.col("before"), F.col("quotes"), gate, **branches)
    said = F.lit(None).cast("string")
    for name in ("no_gate", "same_page"):
        said = F.when(F.col("_why") == name, F.lit(texts[name])).otherwise(said)
    bad = F.col("_why") != ""
    rows = outcomes.withColumn("_why", why)
    changed = {
        "branch_before_guard": F.when(bad, F.col("branch")),
        "evidence": F.when(bad, F.concat_ws(" ", F.concat(F.lit("["), F.col("branch"), F.lit("]"), F.lit(" "), said), F.col("evidence"))).otherwise(F.col("evidence")),
        "branch": F.when(bad, left).otherwise(F.col("branch")),
    }
    return rows.withColumns(changed).drop("_why")


def conclusion_errors(rows: DataFrame, classes: Mapping[str, str], inconclusive: Collection[str], success: str = "success") -> DataFrame:
    """(state, agree, disagree, undetermined, rate, unregistered) of rows(label, branch): how often a conclusion is wrong.

    A missing branch is a success. Both sides conclude something unless their class is one of `inconclusive` or the label is empty; only such rows
    count. state: untestable without rows, where a label is in no class (unregistered lists them), or where no row counts; else readout, with
    the rate of rows whose classes differ.
    """
    table = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])
    label, branch = F.trim(F.coalesce("label", F.lit(""))), F.trim(F.coalesce("branch", F.lit(success)))
    told = rows.select(label.alias("label"), branch.alias("branch"), F.try_element_at(table, label).alias("gold"), F.try_element_at(table, branch).alias("pred"))
    unknown = F.array_compact(F.array(F.when((F.col("label") != "") & F.col("gold").isNull(), F.col("label")), F.when((F.col("branch") != "") & F.col("pred").isNull(), F.col("branch"))))
    decides = lambda c: F.coalesce(~F.col(c).isin(*inconclusive), F.lit(False))
    both = decides("gold") & decides("pred")
    told = told.withColumn("unknown", unknown).withColumn("both", both).withColumn("same", F.col("gold") == F.col("pred"))
    names = told.select(F.explode("unknown").alias("name")).agg(F.array_sort(F.collect_set("name")).alias("unregistered"))  # labels are a closed list
    counts = told.agg(F.count("*").alias("n"), F.count_if(F.col("both") & F.col("same")).alias("agree"), F.count_if(F.col("both") & ~F.col("same")).alias("disagree"), F.count_if(~F.col("both")).alias("undetermined"))
    met = counts.withColumn("one", F.lit(1)).join(names.withColumn("one", F.lit(1)), "one")
    decided = F.col("agree") + F.col("disagree")
    fine = (F.size("unregistered") == 0) & (decided > 0)
    return met.select(F.when(fine, "readout").otherwise("untestable").alias("state"), "agree", "disagree", "undetermined", F.when(fine, F.col("disagree") / decided).alias("rate"), "unregistered")
