"""Changes of labels and the removal of runs, planned first and then applied to archives, pool and ledger alike.

A plan is computed from the tables as they are, so a rerun after a crash between two tables finds what is still to be changed
in the others, and one after a finished change finds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.functions.checks import CREDENTIALS
from wayline.operators.golden import attribution

KEY = ["task_id", "url", "branch"]
#: What begins the note that a change leaves in the evidence; a fixed value.
MARK = "[改判 "


def candidates(outcomes: DataFrame, pool: DataFrame, non_samples: Collection[str]) -> DataFrame:
    """(task_id, url, branch, questions, evidence, n_outcomes, runs, in_pool) of everything whose label could change.

    outcomes(run, idx, task_id, url, branch, question, evidence), pool(task_id, url, branch, question, evidence). One row for each
    key of the pool, since one key has one label everywhere. Evidence is the first one in order of run and place, the pool last.
    Rows without a branch and those of non-samples are left out; null tasks and urls are empty.
    """
    text = lambda name: F.coalesce(name, F.lit("")).alias(name)
    both = outcomes.select(text("task_id"), text("url"), "branch", text("question"), text("evidence"), "run", "idx", F.lit(False).alias("pooled"))
    rows = both.unionByName(pool.select(text("task_id"), text("url"), "branch", text("question"), text("evidence"), F.lit(None).cast("string").alias("run"), F.lit(None).cast("int").alias("idx"), F.lit(True).alias("pooled")))
    rows = rows.where((F.col("branch") != "") & ~F.col("branch").isin(*non_samples))
    said = F.col("evidence") != ""
    return rows.groupBy(*KEY).agg(
        F.array_sort(F.collect_set(F.when(F.col("question") != "", F.col("question")))).alias("questions"),
        F.coalesce(F.min_by(F.when(said, F.col("evidence")), F.when(said, F.struct("pooled", "run", "idx"))), F.lit("")).alias("evidence"),
        F.count_if(~F.col("pooled")).alias("n_outcomes"),
        F.count_distinct("run").alias("runs"),
        F.bool_or("pooled").alias("in_pool"),
    )


def relabel_plan(found: DataFrame, to_branch: str, reason: str, origins: Mapping[str, Collection[str]], barred: Collection[str], select: Column | None = None) -> DataFrame:
    """candidates() with `state` and `why`: what a change of the selected ones to to_branch does with each.

    skipped: it has that branch already. rejected: the branch does not belong to the questions it was asked, each of them, or
    where none is known to none of those its own branch comes from; origins tells the questions of each branch in use. merged: the pool has
    the new key, or another candidate, earlier in order of branch, takes it. accepted: all else. The target must be in use and not
    barred, and the reason must be given and show no credential.
    """
    if not reason.strip():
        raise ValueError("a change of label needs a reason")
    if to_branch not in origins or not origins[to_branch] or to_branch in barred:
        raise ValueError(f"{to_branch!r} is no label of a sample in use")
    if any(re.search(pattern, reason, re.IGNORECASE) for pattern in CREDENTIALS.values()):
        raise ValueError("the reason shows a credential")
    unlawful = attribution(F.col("questions"), F.col("branch"), F.lit(to_branch), {branch: sorted(asked) for branch, asked in origins.items() if asked})
    rows = found.where(F.coalesce(select, F.lit(False))) if select is not None else found
    chosen = F.when(F.col("branch") == to_branch, "skipped").when(unlawful != "", "rejected").otherwise("eligible")
    rows = rows.withColumn("state", chosen)
    taken = found.where((F.col("branch") == to_branch) & F.col("in_pool")).select("task_id", "url", F.lit(True).alias("taken"))
    rows = rows.join(taken, ["task_id", "url"], "left")
    place = F.row_number().over(W.partitionBy("task_id", "url", "state").orderBy("branch"))
    merged = F.when(F.col("taken"), "the pool has the new key").when(place > 1, "another takes the new key")
    rows = rows.withColumn("into", F.when(F.col("state") == "eligible", merged))
    why = F.coalesce("into", F.when(F.col("state") == "skipped", "has this branch").when(F.col("state") == "rejected", "belongs to other questions"))
    state = F.when(F.col("into").isNotNull(), "merged").when(F.col("state") == "eligible", "accepted").otherwise(F.col("state"))
    return rows.select(*found.columns, state.alias("state"), why.alias("why"))


def _note(evidence: Column, to_branch: str, reason: str) -> Column:
    return F.concat(F.coalesce(evidence, F.lit("")), F.lit(f"\n\n{MARK}"), F.col("branch"), F.lit(f" → {to_branch}] {reason}"))


def _touched(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows with `_state` of the plan, null where it leaves them alone."""
    keys = plan.where("state IN ('accepted', 'merged')").select(*[F.col(k).alias(f"_{k}") for k in KEY], F.col("state").alias("_state"))
    same = [F.coalesce(k, F.lit("")) == F.col(f"_{k}") for k in KEY]
    return rows.join(keys, same[0] & same[1] & same[2], "left").drop(*[f"_{k}" for k in KEY])


def relabelled_outcomes(outcomes: DataFrame, plan: DataFrame, to_branch: str, reason: str) -> DataFrame:
    """outcomes with their new labels: branch_before_relabel keeps the first label, the evidence gets a note, the source is human."""
    hit = F.col("_state").isNotNull()
    rows = _touched(outcomes, plan)
    if "branch_before_relabel" not in outcomes.columns:
        rows = rows.withColumn("branch_before_relabel", F.lit(None).cast("string"))
    changed = {
        "branch_before_relabel": F.when(hit, F.coalesce("branch_before_relabel", "branch")).otherwise(F.col("branch_before_relabel")),
        "evidence": F.when(hit, _note(F.col("evidence"), to_branch, reason)).otherwise(F.col("evidence")),
        "source": F.when(hit, "human").otherwise(F.col("source")),
        "branch": F.when(hit, to_branch).otherwise(F.col("branch")),
    }
    return rows.withColumns(changed).drop("_state")


def relabelled_pool(pool: DataFrame, plan: DataFrame, to_branch: str, reason: str) -> DataFrame:
    """pool with the rows of accepted candidates relabelled, without those of merged ones."""
    hit = F.col("_state").isNotNull()
    rows = _touched(pool, plan).where("_state IS NULL OR _state <> 'merged'")
    changed = {
        "evidence": F.when(hit, _note(F.col("evidence"), to_branch, reason)).otherwise(F.col("evidence")),
        "source": F.when(hit, "human").otherwise(F.col("source")),
        "branch": F.when(hit, to_branch).otherwise(F.col("branch")),
    }
    return rows.withColumns(changed).drop("_state")


def ledger(outcomes: DataFrame) -> DataFrame:
    """(run, branch, n) of the outcomes of each run: what a run's ledger says after any change, so it needs no change of its own."""
    return outcomes.where("branch <> ''").groupBy("run", "branch").agg(F.count("*").alias("n"))


def purge(archives: DataFrame, pool: DataFrame, runs: Collection[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(archives, pool, account) without some runs: a run goes with its archive, the reviewed one too, and its rows of the pool.

    archives(run, ...), pool(run, ...): account(run, archives, pool_rows) tells what went. Rows without a run stay.
    """
    gone = sorted({run.strip() for run in runs})
    if not gone or "" in gone:
        raise ValueError("no run to purge")
    hit = F.coalesce(F.col("run").isin(gone), F.lit(False))
    told = [frame.where(hit).groupBy("run").agg(F.count("*").alias(name)) for frame, name in ((archives, "archives"), (pool, "pool_rows"))]
    account = told[0].join(told[1], "run", "full").select("run", F.coalesce("archives", F.lit(0)).alias("archives"), F.coalesce("pool_rows", F.lit(0)).alias("pool_rows"))
    return archives.where(~hit), pool.where(~hit), account
