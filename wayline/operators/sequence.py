"""Operators on ordered rows: loops, islands, ranges, first and last values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ordered(by: Sequence[str], order: Sequence[str]) -> W:
    return W.partitionBy(*by).orderBy(*order)


def conclusion(outcomes: DataFrame, included: Column) -> DataFrame:
    """The branch of each run's last included outcome (null is success); `unresolved` where there is none."""
    last = F.max(F.when(included, F.struct("idx", F.struct("branch").alias("b"))))
    row = outcomes.groupBy("run").agg(last.alias("last"))
    return row.select("run", F.when(F.col("last").isNull(), "unresolved").otherwise(F.col("last.b.branch")).alias("branch"), F.when(F.col("last").isNull(), "no_outcome_left").alias("reason"))


def without_loops(steps: DataFrame, by: Sequence[str], order: Sequence[str], same: Sequence[str]) -> DataFrame:
    """Steps that differ from the one before; equality is transitive, so that is the last kept one too."""
    w = ordered(by, order)
    equal = F.lit(True)
    for name in same:
        equal = equal & F.col(name).eqNullSafe(F.lag(name).over(w))
    first = F.row_number().over(w) == 1
    return steps.withColumn("_keep", first | ~equal).where("_keep").drop("_keep")


def repeats(steps: DataFrame, by: Sequence[str], order: Sequence[str], key: str) -> DataFrame:
    """steps with how often their key came so far and whether it came before."""
    times = F.row_number().over(ordered([*by, key], order))
    return steps.withColumn("times", times).withColumn("repeated", times >= 2)


def islands(steps: DataFrame, by: Sequence[str], order: Sequence[str], key: Column) -> DataFrame:
    """steps with the number of the run of equal keys they are in, and their place in it from 0."""
    w = ordered(by, order)
    rows = steps.withColumn("_key", key)
    new = F.when(F.col("_key").eqNullSafe(F.lag("_key").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    rows = rows.withColumn("_new", new)
    rows = rows.withColumn("island", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return rows.withColumn("place", F.row_number().over(ordered([*by, "island"], order)) - 1).drop("_key", "_new")


def adjacent_repeats(steps: DataFrame, by: Sequence[str], order: Sequence[str], key: Column) -> DataFrame:
    """Steps like the one before, every other one of a run of them: a reported one hides the next."""
    return islands(steps, by, order, key).where("place % 2 = 1").drop("island", "place")


def long_islands(steps: DataFrame, by: Sequence[str], order: Sequence[str], key: Column, least: int, every: Column) -> DataFrame:
    """Runs of at least `least` equal keys whose rows all hold `every`."""
    rows = islands(steps.withColumn("_every", every), by, order, key)
    return rows.groupBy(*by, "island").agg(F.count("*").alias("n"), F.bool_and("_every").alias("_all"), F.min(order[0]).alias("first")).where((F.col("n") >= least) & F.col("_all")).drop("_all")


def dead_loops(steps: DataFrame, by: Sequence[str], order: Sequence[str], same: Column, empty: Column, width: int = 3) -> DataFrame:
    """steps with whether the last `width` are identical or all empty."""
    w = ordered(by, order).rowsBetween(-(width - 1), 0)
    rows = steps.withColumn("_same", same).withColumn("_empty", empty)
    full = F.count(F.lit(1)).over(w) == width
    loop = full & ((F.min("_same").over(w) == F.max("_same").over(w)) | (F.min(F.col("_empty").cast("int")).over(w) == 1))
    return rows.withColumn("dead_loop", F.coalesce(loop, F.lit(False))).drop("_same", "_empty")


def drops(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """rows with whether a value is less than at the read before."""
    return rows.withColumn("dropped", F.coalesce(F.col(value) < F.lag(value).over(ordered(by, order)), F.lit(False)))


def step_ranges(units: DataFrame, by: Sequence[str], order: Sequence[str], size: str) -> DataFrame:
    """units with the half-open range of global step numbers they cover."""
    end = F.sum(size).over(ordered(by, order).rowsBetween(W.unboundedPreceding, 0))
    return units.withColumn("start", end - F.col(size)).withColumn("end", end)


def first_seen(rows: DataFrame, by: Sequence[str], key: str, order: str) -> DataFrame:
    """Where each key is seen first; a reference before that is one into the future."""
    return rows.groupBy(*by, key).agg(F.min(order).alias("first_seen"))


def leaks(mentions: DataFrame, observed: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """Mentions (by, key, at) of what is observed (by, key, at) only then or later."""
    seen = first_seen(observed, by, key, "at")
    return mentions.join(seen, [*by, key]).where("first_seen >= at")


def latest(rows: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    best = rows.groupBy(*key).agg(F.max(F.struct(*order, F.struct(*columns).alias("_row"))).getField("_row").alias("_row"))
    return best.select(*key, "_row.*")


def settled(rows: DataFrame, key: Sequence[str], claim: str) -> DataFrame:
    """Per key the one claim made, if all that make one agree; conflict where they do not."""
    made = F.collect_set(claim)
    n = F.size(made)
    return rows.groupBy(*key).agg(n.alias("n"), F.when(n == 1, F.min(claim)).alias("claim")).withColumn("conflict", F.col("n") > 1).drop("n")


def admitted(rows: DataFrame, by: Sequence[str], host: str, order: Sequence[str], most: int) -> DataFrame:
    """Rows within the quota of their host; no host or no quota admits all."""
    rank = F.row_number().over(ordered([*by, host], order))
    return rows.withColumn("admitted", F.lit(most <= 0) | (F.coalesce(host, F.lit("")) == "") | (rank <= most))


def fold_failures(calls: DataFrame, by: Sequence[str], order: Sequence[str], is_tool: Column, ok: Column) -> DataFrame:
    """Without failed results that another attempt follows: of each unbroken run of tool calls the successes and,
    where no success ends it, the last attempt."""
    rows = islands(calls.withColumn("_tool", is_tool).withColumn("_ok", ok), by, order, F.col("_tool"))
    last = F.max(order[0]).over(W.partitionBy(*by, "island"))
    return rows.withColumn("_last", last).where(~F.col("_tool") | F.col("_ok") | (F.col(order[0]) == F.col("_last"))).drop("_tool", "_ok", "_last", "island", "place")


def fold_runs(rows: DataFrame, by: Sequence[str], order: Sequence[str], key: Column, folded: Column, keep: str) -> DataFrame:
    """Of each run of equal keys that is `folded` the first or last row; all other rows."""
    runs = islands(rows.withColumn("_folded", folded), by, order, key)
    edge = F.min("place") if keep == "first" else F.max("place")
    return runs.withColumn("_edge", edge.over(W.partitionBy(*by, "island"))).where(~F.col("_folded") | (F.col("place") == F.col("_edge"))).drop("_folded", "_edge", "island", "place")


def health_prefix(steps: DataFrame, by: Sequence[str], order: str, ok: Column) -> DataFrame:
    """How many steps fail before the first success; all, if none succeeds."""
    w = ordered(by, [order])
    rows = steps.withColumn("_n", F.row_number().over(w)).withColumn("_ok", ok)
    return rows.groupBy(*by).agg(F.coalesce(F.min(F.when(F.col("_ok"), F.col("_n"))) - 1, F.count("*")).alias("failures_first"))
