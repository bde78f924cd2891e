"""Top-k and budgets: samples by hash order, digests of text within a number of characters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def hash_order(seed: str, *keys: str) -> Column:
    """An order that content alone decides."""
    return F.sha2(F.concat_ws("\u0001", F.lit(seed), *(F.col(k).cast("string") for k in keys)), 256)


#: Parts of a stratum that are ranked apart, so that none is ranked in one task.
PARTS = 256


def draw(rows: DataFrame, strata: Sequence[str], quota: int, seed: str, keys: Sequence[str]) -> DataFrame:
    """Up to a quota of rows from each stratum, with its size and their weight.

    The first of each of PARTS parts of a stratum are found first, and the first of these then: both ranks are of at most
    PARTS * quota rows or a part.
    """
    order = (F.col("_order"), *keys)
    rows = rows.withColumn("_order", hash_order(seed, *keys)).withColumn("_part", F.pmod(F.xxhash64("_order"), F.lit(PARTS)))
    sizes = rows.groupBy(*strata).agg(F.count("*").alias("population")).select(*(F.col(s).alias(f"_{s}") for s in strata), "population")
    first = rows.withColumn("_rank", F.row_number().over(W.partitionBy(*strata, "_part").orderBy(*order))).where(F.col("_rank") <= quota)
    few = first.withColumn("_rank", F.row_number().over(W.partitionBy(*strata).orderBy(*order))).where(F.col("_rank") <= quota)
    same = [F.col(s).eqNullSafe(F.col(f"_{s}")) for s in strata]
    out = few.join(sizes, same).drop("_rank", "_part", "_order", *(f"_{s}" for s in strata))
    return out.withColumn("weight", F.col("population") / F.least(F.col("population"), F.lit(quota)))


def split_by_ratio(rows: DataFrame, label: str, share: float, seed: str, keys: Sequence[str]) -> DataFrame:
    """rows with a split: of each label the first bround(n * share) in hash order calibrate, the rest are held out.

    The order begins with the hash's first digits; counts of these tell how many rows come before a group of them, so only
    rows of one group are ranked together.
    """
    rows = rows.withColumn("_order", hash_order(seed, *keys)).withColumn("_part", F.substring("_order", 1, 3))
    counts = rows.groupBy(label, "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(label).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    total = F.sum("_n").over(W.partitionBy(label))
    counts = counts.select(F.col(label).alias("_label"), F.col("_part").alias("_group"), F.coalesce(before, F.lit(0)).alias("_before"), F.bround(total * share).alias("_most"))
    rank = F.row_number().over(W.partitionBy(label, "_part").orderBy("_order", *keys))
    ranked = rows.withColumn("_rank", rank).join(counts, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_part") == F.col("_group")))
    split = F.when(F.col("_before") + F.col("_rank") <= F.col("_most"), "calibration").otherwise("holdout")
    return ranked.withColumn("split", split).drop("_order", "_part", "_rank", "_label", "_group", "_before", "_most")


def proportional_quotas(rows: DataFrame, label: str, k: int) -> DataFrame:
    """How many of k rows each label gets: the floor of its share, the rest to the largest labels."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy(F.lit(1)))
    counts = counts.withColumn("quota", F.floor(F.col("n") * k / total))
    left = F.lit(k) - F.sum("quota").over(W.partitionBy(F.lit(1)))
    rank = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc("n"), label))
    return counts.withColumn("quota", F.col("quota") + (rank <= left).cast("int")).select(label, "n", "quota")


def assign_strata(rows: DataFrame, strata: Sequence[tuple[str, Column]]) -> DataFrame:
    """rows with the first stratum they meet and the others they meet too."""
    met = F.filter(F.array(*(F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in strata)), lambda x: x.isNotNull())
    return rows.withColumn("_met", met).withColumn("stratum", F.try_element_at("_met", F.lit(1))).withColumn("also_in", F.slice("_met", 2, len(strata))).drop("_met")


def digest(lines: DataFrame, by: Sequence[str], limit: int) -> DataFrame:
    """Text of at most about `limit` characters from lines (by, idx, line, score).

    Lines of score 4 stay whatever they cost. The others follow by score, then place; the first that does not fit
    is cut, and none after it is taken. What is taken is put back in order of place. A line costs its end too.
    """
    cost = F.length("line") + 1
    must = F.sum(F.when(F.col("score") >= 4, cost).otherwise(0)).over(W.partitionBy(*by))
    order = W.partitionBy(*by, F.col("score") >= 4).orderBy(F.desc("score"), "idx").rowsBetween(W.unboundedPreceding, -1)
    left = F.lit(limit) - F.col("_must") - F.coalesce(F.sum(cost).over(order), F.lit(0))
    rows = lines.withColumn("_must", must).withColumn("_left", left)
    taken = F.when(F.col("score") >= 4, F.col("line")).when(F.length("line") + 1 <= F.col("_left"), F.col("line")).when(F.col("_left") > 0, F.expr("left(line, cast(_left as int))"))
    out = rows.withColumn("_taken", taken).groupBy(*by).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_taken").isNotNull(), F.struct("idx", F.col("_taken").alias("line"))))), lambda x: x["line"]), "\n").alias("text"),
        F.coalesce(F.bool_or(F.col("_taken").isNull() | (F.length("_taken") < F.length("line"))), F.lit(False)).alias("cut"),
    )
    return out.withColumn("truncated", F.col("cut") | (F.length("text") > limit)).drop("cut")


def pinned_top(rows: DataFrame, by: Sequence[str], pinned: Column, score: str, idx: str, k: int) -> DataFrame:
    """The k best rows, pinned ones first; ties to the earlier."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.when(pinned, 0).otherwise(1), F.desc(score), idx))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def trimmed(items: Column, most: int = 20) -> Column:
    """The first items and how many are hidden."""
    return F.struct(F.slice(items, 1, most).alias("shown"), F.greatest(F.size(items) - most, F.lit(0)).alias("hidden"))


def multiset_minus(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """rows less exactly as many copies as are listed."""
    return rows.exceptAll(gone)
