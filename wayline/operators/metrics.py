"""Agreement, classification and distribution metrics. A ratio without a denominator is null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def histogram(df: DataFrame, key: str) -> DataFrame:
    """Counts by key; null means success here and is no failure branch."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))


def cohen_kappa(pairs: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Cohen's kappa of two labels; null without rows, with fewer than two labels or where chance explains all."""
    pairs = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn("_all", F.lit(1))
    by = ["_all", *by]
    cells = pairs.groupBy(*by, F.col(a).alias("x"), F.col(b).alias("y")).agg(F.count("*").alias("n"))
    sides = cells.select(*by, F.explode(F.array(F.struct(F.col("x").alias("label"), F.col("n").alias("na"), F.lit(0).cast("long").alias("nb")), F.struct(F.col("y").alias("label"), F.lit(0).cast("long").alias("na"), F.col("n").alias("nb")))).alias("s")).select(*by, "s.*")
    labels = sides.groupBy(*by, "label").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    chance = labels.groupBy(*by).agg(F.count("*").alias("labels"), F.sum(F.col("na") * F.col("nb")).cast("double").alias("both"))
    total = cells.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("x") == F.col("y"), F.col("n")).otherwise(0)).alias("same"))
    po, pe = F.col("same") / F.col("n"), F.col("both") / (F.col("n") * F.col("n"))
    return total.join(chance, by).withColumn("kappa", F.when((F.col("labels") >= 2) & (pe < 1), (po - pe) / (1 - pe))).drop("_all", "both", "labels")


def weighted_kappa(pairs: DataFrame, a: str, b: str, low: int, high: int) -> DataFrame:
    """Linearly weighted kappa of two scores."""
    rows = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    weight = lambda x, y: 1 - F.abs(x - y) / F.lit(high - low)
    observed = rows.agg(F.count("*").alias("n"), F.avg(weight(F.col(a), F.col(b))).alias("po"))
    xs = rows.groupBy(F.col(a).alias("x")).agg(F.count("*").alias("nx"))
    ys = rows.groupBy(F.col(b).alias("y")).agg(F.count("*").alias("ny"))
    # scores are a closed range of a few values: the grid is (high - low + 1) squared rows at most
    grid = F.explode(F.sequence(F.lit(low), F.lit(high)))
    chance = xs.withColumn("y", grid).join(ys, "y").agg(F.sum(F.col("nx") * F.col("ny") * weight(F.col("x"), F.col("y"))).alias("s"), F.countDistinct("x").alias("kx"), F.countDistinct("y").alias("ky"))
    pe = F.col("s") / (F.col("n") * F.col("n"))
    kappa = F.when((F.col("n") > 0) & (F.greatest("kx", "ky") >= 2) & (pe < 1), (F.col("po") - pe) / (1 - pe))
    return observed.withColumn("_k", F.lit(1)).join(chance.withColumn("_k", F.lit(1)), "_k").select("n", kappa.alias("kappa"))


def classification_report(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per class true and false positives and negatives, precision, recall and F1.

    A ratio without a denominator is null. F1 is precision or recall where the other is null or 0.
    """
    cells = rows.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("long")
    hit = F.col("t") == F.col("p")
    parts = F.array(
        F.struct(F.col("t").alias("label"), F.when(hit, F.col("n")).otherwise(zero).alias("tp"), zero.alias("fp"), F.when(hit, zero).otherwise(F.col("n")).alias("fn")),
        F.struct(F.col("p").alias("label"), zero.alias("tp"), F.when(hit, zero).otherwise(F.col("n")).alias("fp"), zero.alias("fn")),
    )
    out = cells.select(F.explode(parts).alias("c")).select("c.*").groupBy("label").agg(*(F.sum(k).alias(k) for k in ("tp", "fp", "fn")))
    out = out.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.when(F.coalesce(p, F.lit(0.0)) == 0, F.coalesce(F.when(p.isNull() | (r > 0), r), p)).when(F.coalesce(r, F.lit(0.0)) == 0, p).otherwise(2 * p * r / (p + r)))


def three_state(rows: DataFrame, by: Sequence[str], gold: Column, pred: Column, undetermined: Column) -> DataFrame:
    """agree, disagree and undetermined; undetermined rows leave the denominator and are reported apart."""
    state = F.when(undetermined, "undetermined").when(gold.eqNullSafe(pred), "agree").otherwise("disagree")
    count = lambda name: F.count(F.when(F.col("_state") == name, 1)).alias(name)
    out = rows.withColumn("_state", state).groupBy(*by).agg(F.count("*").alias("n"), count("agree"), count("disagree"), count("undetermined"))
    return out.withColumn("agreement", ratio(F.col("agree"), F.col("agree") + F.col("disagree"))).withColumn("abstention", ratio(F.col("undetermined"), F.col("n")))


def within_tolerance(rows: DataFrame, by: Sequence[str], a: str, b: str, tolerance: int, low: int = 1, high: int = 5) -> DataFrame:
    """How many scores in range differ by no more than a tolerance; others are counted as skipped."""
    valid = F.col(a).between(low, high) & F.col(b).between(low, high)
    valid = F.coalesce(valid, F.lit(False))
    near = F.count(F.when(valid & (F.abs(F.col(a) - F.col(b)) <= tolerance), 1))
    out = rows.groupBy(*by).agg(F.count(F.when(valid, 1)).alias("n"), near.alias("near"), F.count(F.when(~valid, 1)).alias("skipped"))
    return out.withColumn("agreement", ratio(F.col("near"), F.col("n")))


def mode(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The most frequent value (of equals the smallest), its share and how many values there are."""
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("c"))
    top = F.min(F.struct((-F.col("c")).alias("neg"), F.col(value).alias("v")))
    out = counts.groupBy(*by).agg(top.alias("top"), F.sum("c").alias("n"), F.count("*").alias("distinct_values"))
    return out.select(*by, F.col("top.v").alias("mode"), (-F.col("top.neg") / F.col("n")).alias("share"), "n", "distinct_values")


def label_conflicts(rows: DataFrame, url: str, label: str, split: str) -> DataFrame:
    """Urls with several labels: their counts, most frequent first, and the splits they are in."""
    counts = rows.groupBy(url, label).agg(F.count("*").alias("n"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), F.col(label).alias("label"))))
    text = F.array_join(F.transform(listed, lambda x: F.concat(x["label"].cast("string"), F.lit(":"), (-x["neg"]).cast("string"))), ",")
    labels = counts.groupBy(url).agg(text.alias("labels"), F.count("*").alias("k")).where("k > 1").drop("k")
    splits = rows.groupBy(url).agg(F.array_join(F.array_sort(F.collect_set(split)), ",").alias("splits"))
    return labels.join(splits, url)


def split_leakage(rows: DataFrame, url: str, split: str, held: str) -> DataFrame:
    """How many urls are in several splits, and how many held-out rows are on such urls."""
    per_url = rows.groupBy(url).agg(F.countDistinct(split).alias("k"), F.count(F.when(F.col(split) == held, 1)).alias("held"))
    leaking = F.col("k") > 1
    out = per_url.agg(F.count(F.when(leaking, 1)).alias("leaking_urls"), F.sum(F.when(leaking, F.col("held")).otherwise(0)).alias("leaking_rows"), F.sum("held").alias("held_rows"))
    return out.withColumn("leakage", ratio(F.col("leaking_rows"), F.col("held_rows")))


def coverage(rows: DataFrame, domain: DataFrame, key: str) -> DataFrame:
    """Counts for every value of a domain, zeros too."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return domain.join(counts, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def merged_scores(units: DataFrame, by: Sequence[str], score: str, veto: str, order: str) -> DataFrame:
    """One score for many: null if one is null, else that of the first veto, else the least."""
    vetoed = F.min(F.when(F.col(veto), F.struct(order, score)))
    out = units.groupBy(*by).agg(F.bool_or(F.col(score).isNull()).alias("_null"), vetoed.alias("_veto"), F.min(score).alias("_min"))
    merged = F.when(F.col("_null"), None).when(F.col("_veto").isNotNull(), F.col(f"_veto.{score}")).otherwise(F.col("_min"))
    return out.select(*by, merged.alias("score"), F.col("_veto").isNotNull().alias("vetoed"))


def medians(rows: DataFrame, value: str, by: str) -> DataFrame:
    """Exact medians by group and over all (group null): the middle of the running counts of distinct values."""
    rows = rows.where(F.col(value).isNotNull())
    counts = rows.groupingSets([[value, by], [value]], value, by).agg(F.count("*").alias("_c"), F.grouping(by).alias("_all"))
    group = W.partitionBy("_all", by)
    so_far, n = F.sum("_c").over(group.orderBy(value).rowsBetween(W.unboundedPreceding, 0)), F.sum("_c").over(group)
    counts = counts.withColumn("_so_far", so_far).withColumn("n", n)
    # the value at a place is the least whose running count reaches it
    at = lambda place: F.min(F.when(F.col("_so_far") >= place, F.col(value)))
    low, high = at(F.floor((F.col("n") + 1) / 2)), at(F.floor(F.col("n") / 2) + 1)
    return counts.groupBy("_all", by).agg(((low + high) / F.lit(2.0)).alias("median"), F.max("n").alias("n")).select(by, "median", "n")


def drift(current: DataFrame, baseline: DataFrame, keys: Sequence[str], threshold: float) -> DataFrame:
    """Differences from a baseline, over the threshold or not; without a baseline there is none."""
    rows = current.join(baseline.withColumnRenamed("score", "base"), list(keys), "left")
    off = F.abs(F.col("score") - F.coalesce("base", "score"))
    return rows.select(*keys, "score", "base", off.alias("off"), (off > threshold).alias("drifted"))


def rank_within(by: Sequence[str], *order: Column) -> Column:
    return F.row_number().over(W.partitionBy(*by).orderBy(*order))
