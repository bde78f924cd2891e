"""Joins of the pipeline's records: visits with outcomes, gold with predictions, pages of two corpora."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.operators.prefixes import prefix_meetings


def match_visits(visits: DataFrame, outcomes: DataFrame, keys: Sequence[str] = ("url", "landed_url", "player_url")) -> DataFrame:
    """visits with the index of their outcome and whether they have one (-1 where not).

    The keys of a visit are tried in order; each meets an outcome by url or site_url. Of the first key that meets
    any, the last outcome counts. Empty keys are skipped, unmatched visits stay. visits: run, visit, keys...;
    outcomes: run, idx, url, site_url. The last outcome of each key is found before the join, so it meets a key once.
    """
    tiers = F.filter(F.transform(F.array(*keys), lambda key, tier: F.struct(tier.alias("tier"), key.alias("key"))), lambda x: x["key"] != "")
    asked = visits.select("run", "visit", F.inline(tiers))
    given = outcomes.select("run", "idx", F.explode(F.array_distinct(F.array("url", "site_url"))).alias("key")).where("key <> ''")
    given = given.groupBy("run", "key").agg(F.max("idx").alias("idx"))
    best = asked.join(given, ["run", "key"]).groupBy("run", "visit").agg(F.max(F.struct((-F.col("tier")).alias("order"), "idx")).getField("idx").alias("outcome"))
    return visits.join(best, ["run", "visit"], "left").withColumn("matched", F.col("outcome").isNotNull()).withColumn("outcome", F.coalesce("outcome", F.lit(-1)))


def url_entries(outcomes: DataFrame, matched: DataFrame) -> DataFrame:
    """One outcome for each url of a run: that of the latest visit with one, else the last. outcomes: run, idx, url; matched: run, visit, outcome."""
    visits = matched.where("outcome >= 0").groupBy("run", F.col("outcome").alias("idx")).agg(F.max("visit").alias("visit"))
    rows = outcomes.join(visits, ["run", "idx"], "left")
    order = F.struct(F.col("visit").isNotNull().alias("seen"), F.coalesce("visit", F.lit(-1)).alias("visit"), "idx")
    return rows.groupBy("run", "url").agg(F.max(order).alias("best")).select("run", "url", F.col("best.idx").alias("idx"), F.col("best.seen").alias("visited"))


def next_visible(steps: DataFrame, by: Sequence[str], order: str, target: str, visible: Column) -> DataFrame:
    """steps with the target of the next visible step."""
    # backwards, so that the frame only grows and is worked out once
    after = W.partitionBy(*by).orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, -1)
    return steps.withColumn("next_target", F.last(F.when(visible, F.col(target)), ignorenulls=True).over(after))


def paired(baseline: DataFrame, current: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, both values and how they compare: paired (changed or not), only_baseline, only_current."""
    old = baseline.select(*keys, F.col(value).alias("old"), F.lit(True).alias("in_old"))
    new = current.select(*keys, F.col(value).alias("new"), F.lit(True).alias("in_new"))
    state = F.when(F.col("in_old").isNull(), "only_current").when(F.col("in_new").isNull(), "only_baseline").when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("changed")
    return old.join(new, list(keys), "full").select(*keys, "old", "new", state.alias("state"))


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df, failing where a key comes twice."""
    twice = F.count(F.lit(1)).over(W.partitionBy(*keys)) > 1
    text = F.concat(F.lit("duplicate key: "), F.concat_ws(", ", *(F.col(k).cast("string") for k in keys)))
    return df.withColumn("_twice", F.when(twice, F.raise_error(text)).otherwise(F.lit(None).cast("string"))).where("_twice is null").drop("_twice")


def poolable(candidates: DataFrame, pool: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Candidates (task_id, url, branch) that are neither pooled nor on a quarantined url."""
    return candidates.join(pool, ["task_id", "url", "branch"], "left_anti").join(quarantined, "url", "left_anti")


def refusals(candidates: DataFrame, quarantined: DataFrame, succeeded: DataFrame, current: DataFrame) -> DataFrame:
    """Candidates with the first reason against them: quarantined, contradicted, stale_branch; null where none."""
    flags = [x.select(*keys).distinct().withColumn(name, F.lit(True)) for x, keys, name in ((quarantined, ["url"], "_q"), (succeeded, ["url"], "_s"), (current, ["url", "branch"], "_c"))]
    rows = candidates.join(flags[0], "url", "left").join(flags[1], "url", "left").join(flags[2], ["url", "branch"], "left")
    reason = F.when(F.col("_q"), "quarantined").when(F.col("_s"), "contradicted").when(F.col("_c").isNull(), "stale_branch")
    return rows.withColumn("refusal", reason).drop("_q", "_s", "_c")


def page_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (task, key, seq, value) of two corpora side by side, the last row of a key counting."""
    last = lambda df, name: df.groupBy("task", "key").agg(F.max_by("value", "seq").alias(name))
    side = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").otherwise("both")
    return last(a, "a").join(last(b, "b"), ["task", "key"], "full").withColumn("side", side)


def prefix_pairs(landings: DataFrame, anchors: DataFrame) -> DataFrame:
    """Pairs of (host, path) where one path begins with the other, character by character; the root, also written as an
    empty path, meets the root alone. Rows without a host or path meet none."""
    side = lambda df, first, asked: df.where("host IS NOT NULL AND path IS NOT NULL").select(F.col("host").alias("group"), "path", F.lit(first).cast("long").alias("first"), F.lit(asked).alias("asked"))
    met = prefix_meetings(side(landings, None, True).unionByName(side(anchors, 0, False)), pairs=True)
    return met.select(F.col("group").alias("host"), F.col("path").alias("landing"), "anchor")


def version_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """current (id, legacy_id, content) with how it relates to previous: by id, else by legacy ids of either."""
    by_id = previous.select("id", F.col("content").alias("p1"), F.lit(True).alias("h1"))
    old = previous.select(F.explode(F.array_distinct(F.array("id", "legacy_id"))).alias("legacy_id"), F.col("content").alias("p2")).where("legacy_id is not null")
    old = old.groupBy("legacy_id").agg(F.min("p2").alias("p2"), F.lit(True).alias("h2"))
    state = (
        F.when(F.col("h1"), F.when(F.col("p1").eqNullSafe(F.col("content")), "unchanged").otherwise("changed"))
        .when(F.col("h2"), F.when(F.col("p2").eqNullSafe(F.col("content")), "id_migrated").otherwise("changed"))
        .otherwise("new")
    )
    return current.join(by_id, "id", "left").join(old, "legacy_id", "left").select("id", "legacy_id", "content", state.alias("state"))


def era_of(rows: DataFrame, eras: DataFrame, day: str) -> DataFrame:
    """rows with the latest era that began by the day. eras (era, since) are a closed list of a few rows."""
    listed = [(r.since, r.era) for r in eras.orderBy("since").collect()]
    era = F.lit(None).cast("string")
    for since, name in listed:
        era = F.when(F.col(day) >= F.lit(since), F.lit(name)).otherwise(era)
    return rows.withColumn("era", era)
