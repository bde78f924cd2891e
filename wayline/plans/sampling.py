"""Queries that sample, split and select."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.functions import arrays
from wayline.operators import selection
from wayline.plans.catalog import query
from wayline.session import table

_ORDER = "sha256('{seed}' || chr(1) || {key})"


@query("""
SELECT event_id, event_type, population, population / least(population, 7) AS weight FROM (
  SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS population, row_number() OVER (PARTITION BY event_type ORDER BY sha256('s1' || chr(1) || event_id), event_id) AS rn FROM events) WHERE rn <= 7
""")
def t5_draw(spark, sf_dir):
    """Seven events of each type in hash order, with weights."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return selection.draw(rows, ["event_type"], 7, "s1", ["event_id"])


@query("""
SELECT doc_id, CASE WHEN rn <= round_even(n * 0.6, 0) THEN 'calibration' ELSE 'holdout' END AS split FROM (
  SELECT doc_id, count(*) OVER (PARTITION BY quality) AS n, row_number() OVER (PARTITION BY quality ORDER BY sha256('seed' || chr(1) || doc_id), doc_id) AS rn FROM labels)
""")
def x1_split(spark, sf_dir):
    return selection.split_by_ratio(table(spark, sf_dir, "labels"), "quality", 0.6, "seed", ["doc_id"]).select("doc_id", "split")


@query("""
WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), f AS (SELECT *, CAST(floor(n * 97 / sum(n) OVER ()) AS BIGINT) AS q FROM c),
r AS (SELECT *, 97 - sum(q) OVER () AS rest, row_number() OVER (ORDER BY n DESC, source) AS rn FROM f)
SELECT source, n, CAST(q + CASE WHEN rn <= rest THEN 1 ELSE 0 END AS BIGINT) AS quota FROM r
""")
def x2_quotas(spark, sf_dir):
    return selection.proportional_quotas(table(spark, sf_dir, "documents"), "source", 97)


@query("""
WITH m AS (SELECT doc_id, [x for x in [CASE WHEN n_chars > 4000 THEN 'S1' END, CASE WHEN lang = 'de' THEN 'S3' END, CASE WHEN doc_id % 4 = 0 THEN 'S2' END, CASE WHEN n_chars > 0 THEN 'S0' END] if x IS NOT NULL] AS met FROM documents)
SELECT doc_id, met[1] AS stratum, array_to_string(met[2:], ',') AS also_in FROM m
""")
def x3_strata(spark, sf_dir):
    """The first stratum of each document, and the others it is in."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    strata = [("S1", F.col("n_chars") > 4000), ("S3", F.col("lang") == "de"), ("S2", F.col("doc_id") % 4 == 0), ("S0", F.col("n_chars") > 0)]
    return selection.assign_strata(rows, strata).select("doc_id", "stratum", F.array_join("also_in", ",").alias("also_in"))


@query("""
SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN lang = 'es' THEN 0 ELSE 1 END, n_chars DESC, doc_id) AS rn FROM documents) WHERE rn <= 3
""")
def t3_pinned_top(spark, sf_dir):
    """The three longest documents of each source, Spanish ones first."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return selection.pinned_top(rows, ["source"], F.col("lang") == "es", "n_chars", "doc_id", 3).select("doc_id", "source")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def t8_top_types(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type").limit(3)


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_id))[1:3], ',') AS shown, greatest(count(DISTINCT event_id) - 3, 0) AS hidden FROM events GROUP BY user_id")
def t6_trimmed(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(selection.trimmed(F.array_sort(F.collect_set("event_id")), 3).alias("t"))
    return rows.select("user_id", F.array_join(F.col("t.shown").cast("array<string>"), ",").alias("shown"), F.col("t.hidden").cast("long").alias("hidden"))


@query("SELECT event_type, user_id % 10 AS k FROM events WHERE value > 20 EXCEPT ALL SELECT event_type, user_id % 10 FROM events WHERE value > 90")
def u5_multiset_minus(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    pick = lambda test: rows.where(test).select("event_type", (F.col("user_id") % 10).alias("k"))
    return selection.multiset_minus(pick("value > 20"), pick("value > 90"))


_SPLITS = "list_sort(list(DISTINCT CASE WHEN event_id % 10 < 6 THEN 'calibration' WHEN event_id % 10 < 8 THEN 'regression' ELSE 'holdout' END))"


@query(f"""
SELECT user_id, CASE WHEN list_contains(s, 'holdout') THEN 'holdout' WHEN list_contains(s, 'regression') THEN 'regression' ELSE 'calibration' END AS split,
  len([x for x in s if x NOT IN ('calibration', 'regression')]) = 0 AS open FROM (SELECT user_id, {_SPLITS} AS s FROM events GROUP BY user_id)
""")
def h21_strict_split(spark, sf_dir):
    last = F.col("event_id") % 10
    split = F.when(last < 6, "calibration").when(last < 8, "regression").otherwise("holdout")
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set(split).alias("splits"))
    return rows.select("user_id", arrays.strict_split(F.col("splits")).alias("split"), arrays.splits_within(F.col("splits"), ["calibration", "regression"]).alias("open"))
