"""Queries that audit runs: asserts, tallies, worklists, arbitration, conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import audit
from wayline.plans.catalog import query
from wayline.session import table

_ASSERTS = """a AS (SELECT user_id, 'signup_is_small' AS clause, count(*) FILTER (event_type = 'signup') AS tested, count(*) FILTER (event_type = 'signup' AND NOT value < 60) AS failed FROM events GROUP BY user_id
  UNION ALL SELECT user_id, 'errors_are_rare', count(*) FILTER (event_type = 'error'), count(*) FILTER (event_type = 'error' AND NOT value < 150) FROM events GROUP BY user_id),
s AS (SELECT *, CASE WHEN tested = 0 THEN 'untestable' WHEN failed > 0 THEN 'failed' ELSE 'passed' END AS state FROM a)"""


def _asserts(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value")
    clauses = {"signup_is_small": (kind == "signup", value < 60), "errors_are_rare": (kind == "error", value < 150)}
    return audit.run_asserts(table(spark, sf_dir, "events"), ["user_id"], clauses)


@query(f"WITH {_ASSERTS} SELECT * FROM s")
def a29_run_asserts(spark, sf_dir):
    return _asserts(spark, sf_dir)


@query(f"""WITH {_ASSERTS} SELECT clause, count(*) FILTER (state = 'passed') AS passed, count(*) FILTER (state = 'failed') AS failed, count(*) FILTER (state = 'untestable') AS untestable,
  count(*) FILTER (state = 'passed') / nullif(count(*) FILTER (state <> 'untestable'), 0) AS share FROM s GROUP BY clause""")
def a34_assert_summary(spark, sf_dir):
    return audit.assert_summary(_asserts(spark, sf_dir))


@query("""
WITH e AS (SELECT source, quality AS gold, CASE WHEN doc_id % 6 > 0 THEN CAST((doc_id // 3) % 2 AS INTEGER) END AS pred FROM documents JOIN labels USING (doc_id))
SELECT source, count(pred) AS n, count(*) FILTER (gold <> pred) AS disagree, count(*) FILTER (gold <> pred) / count(pred) AS rate, count(pred) >= 20 AND count(*) FILTER (gold <> pred) / count(pred) > 0.4 AS over
FROM e GROUP BY source HAVING count(pred) > 0
""")
def a15_disagreement_rate(spark, sf_dir):
    pred = F.when(F.col("doc_id") % 6 > 0, F.floor(F.col("doc_id") / 3) % 2).cast("int")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    return audit.disagreement_rate(rows, ["source"], F.col("quality"), pred, 0.4)


@query("""
WITH r AS (SELECT event_type AS label, CASE WHEN event_id % 3 = 0 THEN 'click' WHEN event_id % 3 = 1 THEN 'purchase' END AS branch FROM events),
c AS (SELECT *, CASE label WHEN 'click' THEN 'use' WHEN 'view' THEN 'use' WHEN 'purchase' THEN 'pay' END AS a, CASE coalesce(branch, 'success') WHEN 'click' THEN 'use' WHEN 'purchase' THEN 'pay' END AS b FROM r)
SELECT count(*) AS n, count(*) FILTER (a IS NOT NULL AND (label = coalesce(branch, 'success') OR coalesce(a = b, false))) AS agree, count(*) FILTER (a IS NULL) AS unregistered,
  coalesce(count(*) FILTER (a IS NOT NULL AND (label = coalesce(branch, 'success') OR coalesce(a = b, false))) / nullif(count(*), 0), 0) AS agreement FROM c
""")
def a47_trajectory_agreement(spark, sf_dir):
    branch = F.when(F.col("event_id") % 3 == 0, "click").when(F.col("event_id") % 3 == 1, "purchase")
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("label"), branch.alias("branch"))
    return audit.trajectory_agreement(rows, {"click": "use", "view": "use", "purchase": "pay"}, "label", "branch")


@query("SELECT doc_id, CASE WHEN (n_chars > 2000)::INT + (lang = 'de' OR lang = 'fr')::INT = 1 THEN CASE WHEN n_chars > 2000 THEN 'long' ELSE 'foreign' END ELSE '-' END AS suggestion, true AS needs_human FROM documents")
def q24_prefill(spark, sf_dir):
    rules = [("long", F.col("n_chars") > 2000), ("foreign", F.col("lang") == "de"), ("foreign", F.col("lang") == "fr")]
    return audit.prefilled(table(spark, sf_dir, "documents"), "doc_id", rules).na.fill("-", ["suggestion"])


@query("""
WITH t AS (SELECT user_id AS k, event_type AS bucket, CASE WHEN event_id % 500 = 0 THEN ' ' ELSE 'me' END AS by_whom FROM events)
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(blank) AS BIGINT) AS blank, count(*) FILTER (answers > 1) AS conflicts, sum(blank) = 0 AND count(*) FILTER (answers > 1) = 0 AS admitted
FROM (SELECT k, count(*) AS n, count(*) FILTER (trim(by_whom) = '' OR trim(bucket) = '') AS blank, count(DISTINCT (bucket, by_whom)) AS answers FROM t GROUP BY k)
""")
def q25_triage(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("bucket"), F.when(F.col("event_id") % 500 == 0, " ").otherwise("me").alias("by_whom"))
    return audit.admitted_triage(rows, ["k"], ["bucket", "by_whom"])


@query("""
WITH e AS (SELECT user_id, 'L' || (event_id % 4 + 1) AS level, event_type AS branch, least(1.0, value / 100) AS confidence FROM events),
b AS (SELECT user_id, branch, sum(CASE level WHEN 'L1' THEN 0.4 WHEN 'L2' THEN 0.3 WHEN 'L3' THEN 0.2 ELSE 0.1 END * confidence) AS score, count(DISTINCT level) AS levels, bool_or(level = 'L4' AND confidence > 2) AS sure FROM e GROUP BY 1, 2)
SELECT user_id, branch, score, levels >= 2 OR sure AS agreed FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sure DESC, round(score, 9) DESC, branch) AS rn FROM b) WHERE rn = 1
""")
def q30_arbitration(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.concat(F.lit("L"), (F.col("event_id") % 4 + 1).cast("string")).alias("level"), F.col("event_type").alias("branch"), F.least(F.lit(1.0), F.col("value") / 100).alias("confidence"))
    return audit.arbitrated(rows, "user_id", {"L1": 0.4, "L2": 0.3, "L3": 0.2, "L4": 0.1}, "played")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'reject' WHEN value < 10 AND event_id % 6 <= 2 THEN 'resample' WHEN value < 10 THEN 'reject' ELSE 'accept' END AS verdict FROM events")
def q45_quality_verdict(spark, sf_dir):
    verdict = audit.quality_verdict(F.col("event_type") == "error", F.col("value") < 10, F.col("event_id") % 6)
    return table(spark, sf_dir, "events").select("event_id", verdict.alias("verdict"))


@query("""
WITH i AS (SELECT 'g' || event_id AS golden_id, user_id AS key, event_id AS seq FROM events WHERE event_id % 10 = 0), f AS (SELECT key, arg_min(golden_id, seq) AS first FROM i GROUP BY key),
j AS (SELECT event_id AS row, CASE WHEN event_id % 4 = 0 THEN 'g' || event_id END AS golden_id, user_id AS key, event_type AS dimension, CASE WHEN value > 3 THEN value END AS score FROM events),
r AS (SELECT j.row, coalesce(j.golden_id, first) AS golden_id, dimension, score FROM j LEFT JOIN f USING (key))
SELECT row, coalesce(golden_id, '-') AS golden_id, CASE WHEN dimension = 'view' THEN 'skipped' WHEN golden_id IS NULL OR golden_id NOT IN (SELECT golden_id FROM i) THEN 'unmatched' WHEN score IS NULL THEN 'no_score' ELSE 'taken' END AS state FROM r
""")
def j11_converted(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    name = F.concat(F.lit("g"), F.col("event_id").cast("string"))
    index = rows.where("event_id % 10 = 0").select(name.alias("golden_id"), F.col("user_id").alias("key"), F.col("event_id").alias("seq"))
    judged = rows.select(F.col("event_id").alias("row"), F.when(F.col("event_id") % 4 == 0, name).alias("golden_id"), F.col("user_id").alias("key"), F.col("event_type").alias("dimension"), F.when(F.col("value") > 3, F.col("value")).alias("score"))
    return audit.converted(judged, index, ["view"]).na.fill("-", ["golden_id"])


@query("""
SELECT event_id AS id, event_type AS tool, CASE WHEN event_type = 'error' THEN 'unknown_tool' WHEN event_id % 9 = 0 THEN 'bad_json' WHEN event_type = 'view' AND len(list_filter(json_keys(props), lambda k: k <> 'x')) > 0 THEN 'extra_arguments' ELSE '-' END AS problem FROM events
""")
def h15_undeclared_calls(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    calls = rows.select(F.col("event_id").alias("id"), F.col("event_type").alias("tool"), F.when(F.col("event_id") % 9 == 0, "{").otherwise(F.col("props")).alias("arguments"))
    every = F.map_keys(F.from_json("props", "map<string,string>"))
    tools = rows.where("event_type <> 'error'").select(F.col("event_type").alias("tool"), F.explode(every).alias("name")).groupBy("tool").agg(F.collect_set("name").alias("names"))
    tools = tools.withColumn("names", F.when(F.col("tool") == "view", F.array(F.lit("x"))).otherwise(F.col("names")))
    return audit.undeclared_calls(calls, tools).na.fill("-", ["problem"])


@query("""
SELECT coalesce(event_type, '*') AS dimension, coalesce(tier, -1) AS tier, count(*) AS n, count(*) FILTER (veto) AS vetoes FROM (SELECT event_type, CAST(event_id % 5 + 1 AS INTEGER) AS tier, event_id % 5 = 0 AS veto FROM events)
GROUP BY GROUPING SETS ((event_type, tier), (event_type), ())
""")
def a24_tally(spark, sf_dir):
    """Scores by dimension, and over all."""
    tier = (F.col("event_id") % 5 + 1).cast("int")
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("dimension"), tier.alias("tier"))
    out = rows.groupingSets([["dimension", "tier"], ["dimension"], []], "dimension", "tier").agg(F.count("*").alias("n"), F.count(F.when(F.col("tier") == 1, 1)).alias("vetoes"))
    return out.select(F.coalesce("dimension", F.lit("*")).alias("dimension"), F.coalesce("tier", F.lit(-1)).alias("tier"), "n", "vetoes")


@query("SELECT CASE WHEN n_chars < 200 THEN 'short' WHEN n_chars < 2000 THEN 'middle' ELSE 'long' END AS tier, count(*) AS n FROM documents GROUP BY 1")
def a40_tiers(spark, sf_dir):
    tier = F.when(F.col("n_chars") < 200, "short").when(F.col("n_chars") < 2000, "middle").otherwise("long")
    return table(spark, sf_dir, "documents").groupBy(tier.alias("tier")).agg(F.count("*").alias("n"))


@query("SELECT user_id, bool_and(value < 180) FILTER (event_type <> 'view') AS passed, count(*) FILTER (event_type <> 'view' AND NOT value < 180) AS missed FROM events GROUP BY user_id")
def a45_required(spark, sf_dir):
    """Verdicts on required criteria merged by run; the others do not count."""
    required, met = F.col("event_type") != "view", F.col("value") < 180
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.bool_and(F.when(required, met)).alias("passed"), F.count(F.when(required & ~met, 1)).alias("missed"))
