"""Queries of agreement and distribution: labels are gold, a rule over texts predicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import metrics
from wayline.plans.catalog import query
from wayline.session import table


def _judged(spark, sf_dir):
    """Gold quality and toxicity with a prediction from the text's length, null for a sixth of the rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    predicted = F.when(F.col("doc_id") % 6 == 0, None).when(F.col("n_chars") > 900, 1).otherwise(0)
    rows = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    return rows.withColumns({"predicted": predicted, "a": (F.col("doc_id") % 5 + 1).cast("int"), "b": ((F.col("doc_id") * 7 + F.col("quality")) % 6).cast("int")})


_J = """judged AS (SELECT doc_id, lang, source, n_chars, quality, toxic, CASE WHEN doc_id % 6 = 0 THEN NULL WHEN n_chars > 900 THEN 1 ELSE 0 END AS predicted,
  CAST(doc_id % 5 + 1 AS INTEGER) AS a, CAST((doc_id * 7 + quality) % 6 AS INTEGER) AS b FROM documents JOIN labels USING (doc_id))"""


@query("SELECT event_type AS branch, count(*) AS n FROM events WHERE event_type <> 'purchase' GROUP BY 1")
def a1_branches(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.nullif("event_type", F.lit("purchase")).alias("branch"))
    return metrics.histogram(rows, "branch")


@query("""
SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'purchase') AS succeeded, count(*) FILTER (event_type <> 'purchase' AND value > 50) AS negatives,
  array_to_string(list_sort([x for x in ['click', 'error', 'refund', 'view'] if NOT list_contains(list(DISTINCT event_type), x)]), ',') AS missing FROM events GROUP BY user_id
""")
def a2_ledgers(spark, sf_dir):
    """Per run: totals and which registered branches it lacks."""
    missing = F.array_except(F.array(*map(F.lit, ("click", "error", "refund", "view"))), F.collect_set("event_type"))
    failed = F.col("event_type") != "purchase"
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count("*").alias("total"), F.count(F.when(~failed, 1)).alias("succeeded"), F.count(F.when(failed & (F.col("value") > 50), 1)).alias("negatives"), F.array_join(F.array_sort(missing), ",").alias("missing")
    )


@query("""
SELECT source, count(*) AS visited, count(*) FILTER (n_chars > 3000) AS success, count(*) FILTER (n_chars < 200) AS blocked FROM documents GROUP BY source
HAVING count(*) >= 2 AND count(*) > count(*) FILTER (n_chars < 200) AND count(*) FILTER (n_chars > 20000) = 0
""")
def a4_reach(spark, sf_dir):
    """Sources that were visited in vain."""
    n = F.col("n_chars")
    rows = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("visited"), F.count(F.when(n > 3000, 1)).alias("success"), F.count(F.when(n < 200, 1)).alias("blocked"), F.count(F.when(n > 20000, 1)).alias("won"))
    return rows.where("visited >= 2 and visited > blocked and won = 0").drop("won")


@query("SELECT source, median(n_chars) AS median, count(*) AS n FROM documents GROUP BY GROUPING SETS ((source), ())")
def a6_medians(spark, sf_dir):
    return metrics.medians(table(spark, sf_dir, "documents").select("source", "n_chars"), "n_chars", "source")


_KAPPA = """cells AS (SELECT lang, quality AS x, predicted AS y, count(*) AS n FROM judged WHERE predicted IS NOT NULL GROUP BY ALL),
t AS (SELECT lang, sum(n) AS n, sum(CASE WHEN x = y THEN n ELSE 0 END) AS same FROM cells GROUP BY lang),
sides AS (SELECT lang, label, sum(na) AS na, sum(nb) AS nb FROM (SELECT lang, x AS label, n AS na, 0 AS nb FROM cells UNION ALL SELECT lang, y, 0, n FROM cells) GROUP BY 1, 2),
c AS (SELECT lang, count(*) AS labels, CAST(sum(na * nb) AS DOUBLE) AS both_ FROM sides GROUP BY lang)"""


@query(f"""WITH {_J}, {_KAPPA}
SELECT lang, CAST(n AS BIGINT) AS n, CAST(same AS BIGINT) AS same, CASE WHEN labels >= 2 AND both_ / (n * n) < 1 THEN (CAST(same AS DOUBLE) / n - both_ / (n * n)) / (1 - both_ / (n * n)) END AS kappa FROM t JOIN c USING (lang)
""")
def a9_kappa(spark, sf_dir):
    return metrics.cohen_kappa(_judged(spark, sf_dir), "quality", "predicted", ["lang"])


@query(f"""WITH {_J}, r AS (SELECT a, b FROM judged WHERE b BETWEEN 1 AND 5), o AS (SELECT count(*) AS n, avg(1 - abs(a - b) / 4.0) AS po FROM r),
e AS (SELECT sum(1 - abs(x.a - y.b) / 4.0) AS s FROM r x CROSS JOIN r y)
SELECT n, (po - s / (n * n)) / (1 - s / (n * n)) AS kappa FROM o, e
""")
def a10_weighted_kappa(spark, sf_dir):
    return metrics.weighted_kappa(_judged(spark, sf_dir).where("b between 1 and 5"), "a", "b", 1, 5)


@query(f"""WITH {_J}, r AS (SELECT source AS t, 'src' || (doc_id % 7) AS p FROM judged), l AS (SELECT t AS label FROM r UNION SELECT p FROM r),
s AS (SELECT label, (SELECT count(*) FROM r WHERE t = label AND p = label) AS tp, (SELECT count(*) FROM r WHERE t <> label AND p = label) AS fp, (SELECT count(*) FROM r WHERE t = label AND p <> label) AS fn FROM l),
q AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall FROM s)
SELECT label, tp, fp, fn, precision, recall, CASE WHEN coalesce(precision, 0) = 0 THEN CASE WHEN precision IS NULL OR recall > 0 THEN coalesce(recall, precision) ELSE precision END
  WHEN coalesce(recall, 0) = 0 THEN precision ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM q
""")
def a11_report(spark, sf_dir):
    rows = _judged(spark, sf_dir).select(F.col("source").alias("t"), F.concat(F.lit("src"), (F.col("doc_id") % 7).cast("string")).alias("p"))
    return metrics.classification_report(rows, "t", "p")


@query(f"""WITH {_J}, s AS (SELECT lang, CASE WHEN predicted IS NULL THEN 'u' WHEN predicted = quality THEN 'a' ELSE 'd' END AS st FROM judged),
c AS (SELECT lang, count(*) AS n, count(*) FILTER (st = 'a') AS agree, count(*) FILTER (st = 'd') AS disagree, count(*) FILTER (st = 'u') AS undetermined FROM s GROUP BY lang)
SELECT *, CASE WHEN agree + disagree > 0 THEN agree / (agree + disagree) END AS agreement, undetermined / n AS abstention FROM c
""")
def a12_three_state(spark, sf_dir):
    return metrics.three_state(_judged(spark, sf_dir), ["lang"], F.col("quality"), F.col("predicted"), F.col("predicted").isNull())


@query(f"""WITH {_J} SELECT lang, count(*) FILTER (b BETWEEN 1 AND 5) AS n, count(*) FILTER (b BETWEEN 1 AND 5 AND abs(a - b) <= 1) AS near, count(*) FILTER (b NOT BETWEEN 1 AND 5) AS skipped,
  count(*) FILTER (b BETWEEN 1 AND 5 AND abs(a - b) <= 1) / count(*) FILTER (b BETWEEN 1 AND 5) AS agreement FROM judged GROUP BY lang
""")
def a13_tolerance(spark, sf_dir):
    return metrics.within_tolerance(_judged(spark, sf_dir), ["lang"], "a", "b", 1)


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS c FROM events GROUP BY 1, 2)
SELECT user_id, arg_max(event_type, (c, -ascii(event_type))) AS mode, max(c) / sum(c) AS share, CAST(sum(c) AS BIGINT) AS n, count(*) AS distinct_values FROM c GROUP BY user_id
""")
def a18_mode(spark, sf_dir):
    return metrics.mode(table(spark, sf_dir, "events"), ["user_id"], "event_type")


@query("SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY GROUPING SETS ((lang), (source), (lang, source), ())")
def a19_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.groupingSets([["lang"], ["source"], ["lang", "source"], []], "lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


_URLS = """r AS (SELECT 'u' || (user_id * 7 + event_id % 3) AS url, event_type AS label, CASE WHEN event_id % 10 < 6 THEN 'calibration' WHEN event_id % 10 < 8 THEN 'regression' ELSE 'holdout' END AS split FROM events)"""


def _split_rows(spark, sf_dir):
    last = F.col("event_id") % 10
    split = F.when(last < 6, "calibration").when(last < 8, "regression").otherwise("holdout")
    url = F.concat(F.lit("u"), (F.col("user_id") * 7 + F.col("event_id") % 3).cast("string"))
    return table(spark, sf_dir, "events").select(url.alias("url"), F.col("event_type").alias("label"), split.alias("split"))


@query(f"""WITH {_URLS}, c AS (SELECT url, label, count(*) AS n FROM r GROUP BY 1, 2),
l AS (SELECT url, string_agg(label || ':' || n, ',' ORDER BY n DESC, label) AS labels FROM c GROUP BY url HAVING count(*) > 1), s AS (SELECT url, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM r GROUP BY url)
SELECT url, labels, splits FROM l JOIN s USING (url)
""")
def a26_label_conflicts(spark, sf_dir):
    return metrics.label_conflicts(_split_rows(spark, sf_dir), "url", "label", "split")


@query(f"""WITH {_URLS}, u AS (SELECT url, count(DISTINCT split) AS k, count(*) FILTER (split = 'holdout') AS held FROM r GROUP BY url)
SELECT count(*) FILTER (k > 1) AS leaking_urls, CAST(sum(CASE WHEN k > 1 THEN held ELSE 0 END) AS BIGINT) AS leaking_rows, CAST(sum(held) AS BIGINT) AS held_rows, sum(CASE WHEN k > 1 THEN held ELSE 0 END) / sum(held) AS leakage FROM u
""")
def a27_leakage(spark, sf_dir):
    return metrics.split_leakage(_split_rows(spark, sf_dir), "url", "split", "holdout")


@query(f"""WITH {_J}, m AS (SELECT source, bool_or(predicted IS NULL AND doc_id % 12 = 0) AS n, arg_min(a, doc_id) FILTER (doc_id % 11 = 0) AS v, min(a) AS lo, count(*) FILTER (doc_id % 11 = 0) AS k FROM judged GROUP BY source)
SELECT source, CASE WHEN n THEN -1 WHEN k > 0 THEN v ELSE lo END AS score, k > 0 AS vetoed FROM m
""")
def a21_merged_scores(spark, sf_dir):
    rows = _judged(spark, sf_dir).withColumns({"score": F.when(F.col("doc_id") % 12 == 0, None).otherwise(F.col("a")), "veto": F.col("doc_id") % 11 == 0})
    return metrics.merged_scores(rows, ["source"], "score", "veto", "doc_id").withColumn("score", F.coalesce("score", F.lit(-1)))


@query("""
WITH d AS (SELECT unnest(['click', 'view', 'unknown', 'purchase']) AS event_type) SELECT event_type, coalesce(n, 0) AS n FROM d LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) USING (event_type)
""")
def a36_coverage(spark, sf_dir):
    domain = spark.createDataFrame([(x,) for x in ("click", "view", "unknown", "purchase")], "event_type string")
    return metrics.coverage(table(spark, sf_dir, "events"), domain, "event_type")


@query("""
WITH c AS (SELECT source, avg(n_chars) AS score FROM documents WHERE doc_id % 2 = 0 GROUP BY 1), b AS (SELECT source, avg(n_chars) AS base FROM documents WHERE doc_id % 2 = 1 AND source <> 'src3' GROUP BY 1)
SELECT source, score, coalesce(base, -1) AS base, abs(score - coalesce(base, score)) AS off, abs(score - coalesce(base, score)) > 300 AS drifted FROM c LEFT JOIN b USING (source)
""")
def a42_drift(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    now = docs.where("doc_id % 2 = 0").groupBy("source").agg(F.avg("n_chars").alias("score"))
    base = docs.where("doc_id % 2 = 1 and source <> 'src3'").groupBy("source").agg(F.avg("n_chars").alias("score"))
    return metrics.drift(now, base, ["source"], 300).withColumn("base", F.coalesce("base", F.lit(-1.0)))
