"""Queries over conclusions: a turn is the page of a visit, the turn before the page that was clicked on."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.operators import conclusions
from wayline.plans.catalog import query
from wayline.session import table

TEXTS = {"no_gate": "shows no gate", "same_page": "led nowhere"}
CLASSES = {"success": "open", "trailer": "shut", "paywall": "shut", "blocked": "barred", "unresolved": "nothing"}


@query("""
WITH t AS (SELECT conv_id, turn, role, text, length(text) AS n, lag(role) OVER o AS role1, lag(length(text)) OVER o AS n1, lag(turn) OVER o IS NOT NULL AS has1 FROM conversations WINDOW o AS (PARTITION BY conv_id ORDER BY turn)),
b AS (SELECT *, CASE n % 3 WHEN 0 THEN 'subscription_wall' WHEN 1 THEN 'component_unverified' END AS branch FROM t),
w AS (SELECT *, CASE WHEN branch = 'subscription_wall' AND NOT contains(text, 'ation') AND NOT (role = 'user' AND turn = 0) THEN 'no_gate'
    WHEN branch = 'component_unverified' AND has1 AND role1 = role AND n1 // 200 = n // 200 THEN 'same_page' ELSE '' END AS why FROM b)
SELECT conv_id, turn, CASE WHEN why = '' THEN branch ELSE 'unresolved' END AS branch, CASE WHEN why <> '' THEN branch END AS branch_before_guard,
  CASE why WHEN 'no_gate' THEN '[subscription_wall] shows no gate' WHEN 'same_page' THEN '[component_unverified] led nowhere' END AS evidence FROM w
""")
def p25_guarded_branches(spark, sf_dir):
    """Branches that cannot be: walls of pages without a gate, and clicks that led to the same page."""
    page = F.struct(F.col("role").alias("url"), F.lit("").alias("body"), F.floor(F.length("text") / 200).cast("int").alias("elements"))
    turn = W.partitionBy("conv_id").orderBy("turn")
    n = F.length("text") % 3
    rows = table(spark, sf_dir, "conversations").withColumn("before", F.lag(page).over(turn))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(n == 0, "subscription_wall").when(n == 1, "component_unverified").alias("branch"),
        F.lit(None).cast("string").alias("evidence"),
        page.withField("body", F.when(n == 0, F.col("text")).otherwise("")).alias("page"),
        "before",
        F.when((F.col("role") == "user") & (F.col("turn") == 0), F.array(F.lit("a quoted"), F.lit("gate of nation"))).alias("quotes"),
    )
    told = conclusions.guarded(rows, lambda t: F.contains(t, F.lit("ation")), TEXTS)
    return told.select("conv_id", "turn", "branch", "branch_before_guard", "evidence")


_LABELLED = """
WITH rows AS (
  SELECT source, CASE WHEN quality = 1 THEN 'success' WHEN toxic = 1 THEN 'blocked' WHEN n_chars < 400 THEN 'unresolved' WHEN n_chars < 450 AND lang = 'fr' THEN 'novel' ELSE 'trailer' END AS label,
    CASE WHEN n_chars % 5 = 0 THEN NULL WHEN n_chars % 5 < 3 THEN 'paywall' WHEN n_chars % 5 = 3 THEN 'blocked' ELSE 'unresolved' END AS branch
  FROM documents d JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id)"""


@query(f"""{_LABELLED},
told AS (
  SELECT label, coalesce(branch, 'success') AS branch, CASE label WHEN 'success' THEN 'open' WHEN 'trailer' THEN 'shut' WHEN 'blocked' THEN 'barred' END AS gold,
    CASE coalesce(branch, 'success') WHEN 'success' THEN 'open' WHEN 'paywall' THEN 'shut' WHEN 'blocked' THEN 'barred' END AS pred FROM rows WHERE label <> 'novel')
SELECT 'readout' AS state, count(*) FILTER (gold = pred) AS agree, count(*) FILTER (gold <> pred) AS disagree, count(*) FILTER (gold IS NULL OR pred IS NULL) AS undetermined,
  count(*) FILTER (gold <> pred) / count(*) FILTER (gold IS NOT NULL AND pred IS NOT NULL) AS rate, '' AS unregistered FROM told
""")
def a33_conclusion_errors(spark, sf_dir):
    """How often a conclusion is wrong, of labelled documents."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    n = F.col("n_chars")
    rows = table(spark, sf_dir, "documents").join(labels, "doc_id").select(
        F.when(F.col("quality") == 1, "success").when(F.col("toxic") == 1, "blocked").when(n < 400, "unresolved").when((n < 450) & (F.col("lang") == "fr"), "novel").otherwise("trailer").alias("label"),
        F.when(n % 5 == 0, None).when(n % 5 < 3, "paywall").when(n % 5 == 3, "blocked").otherwise("unresolved").alias("branch"),
    )
    told = conclusions.conclusion_errors(rows.where("label <> 'novel'"), CLASSES, ["nothing"])
    return told.withColumn("unregistered", F.array_join("unregistered", ","))
