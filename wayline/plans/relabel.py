"""Queries over changes of labels: lines of orders are outcomes, their parts urls, priorities tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import relabel
from wayline.plans.catalog import query
from wayline.session import table

TARGET, REASON, NON_SAMPLES = "region_locked", "checked by hand", ["unresolved"]
ORIGINS = {"region_locked": ["site", "player"], "paywall": ["player"], "blocked": ["site"], "trailer": ["cast"]}

_TABLES = """
outcomes AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS run, l_linenumber AS idx, o_orderpriority AS task_id, 'http://h/' || l_partkey AS url,
    CASE WHEN l_linestatus = 'F' AND l_quantity < 10 THEN NULL WHEN l_quantity < 20 THEN 'paywall' WHEN l_quantity < 30 THEN 'trailer' WHEN l_quantity < 36 THEN 'region_locked' WHEN l_quantity < 44 THEN 'blocked' ELSE 'unresolved' END AS branch,
    CASE WHEN l_discount > 0.09 THEN 'cast' WHEN l_returnflag = 'A' THEN 'site' WHEN l_returnflag = 'N' THEN 'player' ELSE '' END AS question, 'line ' || l_linenumber AS evidence
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
pool AS (SELECT task_id, url, branch, '' AS question, 'pooled' AS evidence FROM outcomes WHERE branch IS NOT NULL AND branch <> 'unresolved' AND idx > 2 GROUP BY task_id, url, branch),
every AS (SELECT task_id, url, branch, question, run, idx, false AS pooled FROM outcomes UNION ALL SELECT task_id, url, branch, question, NULL, NULL, true FROM pool),
found AS (
  SELECT task_id, url, branch, list_sort(list_distinct(array_agg(question) FILTER (question <> ''))) AS questions, count(*) FILTER (NOT pooled) AS n_outcomes, bool_or(pooled) AS in_pool
  FROM every WHERE branch IS NOT NULL AND branch <> 'unresolved' GROUP BY task_id, url, branch),
judged AS (
  SELECT *, CASE WHEN branch = 'region_locked' THEN 'skipped' WHEN coalesce(len(questions), 0) > 0 AND 'cast' IN questions THEN 'rejected' WHEN coalesce(len(questions), 0) = 0 AND branch = 'trailer' THEN 'rejected' ELSE 'eligible' END AS first
  FROM found WHERE branch <> 'blocked'),
placed AS (SELECT *, row_number() OVER (PARTITION BY task_id, url, first ORDER BY branch) AS place,
    EXISTS (SELECT 1 FROM pool p WHERE p.task_id = j.task_id AND p.url = j.url AND p.branch = 'region_locked') AS taken FROM judged j),
plan AS (SELECT *, CASE WHEN first = 'eligible' THEN CASE WHEN taken OR place > 1 THEN 'merged' ELSE 'accepted' END ELSE first END AS state,
    CASE first WHEN 'skipped' THEN 'has this branch' WHEN 'rejected' THEN 'belongs to other questions' ELSE CASE WHEN taken THEN 'the pool has the new key' WHEN place > 1 THEN 'another takes the new key' END END AS why FROM placed),
touched AS (SELECT task_id, url, branch, state FROM plan WHERE state IN ('accepted', 'merged'))"""


def _tables(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("task_id"))
    q = F.col("l_quantity")
    branch = F.when((F.col("l_linestatus") == "F") & (q < 10), None).when(q < 20, "paywall").when(q < 30, "trailer").when(q < 36, "region_locked").when(q < 44, "blocked").otherwise("unresolved")
    question = F.when(F.col("l_discount") > 0.09, "cast").when(F.col("l_returnflag") == "A", "site").when(F.col("l_returnflag") == "N", "player").otherwise("")
    outcomes = table(spark, sf_dir, "lineitem").join(orders, "l_orderkey").select(
        F.col("l_orderkey").cast("string").alias("run"),
        F.col("l_linenumber").cast("int").alias("idx"),
        "task_id",
        F.concat(F.lit("http://h/"), "l_partkey").alias("url"),
        branch.alias("branch"),
        question.alias("question"),
        F.concat(F.lit("line "), "l_linenumber").alias("evidence"),
        F.lit("rule").alias("source"),
    )
    pooled = outcomes.where("branch IS NOT NULL AND branch <> 'unresolved' AND idx > 2").select(*relabel.KEY).distinct()
    return outcomes, pooled.select("*", F.lit("").alias("question"), F.lit("pooled").alias("evidence"), F.lit("rule").alias("source"))


def _plan(outcomes, pool):
    found = relabel.candidates(outcomes, pool, NON_SAMPLES)
    return relabel.relabel_plan(found, TARGET, REASON, ORIGINS, NON_SAMPLES, F.col("branch") != "blocked")


@query(f"WITH {_TABLES} SELECT task_id, url, branch, coalesce(array_to_string(questions, ','), '') AS questions, n_outcomes, in_pool, state, why FROM plan")
def q32_relabel_plan(spark, sf_dir):
    """What a change of all labels but one to another does with each key of the pool."""
    plan = _plan(*_tables(spark, sf_dir))
    return plan.select(*relabel.KEY, F.array_join("questions", ",").alias("questions"), "n_outcomes", "in_pool", "state", "why")


@query(f"""WITH {_TABLES}
SELECT p.task_id, p.url, CASE WHEN t.state IS NULL THEN p.branch ELSE '{TARGET}' END AS branch, CASE WHEN t.state IS NULL THEN 'pooled' ELSE 'pooled' || chr(10) || chr(10) || '{relabel.MARK}' || p.branch || ' → {TARGET}] {REASON}' END AS evidence
FROM pool p LEFT JOIN touched t ON t.task_id = p.task_id AND t.url = p.url AND t.branch = p.branch WHERE t.state IS NULL OR t.state = 'accepted'
""")
def q32_relabelled_pool(spark, sf_dir):
    outcomes, pool = _tables(spark, sf_dir)
    return relabel.relabelled_pool(pool, _plan(outcomes, pool), TARGET, REASON).select(*relabel.KEY, "evidence")


@query(f"""WITH {_TABLES}
SELECT run, branch, count(*) AS n FROM (
  SELECT o.run, CASE WHEN t.state IS NULL THEN o.branch ELSE '{TARGET}' END AS branch FROM outcomes o LEFT JOIN touched t ON t.task_id = o.task_id AND t.url = o.url AND t.branch = o.branch)
WHERE branch IS NOT NULL GROUP BY run, branch
""")
def q32_ledger(spark, sf_dir):
    """The ledgers of all runs after the change."""
    outcomes, pool = _tables(spark, sf_dir)
    return relabel.ledger(relabel.relabelled_outcomes(outcomes, _plan(outcomes, pool), TARGET, REASON))


@query("""
WITH picked AS (SELECT CAST(o_orderkey AS VARCHAR) AS run FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3),
lines AS (SELECT CAST(l_orderkey AS VARCHAR) AS run, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT run, 1 AS archives, coalesce(n, 0) AS pool_rows FROM picked LEFT JOIN lines USING (run)
""")
def q35_purge(spark, sf_dir):
    """What goes with the three dearest orders: their archives and their lines in the pool."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("run"), "o_totalprice", "o_orderkey")
    pool = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("run"))
    runs = [r.run for r in orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(3).collect()]
    return relabel.purge(orders, pool, runs)[2]
