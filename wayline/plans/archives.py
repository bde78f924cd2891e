"""Queries over whole run archives. Orders are runs, written as JSON: their lines are visits and outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import integrity
from wayline.plans.catalog import query
from wayline.session import table

_LINES = """
lines AS (
  SELECT l_orderkey AS run, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS k,
    'http://h' || l_suppkey || '/' || l_partkey AS url, 'http://h' || l_suppkey || '/p/' || l_partkey AS landed, l_quantity AS q, round(l_discount * 100) AS d, round(l_tax * 100) AS tax,
    l_returnflag AS flag, l_linestatus AS status FROM lineitem),
told AS (
  SELECT run, row_number() OVER (PARTITION BY run ORDER BY k) - 1 AS j, CASE WHEN tax = 1 THEN landed ELSE url END AS url, CASE WHEN tax = 2 THEN url ELSE '' END AS site_url,
    CASE WHEN status = 'O' THEN CASE WHEN q > 40 THEN 'blocked' WHEN q > 20 THEN 'paywall' ELSE 'unresolved' END END AS branch,
    CASE d WHEN 10 THEN ' ' WHEN 9 THEN 'bad ' || chr(65533) ELSE 'seen' END AS evidence, CASE WHEN q < 10 THEN 'llm' ELSE 'rule' END AS source
  FROM lines WHERE d <> 7),
runs AS (
  SELECT o_orderkey AS run, CASE WHEN o_totalprice < 3000 THEN '' ELSE 't' || o_custkey END AS task, CASE WHEN o_totalprice > 490000 THEN 'not_utf8' WHEN o_totalprice > 470000 THEN 'bad_json' END AS problem,
    o_orderstatus AS s, o_orderpriority AS p FROM orders),
good AS (SELECT * FROM runs WHERE problem IS NULL)"""

_MET = """
met AS (
  SELECT l.*, t.branch, t.source, t.j FROM lines l LEFT JOIN LATERAL (
    SELECT t.*, CASE WHEN l.url IN (t.url, t.site_url) THEN 0 ELSE 1 END AS tier FROM told t WHERE t.run = l.run AND (l.url IN (t.url, t.site_url) OR l.landed IN (t.url, t.site_url))
    ORDER BY tier, t.j DESC LIMIT 1) t ON true
  WHERE l.run IN (SELECT run FROM good))"""

_FINDINGS = """
found AS (
  SELECT run, problem AS code, 'FATAL' AS severity, '$' AS path FROM runs WHERE problem IS NOT NULL
  UNION ALL SELECT run, 'missing_task_id', 'FATAL', '$.task_id' FROM good WHERE task = ''
  UNION ALL SELECT run, 'steps_missing', 'DEGRADED', '$.steps' FROM good WHERE s = 'O'
  UNION ALL SELECT run, 'user_prompt_missing', 'DEGRADED', '$.user_prompt' FROM good WHERE p = '4-NOT SPECIFIED'
  UNION ALL SELECT run, 'run_config_missing', 'DEGRADED', '$.run_config' FROM good WHERE p IN ('3-MEDIUM', '5-LOW')
  UNION ALL SELECT run, CASE s WHEN 'P' THEN 'body_preview_only' ELSE 'no_body' END, 'DEGRADED', '$.search_observation' FROM good WHERE s IN ('P', 'F')
  UNION ALL SELECT run, 'mojibake', 'DEGRADED', '$.search_observation.body_text' FROM good WHERE s = 'O' AND p = '1-URGENT'
  UNION ALL SELECT run, 'evidence_mojibake', 'FATAL', '$.outcomes[' || j || '].evidence' FROM told WHERE contains(evidence, chr(65533)) AND run IN (SELECT run FROM good)
  UNION ALL SELECT run, 'evidence_empty', 'FATAL', '$.outcomes[' || j || '].evidence' FROM told WHERE branch IS NOT NULL AND trim(evidence) = '' AND run IN (SELECT run FROM good)
  UNION ALL SELECT run, 'steps_missing', 'DEGRADED', '$.visits[' || k || '].steps' FROM met WHERE q < 5
  UNION ALL SELECT run, CASE WHEN d < 3 THEN 'body_preview_only' ELSE 'no_body' END, 'DEGRADED', '$.visits[' || k || '].site_obs' FROM met WHERE d < 3 OR d = 5
  UNION ALL SELECT run, 'outcome_missing', 'DEGRADED', '$.visits[' || k || ']' FROM met WHERE j IS NULL
  UNION ALL SELECT run, 'success_branch_mismatch', 'DEGRADED', '$.visits[' || k || '].success' FROM met WHERE j IS NOT NULL AND (flag = 'A') <> (branch IS NULL)
  UNION ALL SELECT run, 'success_without_media', CASE source WHEN 'llm' THEN 'INFO' ELSE 'FATAL' END, '$.visits[' || k || '].player_obs.video_tag_count'
    FROM met WHERE j IS NOT NULL AND flag = 'A' AND branch IS NULL AND tax < 4 AND q < 25)"""

#: Branches of outcomes that never are samples of the pool.
NOT_POOLED = ["unresolved"]

_BELONGING = "belonging AS (SELECT t.run, t.j, g.task, t.url, t.branch FROM told t JOIN good g USING (run) WHERE t.branch IN ('blocked', 'paywall'))"
_POOL = "pool AS (SELECT task AS task_id, url, branch FROM belonging WHERE NOT (branch = 'blocked' AND j < 2)), quarantined AS (SELECT DISTINCT landed AS url FROM lines WHERE tax = 1 AND flag = 'R')"


def run_files(spark, sf_dir):
    """files(run, raw): every order as the JSON of an archive; no text where bytes were bad, cut off where JSON is."""
    line = table(spark, sf_dir, "lineitem")
    url = F.concat(F.lit("http://h"), "l_suppkey", F.lit("/"), "l_partkey")
    landed = F.concat(F.lit("http://h"), "l_suppkey", F.lit("/p/"), "l_partkey")
    q, d, tax = F.col("l_quantity"), F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100)
    won, text = F.col("l_returnflag") == "A", F.lit("whole page")
    site = F.struct(F.when((d > 2) & (d != 5), text).alias("body_text"), F.when(d < 3, text).alias("body_preview"), F.when(tax >= 4, F.lit(2)).otherwise(F.lit(0)).alias("video_tag_count"))
    player = F.when(won & (q >= 25), F.struct(text.alias("body_text"), F.lit("1").alias("video_tag_count")))
    visit = F.struct(url.alias("url"), landed.alias("landed_url"), won.alias("success"), F.when(q >= 5, F.array(F.struct(F.lit("goto").alias("tool")))).otherwise(F.array()).alias("steps"), site.alias("site_obs"), player.alias("player_obs"))
    branch = F.when(F.col("l_linestatus") == "O", F.when(q > 40, "blocked").when(q > 20, "paywall").otherwise("unresolved"))
    outcome = F.struct(
        F.when(tax == 1, landed).otherwise(url).alias("url"),
        F.when(tax == 2, url).alias("site_url"),
        branch.alias("branch"),
        F.when(d == 10, " ").when(d == 9, "bad " + integrity.REPLACEMENT).otherwise("seen").alias("evidence"),
        F.when(q < 10, "llm").otherwise("rule").alias("source"),
    )
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", visit.alias("visit"), F.when(d != 7, outcome).alias("outcome"))
    lines = line.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(order)).alias("lines"))  # an order has a few lines
    s, p = F.col("o_orderstatus"), F.col("o_orderpriority")
    search = F.struct(
        F.lit("http://s/").alias("url"),
        F.when(s == "O", F.when(p == "1-URGENT", "results " + integrity.REPLACEMENT).otherwise("results")).alias("body_text"),
        F.when(s == "P", "results").alias("body_preview"),
    )
    document = F.struct(
        F.when(F.col("o_totalprice") < 3000, "").otherwise(F.concat(F.lit("t"), "o_custkey")).alias("task_id"),
        F.when(p != "4-NOT SPECIFIED", p).alias("user_prompt"),
        F.when(p != "5-LOW", F.when(p == "3-MEDIUM", F.array().cast("array<int>")).otherwise(F.array(F.lit(20)))).alias("run_config"),
        F.when(s != "O", F.array(F.lit("search"))).otherwise(F.array().cast("array<string>")).alias("steps"),
        search.alias("search_observation"),
        F.transform("lines", lambda x: x["visit"]).alias("visits"),
        F.filter(F.transform("lines", lambda x: x["outcome"]), lambda x: x.isNotNull()).alias("outcomes"),
    )
    price = F.col("o_totalprice")
    raw = F.to_json(document)
    raw = F.when(price > 490000, None).when(price > 470000, F.substring(raw, F.lit(1), F.length(raw) - 1)).otherwise(raw)
    rows = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    return rows.select(F.col("o_orderkey").cast("string").alias("run"), raw.alias("raw"))


def _pool(spark, sf_dir, belonging):
    line = table(spark, sf_dir, "lineitem")
    pool = belonging.where("NOT (branch = 'blocked' AND idx < 2)").select(F.col("task").alias("task_id"), "url", "branch")
    landed = F.concat(F.lit("http://h"), "l_suppkey", F.lit("/p/"), "l_partkey")
    return pool, line.where((F.round(F.col("l_tax") * 100) == 1) & (F.col("l_returnflag") == "R")).select(landed.alias("url")).distinct()


@query(f"WITH {_LINES}, {_MET}, {_FINDINGS} SELECT CAST(run AS VARCHAR) AS run, code, severity, path FROM found")
def q21_findings(spark, sf_dir):
    """Everything that is wrong with each archive, with its place."""
    return integrity.archive_findings(integrity.parsed(run_files(spark, sf_dir)))


@query(f"""WITH {_LINES}, {_BELONGING}, {_POOL}
SELECT CAST(b.run AS VARCHAR) AS run, 'negative_not_pooled' AS code, 'DEGRADED' AS severity, '$.outcomes[' || j || ']' AS path FROM belonging b
WHERE NOT EXISTS (SELECT 1 FROM pool p WHERE p.task_id = b.task AND p.url = b.url AND p.branch = b.branch) AND url NOT IN (SELECT url FROM quarantined)
""")
def q21_not_pooled(spark, sf_dir):
    """Negatives that are missing in the pool, which lacks blocked ones among the first two outcomes of runs."""
    belonging = integrity.negatives(integrity.parsed(run_files(spark, sf_dir), "task_id", "outcomes"), NOT_POOLED)
    return integrity.not_in_pool(belonging, *_pool(spark, sf_dir, belonging))


@query(f"""WITH {_LINES}, {_BELONGING}, {_POOL},
won AS (SELECT url, count(*) AS n_archives, min(CAST(run AS VARCHAR)) AS first_run FROM told WHERE branch IS NULL AND run IN (SELECT run FROM good) GROUP BY url)
SELECT task_id, url, branch, n_archives, first_run, 'FATAL' AS severity FROM pool JOIN won USING (url) WHERE url NOT IN (SELECT url FROM quarantined)
""")
def q21_contradicted(spark, sf_dir):
    """Rows of the pool whose url another archive reached."""
    files = integrity.parsed(run_files(spark, sf_dir), "task_id", "outcomes")
    return integrity.contradicted(files, *_pool(spark, sf_dir, integrity.negatives(files, NOT_POOLED)))


@query(f"""WITH {_LINES}, {_MET}, {_FINDINGS}, {_BELONGING},
counts AS (SELECT run, count(*) FILTER (severity = 'FATAL') AS fatal, count(*) FILTER (severity = 'DEGRADED') AS degraded FROM found GROUP BY run)
SELECT CAST(r.run AS VARCHAR) AS run, CASE WHEN problem IS NULL THEN (SELECT count(*) FROM lines l WHERE l.run = r.run) ELSE 0 END AS sites,
  CASE WHEN problem IS NULL THEN (SELECT count(*) FROM told t WHERE t.run = r.run) ELSE 0 END AS outcomes, (SELECT count(*) FROM belonging b WHERE b.run = r.run) AS negatives,
  coalesce(fatal, 0) AS fatal, coalesce(degraded, 0) AS degraded, coalesce(fatal, 0) = 0 AS ok
FROM runs r LEFT JOIN counts USING (run)
""")
def q21_report(spark, sf_dir):
    files = integrity.parsed(run_files(spark, sf_dir))
    return integrity.report(files, integrity.archive_findings(files), integrity.negatives(files, NOT_POOLED))


@query("""
WITH s AS (SELECT doc_id AS id FROM documents), v AS (SELECT doc_id AS id FROM labels), t AS (SELECT page_id AS id FROM pages)
SELECT * FROM (
  SELECT 'samples' AS missing_from, 'views' AS present_in, count(*) AS n FROM (SELECT * FROM v EXCEPT SELECT * FROM s)
  UNION ALL SELECT 'views', 'samples', count(*) FROM (SELECT * FROM s EXCEPT SELECT * FROM v)
  UNION ALL SELECT 'samples', 'tasks', count(*) FROM (SELECT * FROM t EXCEPT SELECT * FROM s)
  UNION ALL SELECT 'tasks', 'samples', count(*) FROM (SELECT * FROM s EXCEPT SELECT * FROM t)) WHERE n > 0
""")
def q21_composition(spark, sf_dir):
    """Documents as samples, labelled ones as views, pages as task views."""
    ids = lambda name, key: table(spark, sf_dir, name).select(F.col(key).alias("id"))
    return integrity.composition(ids("documents", "doc_id"), ids("labels", "doc_id"), ids("pages", "page_id"))
