"""Queries that match records: documents stand for visits, events for outcomes, labels for gold."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.functions import urls
from wayline.operators import matching
from wayline.plans.catalog import query
from wayline.session import table


def _visits(spark, sf_dir):
    u = lambda n, c: F.concat(F.lit("u"), (F.col("doc_id") % n).cast("string")).alias(c)
    run = F.concat(F.lit("r"), (F.col("doc_id") % 20).cast("string")).alias("run")
    landed = F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat(F.lit("u"), (F.col("doc_id") % 97).cast("string"))).alias("landed_url")
    return table(spark, sf_dir, "documents").select(run, F.col("doc_id").alias("visit"), u(331, "url"), landed, u(61, "player_url"))


def _outcomes(spark, sf_dir):
    u = lambda n, c: F.concat(F.lit("u"), (F.col("event_id") % n).cast("string")).alias(c)
    run = F.concat(F.lit("r"), (F.col("user_id") % 20).cast("string")).alias("run")
    return table(spark, sf_dir, "events").select(run, F.col("event_id").alias("idx"), u(401, "url"), u(53, "site_url"), "event_type")


_VISITS = """visits AS (SELECT 'r' || (doc_id % 20) AS run, doc_id AS visit, 'u' || (doc_id % 331) AS url, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'u' || (doc_id % 97) END AS landed_url, 'u' || (doc_id % 61) AS player_url FROM documents)"""
_OUTCOMES = """outcomes AS (SELECT 'r' || (user_id % 20) AS run, event_id AS idx, 'u' || (event_id % 401) AS url, 'u' || (event_id % 53) AS site_url, event_type FROM events)"""
_MATCHED = f"""WITH {_VISITS}, {_OUTCOMES},
hits AS (
  SELECT v.run, v.visit, tier, max(idx) AS idx FROM (SELECT run, visit, unnest([0, 1, 2]) AS tier, unnest([url, landed_url, player_url]) AS key FROM visits) v
  JOIN outcomes o ON v.run = o.run AND v.key <> '' AND (v.key = o.url OR v.key = o.site_url) GROUP BY v.run, v.visit, tier),
best AS (SELECT run, visit, arg_min(idx, tier) AS outcome FROM hits GROUP BY run, visit),
matched AS (SELECT v.*, coalesce(outcome, -1) AS outcome, outcome IS NOT NULL AS matched FROM visits v LEFT JOIN best USING (run, visit))"""


@query(f"{_MATCHED} SELECT run, visit, outcome, matched FROM matched")
def j1_match_visits(spark, sf_dir):
    return matching.match_visits(_visits(spark, sf_dir), _outcomes(spark, sf_dir)).select("run", "visit", "outcome", "matched")


@query(f"""{_MATCHED},
latest AS (SELECT run, outcome AS idx, max(visit) AS visit FROM matched WHERE outcome >= 0 GROUP BY 1, 2),
ranked AS (SELECT o.run, o.url, o.idx, visit, row_number() OVER (PARTITION BY o.run, o.url ORDER BY visit IS NOT NULL DESC, coalesce(visit, -1) DESC, o.idx DESC) AS rn FROM outcomes o LEFT JOIN latest l USING (run, idx))
SELECT run, url, idx, visit IS NOT NULL AS visited FROM ranked WHERE rn = 1
""")
def j3_url_entries(spark, sf_dir):
    outcomes = _outcomes(spark, sf_dir)
    return matching.url_entries(outcomes, matching.match_visits(_visits(spark, sf_dir), outcomes))


@query("""
SELECT event_id, next_target FROM (SELECT event_id, (SELECT e.value FROM events e WHERE e.user_id = o.user_id AND e.event_type <> 'view' AND e.event_id > o.event_id ORDER BY e.event_id LIMIT 1) AS next_target FROM events o)
""")
def j5_next_visible(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return matching.next_visible(rows, ["user_id"], "event_id", "value", F.col("event_type") != "view").select("event_id", "next_target")


@query("""
WITH a AS (SELECT doc_id, quality AS v FROM labels WHERE doc_id % 3 <> 0), b AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END AS v FROM labels WHERE doc_id % 5 <> 0)
SELECT doc_id, CASE WHEN a.v IS NULL THEN 'only_current' WHEN b.v IS NULL THEN 'only_baseline' WHEN a.v = b.v THEN 'same' ELSE 'changed' END AS state FROM a FULL JOIN b USING (doc_id)
""")
def j8_paired(spark, sf_dir):
    rows = table(spark, sf_dir, "labels")
    old = rows.where("doc_id % 3 <> 0").select("doc_id", F.col("quality").alias("v"))
    new = rows.where("doc_id % 5 <> 0").select("doc_id", F.when(F.col("doc_id") % 7 == 0, 1 - F.col("quality")).otherwise(F.col("quality")).alias("v"))
    return matching.paired(old, new, ["doc_id"], "v").select("doc_id", "state")


_POOL = """rows AS (SELECT user_id AS task_id, 'u' || (event_id % 501) AS url, event_type AS branch, value FROM events),
candidates AS (SELECT DISTINCT task_id, url, branch FROM rows WHERE value > 50), pool AS (SELECT DISTINCT task_id, url, branch FROM rows WHERE value BETWEEN 30 AND 52),
quarantined AS (SELECT DISTINCT url FROM rows WHERE value > 99), succeeded AS (SELECT DISTINCT url FROM rows WHERE value < 1)"""


def _pool(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("task_id"), F.concat(F.lit("u"), (F.col("event_id") % 501).cast("string")).alias("url"), F.col("event_type").alias("branch"), "value")
    keys = rows.select("task_id", "url", "branch", "value")
    some = lambda test, *names: keys.where(test).select(*names).distinct()
    key = ("task_id", "url", "branch")
    return some("value > 50", *key), some("value between 30 and 52", *key), some("value > 99", "url"), some("value < 1", "url")


@query(f"WITH {_POOL} SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM pool p WHERE p.task_id = c.task_id AND p.url = c.url AND p.branch = c.branch) AND url NOT IN (SELECT url FROM quarantined)")
def j13_poolable(spark, sf_dir):
    candidates, pool, quarantined, _ = _pool(spark, sf_dir)
    return matching.poolable(candidates, pool, quarantined).select("task_id", "url", "branch")


@query(f"WITH {_POOL} SELECT * FROM pool WHERE url IN (SELECT url FROM succeeded)")
def j14_contradicted(spark, sf_dir):
    _, pool, _, succeeded = _pool(spark, sf_dir)
    return pool.join(succeeded, "url", "left_semi").select("task_id", "url", "branch")


@query(f"""WITH {_POOL}
SELECT c.*, CASE WHEN url IN (SELECT url FROM quarantined) THEN 'quarantined' WHEN url IN (SELECT url FROM succeeded) THEN 'contradicted'
  WHEN NOT EXISTS (SELECT 1 FROM pool p WHERE p.url = c.url AND p.branch = c.branch) THEN 'stale_branch' END AS refusal FROM candidates c
""")
def j15_refusals(spark, sf_dir):
    candidates, pool, quarantined, succeeded = _pool(spark, sf_dir)
    return matching.refusals(candidates, quarantined, succeeded, pool).select("task_id", "url", "branch", "refusal")


_KEY = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)), '^www\.', '')"


@query(f"""
WITH p AS (SELECT page_id % 3 AS task, {_KEY} AS key, page_id AS seq, length(html) AS value, page_id % 2 AS side FROM pages),
a AS (SELECT task, key, arg_max(value, seq) AS a FROM p WHERE side = 0 GROUP BY 1, 2), b AS (SELECT task, key, arg_max(value, seq) AS b FROM p WHERE side = 1 GROUP BY 1, 2)
SELECT task, key, coalesce(a, -1) AS a, coalesce(b, -1) AS b, CASE WHEN b IS NULL THEN 'only_a' WHEN a IS NULL THEN 'only_b' ELSE 'both' END AS side FROM a FULL JOIN b USING (task, key)
""")
def j16_page_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select((F.col("page_id") % 3).alias("task"), F.regexp_replace(urls.host(F.col("url")), r"^www\.", "").alias("key"), F.col("page_id").alias("seq"), F.length("html").cast("long").alias("value"))
    pairs = matching.page_pairs(rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1"))
    return pairs.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("a", "b")})


@query("""
WITH old AS (SELECT 'n' || (doc_id + 5) AS id, 'l' || doc_id AS legacy_id, quality AS content FROM labels WHERE doc_id % 4 < 3),
cur AS (SELECT CASE WHEN doc_id % 4 = 1 THEN 'x' ELSE 'n' END || (doc_id + 5) AS id, 'l' || doc_id AS legacy_id, CASE WHEN doc_id % 9 = 0 THEN 7 ELSE quality END AS content FROM labels)
SELECT c.id, c.legacy_id, c.content, CASE WHEN a.id IS NOT NULL THEN CASE WHEN a.content = c.content THEN 'unchanged' ELSE 'changed' END
  WHEN b.id IS NOT NULL THEN CASE WHEN b.content = c.content THEN 'id_migrated' ELSE 'changed' END ELSE 'new' END AS state
FROM cur c LEFT JOIN old a ON a.id = c.id LEFT JOIN old b ON b.legacy_id = c.legacy_id
""")
def j20_version_diff(spark, sf_dir):
    rows = table(spark, sf_dir, "labels")
    n, legacy = (F.col("doc_id") + 5).cast("string"), F.concat(F.lit("l"), F.col("doc_id").cast("string")).alias("legacy_id")
    old = rows.where("doc_id % 4 < 3").select(F.concat(F.lit("n"), n).alias("id"), legacy, F.col("quality").alias("content"))
    new_id = F.concat(F.when(F.col("doc_id") % 4 == 1, "x").otherwise("n"), n).alias("id")
    new = rows.select(new_id, legacy, F.when(F.col("doc_id") % 9 == 0, 7).otherwise(F.col("quality")).alias("content"))
    return matching.version_diff(old, new)
