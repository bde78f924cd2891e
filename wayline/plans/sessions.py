"""Queries over sessions of tool calls: users are sessions, their events calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.functions import python
from wayline.operators import session
from wayline.plans.catalog import query
from wayline.session import table

_CALLS = """calls AS (SELECT user_id AS session, event_id AS "at", event_type AS name, CAST(CAST(floor(value / 40) AS INTEGER) AS VARCHAR) AS input,
  CASE WHEN event_type = 'error' THEN 'error' WHEN event_id % 7 > 0 THEN 'success' END AS state FROM events)"""


def _calls(spark, sf_dir):
    state = F.when(F.col("event_type") == "error", "error").when(F.col("event_id") % 7 > 0, "success")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), F.col("event_id").alias("at"), F.col("event_type").alias("name"), F.floor(F.col("value") / 40).cast("int").cast("string").alias("input"), state.alias("state"))


@query(f"""
WITH {_CALLS}, w AS (SELECT *, lag(name) OVER o AS n1, lag(name, 2) OVER o AS n2, lag(input) OVER o AS i1, lag(input, 2) OVER o AS i2, sum(CASE WHEN state = 'success' THEN 1 ELSE 0 END) OVER o AS won
  FROM calls WINDOW o AS (PARTITION BY session ORDER BY "at")),
s AS (SELECT session, count(*) AS calls, count(*) FILTER (state = 'success') AS succeeded, count(*) FILTER (state <> 'success') AS failed, count(*) FILTER (state <> 'success' AND won = 0) AS failures_first,
  count(*) FILTER (name IN ('click', 'view') AND n1 IN ('click', 'view') AND name <> n1) >= 4 AS switch, coalesce(bool_or(name = n1 AND n1 = n2 AND input = i1 AND i1 = i2), false) AS loop FROM w GROUP BY session),
p AS (SELECT *, greatest(0.0, succeeded / calls - least(failures_first / 3, 1.0) * 0.4 - CASE WHEN loop THEN 0.3 ELSE 0 END - CASE WHEN switch THEN 0.3 ELSE 0 END) AS score FROM s)
SELECT *, score >= 0.5 AND NOT loop AND NOT switch AS healthy FROM p
""")
def a43_session_health(spark, sf_dir):
    """Inputs are alike here if they are equal; w8_three_alike compares by their matching blocks."""
    return session.health(_calls(spark, sf_dir), "session", lambda a, b: a == b, ("click", "view"), 4, 3, 0.5)


@query()
def w8_three_alike(spark, sf_dir):
    """Messages of one role three in a row that are alike; difflib's ratio has no SQL."""
    calls = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("at"), F.col("role").alias("name"), F.col("text").alias("input"))
    every_other = calls.where("name = 'user'")
    return session.thrice_alike(every_other, "conv_id", python.alike)


@query("""
WITH b AS (SELECT conv_id, turn, role, text, CASE WHEN turn % 3 = 1 THEN 'toolcall' ELSE 'text' END AS type, CASE WHEN turn % 2 = 0 THEN 'Skill' ELSE role END AS name FROM conversations)
SELECT conv_id, coalesce(string_agg(DISTINCT name, ',' ORDER BY name) FILTER (type = 'toolcall'), '') AS tools, coalesce(string_agg(DISTINCT 's' || (turn % 4), ',' ORDER BY 's' || (turn % 4)) FILTER (type = 'toolcall' AND name = 'Skill'), '') AS skills,
  coalesce(bool_or(type = 'text' AND role = 'assistant' AND regexp_matches(text, '^[A-Z].{4}')), false) AS headline FROM b GROUP BY conv_id
""")
def h16_usage(spark, sf_dir):
    turn = F.col("turn")
    blocks = table(spark, sf_dir, "conversations").select("conv_id", "role", "text", F.when(turn % 3 == 1, "toolcall").otherwise("text").alias("type"), F.when(turn % 2 == 0, "Skill").otherwise(F.col("role")).alias("name"), F.concat(F.lit('{"skill": "s'), (turn % 4).cast("string"), F.lit('"}')).alias("input"))
    found = session.usage(blocks, "conv_id", "^[A-Z].{4}")
    return found.select("conv_id", F.array_join("tools", ",").alias("tools"), F.array_join("skills", ",").alias("skills"), "headline")


@query("""
WITH d AS (SELECT DISTINCT user_id AS session, event_type || event_id % 6 AS tool FROM events WHERE event_type <> 'error'), c AS (SELECT DISTINCT user_id AS session, event_type || event_id % 6 AS tool FROM events WHERE event_id % 9 = 0),
b AS (SELECT session, tool, CASE WHEN d.tool IS NOT NULL AND c.tool IS NOT NULL THEN 'called' WHEN c.tool IS NOT NULL THEN 'stub' ELSE 'unused' END AS why FROM d FULL JOIN c USING (session, tool)),
r AS (SELECT *, count(*) FILTER (why = 'unused') OVER (PARTITION BY session) AS pool, row_number() OVER (PARTITION BY session, why ORDER BY sha256(session || ':' || tool), tool) AS place FROM b)
SELECT session, tool, why FROM r WHERE why <> 'unused' OR place <= least(pool, greatest(2, least(4, floor(pool * 0.25))))
""")
def h17_pruned_tools(spark, sf_dir):
    tool = F.concat("event_type", (F.col("event_id") % 6).cast("string"))
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), tool.alias("tool"), "event_type", "event_id")
    return session.pruned_tools(rows.where("event_type <> 'error'"), rows.where("event_id % 9 = 0"), "session", 2, 4, 0.25)


@query("""
WITH b AS (SELECT user_id AS session, event_id AS "at", CASE event_type WHEN 'click' THEN 'toolcall' WHEN 'view' THEN 'toolresult' ELSE 'text' END AS type, event_id % 20 AS id FROM events),
k AS (SELECT session, "at" FROM b WHERE type = 'toolcall' AND "at" % 3 = 0 AND session % 2 = 0), ids AS (SELECT DISTINCT session, id FROM b JOIN k USING (session, "at"))
SELECT session, "at", type FROM b WHERE session NOT IN (SELECT session FROM k) OR type = 'text' OR (type = 'toolcall' AND (session, "at") IN (SELECT session, "at" FROM k)) OR (type = 'toolresult' AND (session, id) IN (SELECT session, id FROM ids))
""")
def q41_clipped(spark, sf_dir):
    kind = F.when(F.col("event_type") == "click", "toolcall").when(F.col("event_type") == "view", "toolresult").otherwise("text")
    blocks = table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), F.col("event_id").alias("at"), kind.alias("type"), (F.col("event_id") % 20).alias("id"))
    kept = blocks.where("type = 'toolcall' AND at % 3 = 0 AND session % 2 = 0").select("session", "at")
    return session.clipped(blocks, kept, "session").select("session", "at", "type")


@query("""
SELECT conv_id, CASE WHEN sum(length(text) // 100) > 12 THEN 'too_many' WHEN count(*) FILTER (role = 'user') = 0 THEN 'no_user' WHEN count(*) FILTER (role = 'assistant') = 0 THEN 'no_assistant'
  WHEN count(*) FILTER (contains(text, 'error')) > 0 THEN 'error' ELSE '' END AS why FROM conversations GROUP BY conv_id
""")
def p39_filtered_sessions(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "role", F.floor(F.length("text") / 100).alias("blocks"), F.when(F.contains("text", F.lit("error")), "error").alias("error"))
    return session.filtered_sessions(rows, "conv_id", 12)


@query("""
SELECT doc_id, quality = 1 AND toxic = 1 AS compare_warn FROM labels WHERE NOT (quality = 0 AND toxic = 1)
""")
def p40_admitted(spark, sf_dir):
    rows = table(spark, sf_dir, "labels")
    decision = F.when((F.col("quality") == 0) & (F.col("toxic") == 1), "scoring_reject").when(F.col("quality") == 1, "accept")
    return session.admitted(rows, decision, F.when(F.col("toxic") == 1, "fail")).select("doc_id", "compare_warn")


@query("""
WITH e AS (SELECT user_id, CASE WHEN event_id % 8 = 0 THEN '' ELSE event_type || event_id % 50 END AS name, event_type AS role FROM events), p AS (SELECT user_id, role, name, count(*) AS n FROM e GROUP BY ALL),
s AS (SELECT user_id, coalesce(sum(n) FILTER (role NOT IN ('click', 'view', 'signup')), 0) AS role_unmatched, coalesce(sum(n) FILTER (role IN ('click', 'view', 'signup') AND name = ''), 0) AS nameless_dropped,
  coalesce(sum(n) FILTER (role IN ('click', 'view', 'signup') AND name <> '' AND n > 1), 0) AS ambiguous_dropped, coalesce(sum(n) FILTER (role IN ('click', 'view', 'signup') AND name <> '' AND n = 1), 0) AS u FROM p GROUP BY user_id)
SELECT user_id, role_unmatched, nameless_dropped, ambiguous_dropped, least(u, 20) AS kept, u - least(u, 20) AS truncated FROM s
""")
def a8_element_ladder(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("at"), F.col("event_type").alias("role"), F.when(F.col("event_id") % 8 == 0, "").otherwise(F.concat("event_type", (F.col("event_id") % 50).cast("string"))).alias("name"))
    return session.element_ladder(rows, ["user_id"], ["click", "view", "signup"], 20)


@query(f"""
WITH {_CALLS}, c AS (SELECT session, 1 - count(*) FILTER (state <> 'success') / (count(*) + count(*) FILTER (state <> 'success')) AS health, count(DISTINCT name) / count(*) AS diversity FROM calls GROUP BY session),
s AS (SELECT session, greatest(0.0, least(1.0, (health * 0.25 + (session % 11) / 10.0 * 0.25 + (session % 3) / 2.0 * 0.2 + 0.5 * 0.1 + diversity * 0.1) / 0.9)) AS score FROM c)
SELECT session, round(score, 4) AS score, CASE WHEN score >= 0.7 THEN 'easy' WHEN score >= 0.4 THEN 'medium' ELSE 'hard' END AS tier FROM s
""")
def a39_training_value(spark, sf_dir):
    """Health and diversity from a user's calls; the judge's score, the intent fulfilled and the share kept from elsewhere."""
    rows = session.session_components(_calls(spark, sf_dir), "session")
    parts = {"health": F.col("health"), "judge": F.col("session") % 11 / 10, "intent": F.col("session") % 3 / 2, "modified": F.lit(0.5), "diversity": F.col("diversity")}
    told = session.training_value(parts, {"health": 0.25, "judge": 0.25, "intent": 0.2, "modified": 0.1, "diversity": 0.1})
    return rows.select("session", told["score"].alias("score"), told["tier"].alias("tier"))
