"""Queries over sessions of blocks: users are sessions, their events blocks, and events of one speaker in a row a message."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.operators import chats
from wayline.plans.catalog import query
from wayline.session import table

_BLOCKS = r"""
told AS (
  SELECT user_id AS session, event_id AS place, CASE event_type WHEN 'view' THEN 'user' ELSE 'assistant' END AS role, value,
    CASE event_type WHEN 'click' THEN 'toolcall' WHEN 'purchase' THEN 'toolresult' WHEN 'signup' THEN 'thinking' ELSE 'text' END AS type,
    CASE WHEN value < 2 THEN '' ELSE 'c' || left(json_extract_string(props, '$.k'), 1) END AS id, 't' || right(json_extract_string(props, '$.k'), 1) AS name,
    CASE WHEN value < 8 THEN '' ELSE event_type || ' ' || event_id END AS text, CASE WHEN value < 8 THEN '{broken ' || event_id ELSE props END AS input,
    CASE WHEN value < 40 THEN 'success' ELSE 'error' END AS state, count(*) OVER (PARTITION BY user_id) AS n FROM events),
turned AS (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY session ORDER BY place) THEN 0 ELSE 1 END AS turn FROM told),
blocks AS (SELECT *, sum(turn) OVER (PARTITION BY session ORDER BY place) AS message FROM turned),
refined AS (SELECT * FROM blocks WHERE NOT (type = 'toolcall' AND value > 60) AND NOT (type = 'toolresult' AND value > 130) AND NOT (role = 'user' AND n < 60))"""

_MESSAGES = """
parted AS (
  SELECT *, CASE WHEN role = 'assistant' THEN 2 * coalesce(sum(CASE WHEN type = 'toolresult' THEN 1 ELSE 0 END) OVER (PARTITION BY session, message ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    + CASE WHEN type = 'toolresult' THEN 1 ELSE 0 END ELSE 0 END AS part FROM blocks),
messages AS (
  SELECT session, row_number() OVER (PARTITION BY session ORDER BY message, part) AS seq, CASE WHEN bool_or(type = 'toolresult') THEN 'tool' ELSE any_value(role) END AS role,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (type IN ('text', 'toolresult')), '') AS content, string_agg(text, '' ORDER BY place) FILTER (type = 'thinking') AS reasoning,
    coalesce(string_agg('call_' || CASE id WHEN '' THEN 'unknown' ELSE id END || ' ' || name || ' ' || CASE WHEN value < 8 THEN '{"raw":"' || input || '"}' ELSE input END, ';' ORDER BY place) FILTER (type = 'toolcall'), '') AS calls,
    CASE WHEN bool_or(type = 'toolresult') THEN 'call_' || CASE any_value(id) WHEN '' THEN 'unknown' ELSE any_value(id) END END AS call_id,
    NOT bool_or(type IN ('text', 'toolresult')) AS filled
  FROM parted GROUP BY session, message, part)"""


def _blocks(spark, sf_dir):
    event, k = F.col("event_type"), F.get_json_object("props", "$.k")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("session"),
        F.col("event_id").alias("place"),
        F.when(event == "view", "user").otherwise("assistant").alias("role"),
        F.when(event == "click", "toolcall").when(event == "purchase", "toolresult").when(event == "signup", "thinking").otherwise("text").alias("type"),
        F.when(F.col("value") < 2, "").otherwise(F.concat(F.lit("c"), F.left(k, F.lit(1)))).alias("id"),
        F.concat(F.lit("t"), F.right(k, F.lit(1))).alias("name"),
        F.when(F.col("value") < 8, "").otherwise(F.concat_ws(" ", "event_type", "event_id")).alias("text"),
        F.when(F.col("value") < 8, F.concat(F.lit("{broken "), "event_id")).otherwise(F.col("props")).alias("input"),
        F.when(F.col("value") < 40, "success").otherwise("error").alias("state"),
        "value",
        F.count("*").over(W.partitionBy("user_id")).alias("n"),
    )
    order = W.partitionBy("session").orderBy("place")
    turn = F.when(F.col("role") == F.lag("role").over(order), 0).otherwise(1)
    return rows.withColumn("turn", turn).withColumn("message", F.sum("turn").over(order))


def _refined(rows):
    return rows.where("NOT (type = 'toolcall' AND value > 60) AND NOT (type = 'toolresult' AND value > 130) AND NOT (role = 'user' AND n < 60)")


@query(f"WITH {_BLOCKS}, {_MESSAGES} SELECT session, seq, role, content, reasoning, calls, call_id, filled FROM messages")
def h18_chat_messages(spark, sf_dir):
    """Every session as chat messages, calls and their results among them."""
    made = chats.chat_messages(_blocks(spark, sf_dir))
    calls = F.array_join(F.transform("calls", lambda c: F.concat_ws(" ", c["id"], c["name"], c["arguments"])), ";")
    return made.select("session", "seq", "role", "content", "reasoning", calls.alias("calls"), "call_id", "filled")


@query(f"""WITH {_BLOCKS}, {_MESSAGES}, firsts AS (SELECT session, name, min(place) AS place FROM blocks WHERE type = 'toolcall' GROUP BY session, name)
SELECT session, count(*) FILTER (type = 'toolcall') AS tool_calls, count(*) FILTER (type = 'toolresult') AS tool_results, count(*) FILTER (type = 'toolcall' AND value >= 8) AS arguments_parsed,
  count(*) FILTER (type = 'toolcall' AND value < 8) AS arguments_broken, (SELECT count(*) FROM messages m WHERE m.session = b.session AND filled) AS contents_filled,
  coalesce((SELECT string_agg(name, ',' ORDER BY place) FROM firsts f WHERE f.session = b.session), '') AS tools
FROM blocks b GROUP BY session
""")
def h19_repairs(spark, sf_dir):
    """What was repaired in each session."""
    return chats.repairs(_blocks(spark, sf_dir)).withColumn("tools", F.array_join("tools", ","))


_POINTS = """
{0}_steps AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY message, place) - 1 AS step FROM {0}),
{0}_points AS (
  SELECT c.session, c.step, c.id, r.state FROM {0}_steps c LEFT JOIN LATERAL (
    SELECT r.state FROM {0}_steps r WHERE r.session = c.session AND r.type = 'toolresult' AND r.id = c.id AND r.step > c.step
      AND NOT EXISTS (SELECT 1 FROM {0}_steps o WHERE o.session = c.session AND o.role = 'assistant' AND o.type NOT IN ('toolcall', 'toolresult') AND o.step > c.step AND o.step < r.step)
    ORDER BY r.step LIMIT 1) r ON true
  WHERE c.type = 'toolcall' AND (r.state IS NULL OR r.state <> 'success'))"""
_SIDE = """
{0}_side AS (
  SELECT session, arg_min(text, place) FILTER (role = 'user' AND text <> '' AND opens) AS goal, arg_max(text, place) FILTER (role = 'assistant' AND type = 'text' AND text <> '') AS results,
    coalesce(string_agg(right(name, 1), '' ORDER BY place) FILTER (type = 'toolcall'), '') AS actions
  FROM (SELECT *, row_number() OVER (PARTITION BY session, message ORDER BY place) = 1 AS opens FROM {0}) GROUP BY session)"""


@query(f"WITH {_BLOCKS}, {_POINTS.format('blocks')} SELECT session, step, id, state FROM blocks_points")
def q44_breakpoints(spark, sf_dir):
    """Calls without a good result."""
    return chats.breakpoints(_blocks(spark, sf_dir))


@query(f"""WITH {_BLOCKS}, {_POINTS.format('blocks')}, {_POINTS.format('refined')}, {_SIDE.format('blocks')}, {_SIDE.format('refined')},
kinds AS (
  SELECT session, count(*) FILTER (value < 1.2 OR (value >= 4 AND value < 4.6)) AS worse, count(*) FILTER (value >= 1.2 AND value < 4) AS odd FROM blocks WHERE type = 'thinking' GROUP BY session),
before AS (SELECT session, count(*) AS n FROM blocks_points GROUP BY session), after AS (SELECT session, count(*) AS n FROM refined_points GROUP BY session),
rows AS (
  SELECT a.session, concat_ws(',', CASE WHEN a.goal IS NOT NULL AND b.goal IS NULL THEN 'goal' END, CASE WHEN a.results IS NOT NULL AND b.results IS NULL THEN 'results' END) AS lost,
    CASE WHEN worse > 0 OR odd > 2 THEN 'fail' WHEN odd > 0 THEN 'review' ELSE 'pass' END AS adherence,
    CASE WHEN coalesce(f.n, 0) < coalesce(e.n, 0) THEN 'improved' WHEN coalesce(f.n, 0) = coalesce(e.n, 0) THEN 'unchanged' ELSE 'degraded' END AS coherence, levenshtein(a.actions, b.actions) AS distance
  FROM blocks_side a JOIN refined_side b USING (session) LEFT JOIN kinds k ON k.session = a.session LEFT JOIN before e ON e.session = a.session LEFT JOIN after f ON f.session = a.session)
SELECT *, CASE WHEN lost <> '' OR adherence = 'fail' OR coherence = 'degraded' THEN 'fail' ELSE 'pass' END AS verdict FROM rows
""")
def q44_compare(spark, sf_dir):
    """Each session against its version without dear calls and results, and without questions where it is short."""
    rows = _blocks(spark, sf_dir)
    value = F.col("value")
    status = F.when(value < 1.2, "rollback").when(value < 4, "needs_review").when(value < 20, "edited").otherwise("preserved")
    records = rows.where("type = 'thinking'").select("session", status.alias("status"), ((value >= 4) & (value < 4.6)).alias("invalid"))
    return chats.compared(rows, _refined(rows), records).withColumn("lost", F.array_join("lost", ","))
