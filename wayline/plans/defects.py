"""Queries over defects of blocks: users are sessions, their events blocks, ten days of a user a message."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import defects
from wayline.plans.catalog import query
from wayline.session import table

LIMITS = defects.Limits(short_thought=15, long_thought=60, repeats=2, switches=1, failures=2, health=0.3)
UNITS = ("days", "hours")

_BLOCKS = r"""
told AS (
  SELECT user_id AS session, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10 AS message, event_id AS place, value, json_extract_string(props, '$.k') AS k,
    CASE event_type WHEN 'click' THEN 'toolcall' WHEN 'purchase' THEN 'toolresult' WHEN 'signup' THEN 'thinking' ELSE 'text' END AS type FROM events),
blocks AS (
  SELECT *, CASE left(k, 1) WHEN '1' THEN 'browser' WHEN '2' THEN 'execute_shell_command' WHEN '3' THEN 'odd' ELSE 'look' END AS name,
    CASE WHEN value < 3 THEN '{broken' ELSE '{"k": "' || CASE WHEN value > 150 THEN 'OldApi' ELSE left(k, 1) END || '"}' END AS input,
    CASE WHEN value < 60 THEN 'success' ELSE 'error' END AS state,
    CASE type WHEN 'thinking' THEN repeat('x', CAST(floor(value) AS INTEGER)) WHEN 'text' THEN left(k, 1) || ' days and ' || right(k, 1) || 'hours'
      WHEN 'toolresult' THEN left(k, 1) || '  days, ' || right(k, 1) || ' hours' || CASE WHEN value < 10 THEN ' Traceback' ELSE '' END ELSE '' END AS text FROM told)"""
_QUANTITIES = """
each AS (SELECT session, message, place, type, left(k, 1) AS number, 'days' AS unit FROM blocks WHERE type IN ('text', 'toolresult') UNION ALL SELECT session, message, place, type, right(k, 1), 'hours' FROM blocks WHERE type IN ('text', 'toolresult')),
loose AS (
  SELECT session, message, place, number, unit FROM each e WHERE type = 'text' AND EXISTS (SELECT 1 FROM blocks r WHERE r.session = e.session AND r.message = e.message AND r.type = 'toolresult' AND r.place < e.place)
    AND NOT EXISTS (SELECT 1 FROM each r WHERE r.session = e.session AND r.message = e.message AND r.type = 'toolresult' AND r.place < e.place AND r.number = e.number AND r.unit = e.unit))"""


def _blocks(spark, sf_dir):
    event, k, value = F.col("event_type"), F.get_json_object("props", "$.k"), F.col("value")
    first, last = F.left(k, F.lit(1)), F.right(k, F.lit(1))
    kind = F.when(event == "click", "toolcall").when(event == "purchase", "toolresult").when(event == "signup", "thinking").otherwise("text")
    text = (
        F.when(kind == "thinking", F.repeat(F.lit("x"), F.floor(value).cast("int")))
        .when(kind == "text", F.concat(first, F.lit(" days and "), last, F.lit("hours")))
        .when(kind == "toolresult", F.concat(first, F.lit("  days, "), last, F.lit(" hours"), F.when(value < 10, " Traceback").otherwise("")))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("session"),
        F.floor(F.datediff(F.to_date("ts"), F.to_date(F.lit("2024-01-01"))) / 10).alias("message"),
        F.col("event_id").alias("place"),
        F.lit("assistant").alias("role"),
        kind.alias("type"),
        F.lit("").alias("id"),
        F.when(first == "1", "browser").when(first == "2", "execute_shell_command").when(first == "3", "odd").otherwise("look").alias("name"),
        text.alias("text"),
        F.when(value < 3, "{broken").otherwise(F.concat(F.lit('{"k": "'), F.when(value > 150, "OldApi").otherwise(first), F.lit('"}'))).alias("input"),
        F.when(value < 60, "success").otherwise("error").alias("state"),
    )


@query(f"WITH {_BLOCKS}, {_QUANTITIES} SELECT DISTINCT session, message, place, number, unit FROM loose")
def q39_unverified_quantities(spark, sf_dir):
    """Quantities that a text says and no result before it."""
    return defects.unverified_quantities(_blocks(spark, sf_dir), UNITS)


@query(f"""WITH {_BLOCKS}, {_QUANTITIES},
ordered AS (SELECT *, lag(name) OVER o AS name1, lag(input) OVER o AS input1 FROM blocks WHERE type = 'toolcall' WINDOW o AS (PARTITION BY session, message ORDER BY place)),
runs AS (SELECT *, sum(CASE WHEN name = name1 AND input = input1 THEN 0 ELSE 1 END) OVER (PARTITION BY session, message ORDER BY place) AS run,
    (name = 'browser' AND name1 = 'execute_shell_command') OR (name1 = 'browser' AND name = 'execute_shell_command') AS switched FROM ordered),
calls AS (SELECT *, count(*) OVER (PARTITION BY session, message, run) AS n FROM runs),
results AS (SELECT *, row_number() OVER (PARTITION BY session, message ORDER BY place) - 1 AS nth FROM blocks WHERE type = 'toolresult'),
good AS (SELECT session, message, count(*) FILTER (state = 'success') AS good, min(nth) FILTER (state = 'success') AS first FROM results GROUP BY ALL),
state AS (SELECT session, message, count(*) AS calls, count(*) FILTER (switched) AS switches, max(n) >= 3 AS loop FROM calls GROUP BY ALL),
whole AS (
  SELECT session, message, switches >= 1 AS switching, coalesce(first, calls) > 2 OR greatest(coalesce(good, 0) / calls - least(coalesce(first, calls) / 2, 1.0) * 0.4 - CASE WHEN loop THEN 0.3 ELSE 0 END - CASE WHEN switches >= 1 THEN 0.3 ELSE 0 END, 0) < 0.3 AS unhealthy
  FROM state LEFT JOIN good USING (session, message)),
tags AS (
  SELECT session, message, place, 'thought_too_short' AS tag FROM blocks WHERE type = 'thinking' AND length(text) < 15
  UNION ALL SELECT session, message, place, 'thought_too_long' FROM blocks WHERE type = 'thinking' AND length(text) > 60
  UNION ALL SELECT session, message, place, 'obs_debug_leak' FROM blocks WHERE type = 'toolresult' AND value < 10
  UNION ALL SELECT session, message, place, 'tool_json_invalid' FROM blocks WHERE type = 'toolcall' AND value < 3
  UNION ALL SELECT session, message, place, 'tool_hallucinated' FROM blocks WHERE type = 'toolcall' AND value >= 3 AND name = 'odd'
  UNION ALL SELECT session, message, place, 'api_hallucination' FROM blocks WHERE type = 'toolcall' AND value > 150
  UNION ALL SELECT session, message, place, 'tool_off_topic' FROM blocks WHERE type = 'toolcall' AND name = 'odd'
  UNION ALL SELECT session, message, place, 'repetitive_call' FROM calls WHERE n >= 2
  UNION ALL SELECT session, message, place, 'text_fact_hallucination' FROM loose
  UNION ALL SELECT session, message, place, 'context_switch_loop' FROM blocks JOIN whole USING (session, message) WHERE switching
  UNION ALL SELECT session, message, place, 'message_unhealthy' FROM blocks JOIN whole USING (session, message) WHERE unhealthy)
SELECT session, message, place, string_agg(DISTINCT tag, ',' ORDER BY tag) AS tags FROM tags GROUP BY session, message, place
""")
def q39_defect_tags(spark, sf_dir):
    """All defects of each block that rules can tell; similar inputs are equal ones here."""
    found = defects.defect_tags(_blocks(spark, sf_dir), lambda a, b: a == b, ["browser", "execute_shell_command", "look"], ["oldapi"], ["odd"], UNITS, LIMITS)
    return found.select("session", "message", "place", F.array_join("tags", ",").alias("tags"))
