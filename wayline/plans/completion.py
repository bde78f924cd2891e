"""Queries over the ends of sessions: users on a day are sessions, their events what happened."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import completion
from wayline.plans.catalog import query
from wayline.session import table

_EVENTS = """
told AS (
  SELECT user_id || '-' || dayofyear(ts) AS session, event_id AS seq, value, json_extract_string(props, '$.k') AS k, CASE event_type WHEN 'purchase' THEN 'tool_execution' WHEN 'signup' THEN CASE WHEN value > 60 THEN 'error' WHEN value > 50 THEN 'cancel' ELSE 'final_reply' END ELSE 'model_response' END AS kind,
    CASE event_type WHEN 'view' THEN 'text' WHEN 'click' THEN 'toolcall' WHEN 'error' THEN 'thinking' END AS type FROM events),
rows AS (SELECT *, kind IN ('final_reply', 'error', 'cancel') AS ends FROM told),
placed AS (SELECT *, coalesce(sum(CASE WHEN ends THEN 1 ELSE 0 END) OVER (PARTITION BY session ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS message,
    CASE type WHEN 'text' THEN 'said ' || k || CASE WHEN value < 30 THEN '.' WHEN value < 60 THEN ' DONE' ELSE '...' END WHEN 'thinking' THEN repeat('x', CAST(floor(value) AS INTEGER)) END AS text FROM rows),
sessions AS (SELECT session, arg_max(kind, seq) AS last_event, count(*) FILTER (ends) AS ended, count(*) FILTER (kind = 'tool_execution' AND k <> '5') AS results FROM placed GROUP BY session),
said AS (SELECT p.* FROM placed p JOIN sessions s USING (session) WHERE kind = 'model_response' AND message < ended),
calls AS (SELECT session, count(*) FILTER (type = 'toolcall') AS calls, max(message) AS message FROM said GROUP BY session),
last AS (SELECT s.session, arg_max(type, seq) AS last_block, count(*) FILTER (type = 'text') AS texts, arg_max(text, seq) FILTER (type = 'text') AS final_text, coalesce(sum(length(text)) FILTER (type = 'thinking'), 0) AS thoughts
  FROM said s JOIN calls c ON c.session = s.session AND c.message = s.message GROUP BY s.session),
met AS (
  SELECT s.session, last_event, coalesce(last_block, '') AS last_block, coalesce(final_text, '') AS final_text, CASE WHEN last_event IN ('error', 'cancel') THEN 'terminal_event:' || last_event WHEN last_event <> 'final_reply' THEN 'no_terminal_event' ELSE concat_ws(',',
      CASE WHEN last_block = 'toolcall' THEN 'last_block_is_call' END, CASE WHEN coalesce(calls, 0) > results AND coalesce(final_text, '') NOT LIKE '% DONE' THEN 'calls_without_result' END,
      CASE WHEN last_block = 'text' AND final_text LIKE '%...' THEN 'last_text_incomplete' END, CASE WHEN last_block = 'thinking' AND texts = 0 AND thoughts >= 40 THEN 'thinking_only' END) END AS reasons
  FROM sessions s LEFT JOIN calls USING (session) LEFT JOIN last USING (session))"""


@query(f"""WITH {_EVENTS}
SELECT session, CASE WHEN last_event IN ('error', 'cancel') THEN 'aborted' WHEN reasons <> '' THEN 'incomplete' ELSE 'complete' END AS status, reasons, last_event,
  CASE WHEN last_event = 'final_reply' THEN last_block ELSE '' END AS last_block, CASE WHEN last_event = 'final_reply' THEN final_text ELSE '' END AS final_text, last_event NOT IN ('error', 'cancel') AND reasons <> '' AS retryable FROM met
""")
def q42_completion(spark, sf_dir):
    """Whether each user's day came to an end, and what speaks against it."""
    event, value, k = F.col("event_type"), F.col("value"), F.get_json_object("props", "$.k")
    kind = F.when(event == "purchase", "tool_execution").when(event == "signup", F.when(value > 60, "error").when(value > 50, "cancel").otherwise("final_reply")).otherwise("model_response")
    type_ = F.when(event == "view", "text").when(event == "click", "toolcall").when(event == "error", "thinking")
    said = F.concat(F.lit("said "), k, F.when(value < 30, ".").when(value < 60, " DONE").otherwise("..."))
    text = F.when(event == "view", said).when(event == "error", F.repeat(F.lit("x"), F.floor(value).cast("int")))
    blocks = F.when(type_.isNotNull(), F.array(F.struct(type_.alias("type"), k.alias("id"), text.alias("text"))))
    rows = table(spark, sf_dir, "events").select(F.concat_ws("-", "user_id", F.dayofyear("ts")).alias("session"), F.col("event_id").alias("seq"), kind.alias("event_type"), blocks.alias("blocks"), F.when(k != "5", k).otherwise("").alias("call_id"))
    told = completion.completion(rows, lambda t: F.endswith(t, F.lit("...")), lambda t: F.endswith(t, F.lit(" DONE")), thought=40)
    return told.withColumn("reasons", F.array_join("reasons", ","))
