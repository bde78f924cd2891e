"""op4: every conversation from the view of each participant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayline.llm.chat import perspectives
from wayline.session import table


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives(table(spark, sf_dir, "conversations"))


ORACLE = """
WITH said AS (
  SELECT conv_id, turn, coalesce(nullif(regexp_replace(role, '[^A-Za-z0-9_-]', '_', 'g'), ''), 'unknown') AS name, coalesce(text, '') AS text FROM conversations),
speakers AS (SELECT DISTINCT conv_id, name AS speaker FROM said WHERE name <> 'system'),
views AS (
  SELECT said.conv_id, speaker, turn, name, text, CASE WHEN name = 'system' THEN 'system' WHEN name = speaker THEN 'assistant' ELSE 'user' END AS role
  FROM said JOIN speakers ON said.conv_id IS NOT DISTINCT FROM speakers.conv_id),
headed AS (SELECT *, '<|' || role || CASE WHEN role = 'user' THEN ' name=' || name ELSE '' END || '|>' || chr(10) AS head FROM views),
rendered AS (SELECT *, head || text || '<|end|>' || chr(10) AS rendered FROM headed),
placed AS (
  SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, speaker ORDER BY turn NULLS LAST, name, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    - length(rendered) AS start FROM rendered)
SELECT conv_id, speaker, turn, name, role, rendered, CAST(start AS BIGINT) AS start,
  CAST(CASE WHEN role = 'assistant' THEN start + length(head) ELSE start END AS BIGINT) AS mask_start,
  CAST(CASE WHEN role = 'assistant' THEN start + length(rendered) ELSE start END AS BIGINT) AS mask_end
FROM placed
"""
