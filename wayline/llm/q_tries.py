"""op13: the prefix trie of the rebuilt conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayline.llm.tries import prefix_trie
from wayline.session import table


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, md5(role) || md5(text) AS said, strlen(text) AS bytes,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS r FROM said),
checked AS (
  SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base, max(r) AS n,
    xor(list_reduce([4294967295::BIGINT] || [ascii(x)::BIGINT for x in string_split(conv_id::VARCHAR, '')],
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 9 AS h
  FROM turns GROUP BY conv_id),
given AS (SELECT c.conv_id, c.h, c.base, least(c.h, coalesce(b.n, 0)) AS heads FROM checked c LEFT JOIN checked b ON b.conv_id = c.base),
rebuilt AS (
  SELECT g.conv_id, t.r AS depth, said, bytes FROM given g JOIN turns t ON t.conv_id = g.base AND t.r <= g.h
  UNION ALL SELECT g.conv_id, t.r - g.h + g.heads, said, bytes FROM given g JOIN turns t ON t.conv_id = g.conv_id AND t.r > g.h
  UNION ALL SELECT conv_id, 0, '', 0 FROM given),
paths AS (
  SELECT conv_id, depth, bytes, md5(string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS path,
    lead(depth) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS last FROM rebuilt),
linked AS (SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM paths),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, any_value(parent) AS parent, any_value(bytes) AS bytes, count(*) AS n_convs, bool_and(last) AS leaf,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM linked GROUP BY path, depth),
below AS (
  SELECT p.path, p.depth, sum(CASE WHEN n.leaf THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.path, p.depth),
children AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent, depth)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.path = n.path AND b.depth = n.depth
  LEFT JOIN nodes p ON p.path = n.parent AND p.depth = n.depth - 1 LEFT JOIN children c ON c.parent = n.path AND c.depth = n.depth
"""
