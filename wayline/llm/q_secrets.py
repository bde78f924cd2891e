"""op1: secrets in every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.llm import secrets
from wayline.session import table


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def _matches(kind: str) -> str:
    pattern, group = secrets.PATTERNS[kind]
    sql = pattern.replace("'", "''")
    return f"""SELECT doc_id, row_id, '{kind}' AS pattern, unnest(range(len(m))) AS k,
        unnest([length(x) for x in b[1:len(m)]]) AS before, unnest([length(x) for x in m]) AS whole, unnest(g) AS token
      FROM (SELECT doc_id, row_id, regexp_extract_all(text, '{sql}') AS m, regexp_extract_all(text, '{sql}', {group}) AS g, string_split_regex(text, '{sql}') AS b FROM docs)"""


def _near(*kinds: str) -> str:
    here = "CASE WHEN kind IN ({}) THEN {{}} END".format(", ".join(f"'{k}'" for k in kinds))
    return f"(coalesce(start - max({here.format('stop')}) OVER before <= {secrets.SCOPE}, false) OR coalesce(min({here.format('start')}) OVER after - stop <= {secrets.SCOPE}, false))"


ORACLE = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_id FROM documents),
matched AS ({" UNION ALL ".join(_matches(kind) for kind in secrets.PATTERNS)}),
placed AS (
  SELECT *, sum(before + whole) OVER (PARTITION BY row_id, pattern ORDER BY k) AS stop,
    CASE WHEN pattern <> 'long' THEN pattern
      WHEN regexp_matches(token, '[0-9]') AND regexp_matches(token, '[A-Z]') AND regexp_matches(token, '^[A-Z0-9]{{16,40}}$') THEN 'identifier'
      WHEN regexp_matches(token, '[0-9]') AND regexp_matches(token, '[A-Z]') AND regexp_matches(token, '[a-z]') AND length(token) >= 28 THEN 'key' END AS kind
  FROM matched),
parts AS (
  SELECT row_id, kind, stop - length(token) AS start, stop, list_position(['assign', 'access', 'hex', 'identifier', 'key', 'endpoint'], kind) AS rank
  FROM placed WHERE kind IS NOT NULL AND (kind <> 'assign' OR length(token) >= 6)),
near AS (
  SELECT *, {_near("assign", "hex", "key")} AS secret, {_near("access", "identifier")} AS name, {_near("endpoint")} AS place,
    coalesce(max(CASE WHEN rank <= 3 THEN stop END) OVER before > start, false) OR coalesce(min(CASE WHEN rank <= 3 THEN start END) OVER after < stop, false) AS on_certain
  FROM parts
  WINDOW before AS (PARTITION BY row_id ORDER BY start, rank, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (PARTITION BY row_id ORDER BY start, rank, stop ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
told AS (
  SELECT row_id, kind, rank, start, kind || ':' || start || ':' || stop AS span,
    CASE WHEN rank <= 3 THEN true WHEN kind = 'key' THEN (name OR place) AND NOT on_certain ELSE secret AND NOT on_certain END AS kept
  FROM near),
per_row AS (
  SELECT row_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY start, rank) FILTER (rank <= 3) AS base, string_agg(span, ',' ORDER BY start, rank) FILTER (kept) AS spans
  FROM told GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per_row USING (row_id)
"""
