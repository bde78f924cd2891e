"""op11: what five filters remove from every source, in every order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayline.llm.interactions import audit
from wayline.session import table


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
labelled AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
marked AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM docs),
counts AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM marked LEFT JOIN labelled USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS f, string_split(filter_order[1:step - 1], '') AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS step)),
placed AS (
  SELECT part, filter_order, step, f, fails, n, good, toxic, contains(fails, f) AS here, len(list_filter(earlier, lambda x: x <> '' AND contains(fails, x))) > 0 AS gone
  FROM counts, steps),
rows AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT here AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (here AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
    coalesce(sum(good) FILTER (here AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (here AND NOT gone), 0) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM rows
"""
