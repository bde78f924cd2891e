"""Queries over gotos and what explains them: users are runs, their events steps that see or go to pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import prefixes
from wayline.plans.catalog import query
from wayline.session import table

_STEPS = r"""
steps AS (
  SELECT user_id AS run, event_id AS place, event_type AS kind, value, coalesce(url, '') AS page, split_part(coalesce(url, ''), '?', 1) AS bare
  FROM events LEFT JOIN pages ON page_id = CAST(json_extract_string(props, '$.k') AS BIGINT)),
anchors AS (SELECT run, place, page AS url FROM steps WHERE kind <> 'click' AND page <> ''),
gotos AS (
  SELECT run, place, CASE WHEN value < 1 THEN '' WHEN value < 5 THEN page WHEN value < 10 THEN upper(substr(page, 1, 10)) || substr(page, 11) WHEN value < 15 THEN bare || '/?' || split_part(page, '?', 2) ELSE 'http://elsewhere.example/' || place END AS url,
    CASE WHEN value < 20 THEN '' WHEN value < 30 THEN bare || '/more' WHEN value < 45 THEN left(bare, length(bare) - 3) WHEN value < 60 THEN regexp_replace(bare, '/[^/]*$', '/other') ELSE regexp_extract(bare, '^[a-z]+://[^/]*') || '/' END AS landed
  FROM steps WHERE kind = 'click')"""
_PARTS = r"""
parted AS (
  SELECT *, lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)) AS host,
    CASE WHEN rtrim(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') = '' THEN '/' ELSE rtrim(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') END AS path,
    regexp_extract({0}, '^[^?#]*\?([^#]*)', 1) AS rest FROM {1})"""
_TOLD = f"""
seen AS (WITH {_PARTS.format("url", "anchors")} SELECT * FROM parted), asked AS (WITH {_PARTS.format("url", "gotos")} SELECT * FROM parted),
landings AS (WITH {_PARTS.format("landed", "gotos")} SELECT run, place, host AS land, path AS landing FROM parted),
told AS (
  SELECT a.run, a.place, a.url, a.landed, CASE WHEN a.url <> '' THEN EXISTS (
    SELECT 1 FROM seen s WHERE s.run = a.run AND s.place < a.place AND (s.url = a.url OR (s.host <> '' AND s.host = a.host AND s.path = a.path AND s.rest = a.rest)
      OR (l.land <> '' AND s.host = l.land AND CASE WHEN s.path = '/' OR l.landing = '/' THEN s.path = l.landing ELSE starts_with(s.path, l.landing) OR starts_with(l.landing, s.path) END))) END AS traced
  FROM asked a JOIN landings l USING (run, place))"""


def _sides(spark, sf_dir):
    page = table(spark, sf_dir, "pages").select("page_id", "url")
    rows = table(spark, sf_dir, "events").withColumn("page_id", F.get_json_object("props", "$.k").cast("long")).join(page, "page_id", "left")
    whole = F.coalesce("url", F.lit(""))
    rows = rows.select(F.col("user_id").alias("run"), F.col("event_id").alias("at"), F.col("event_type").alias("kind"), "value", whole.alias("page"), F.split_part(whole, F.lit("?"), F.lit(1)).alias("bare"))
    anchors = rows.where("kind <> 'click' AND page <> ''").select("run", "at", F.col("page").alias("url"))
    value, page, bare = F.col("value"), F.col("page"), F.col("bare")
    url = (
        F.when(value < 1, "")
        .when(value < 5, page)
        .when(value < 10, F.concat(F.upper(F.substring(page, 1, 10)), F.substring(page, F.lit(11), F.length(page))))
        .when(value < 15, F.concat(bare, F.lit("/?"), F.split_part(page, F.lit("?"), F.lit(2))))
        .otherwise(F.concat(F.lit("http://elsewhere.example/"), "at"))
    )
    landed = (
        F.when(value < 20, "")
        .when(value < 30, F.concat(bare, F.lit("/more")))
        .when(value < 45, F.substring(bare, F.lit(1), F.greatest(F.length(bare) - 3, F.lit(0))))
        .when(value < 60, F.regexp_replace(bare, "/[^/]*$", "/other"))
        .otherwise(F.concat(F.regexp_extract(bare, "^[a-z]+://[^/]*", 0), F.lit("/")))
    )
    return anchors, rows.where("kind = 'click'").select("run", "at", url.alias("url"), landed.alias("landed"))


@query(f"WITH {_STEPS}, {_TOLD} SELECT run, place, url, landed, traced FROM told")
def q23_untraced_gotos(spark, sf_dir):
    """Whether something that its user saw earlier explains each goto."""
    return prefixes.untraced_gotos(*_sides(spark, sf_dir)).withColumnRenamed("at", "place")


@query(f"WITH {_STEPS}, {_TOLD} SELECT run, count(traced) AS checked, count(*) FILTER (traced) AS traced, count(*) FILTER (traced IS NULL) AS skipped, count(*) FILTER (NOT traced) AS violations FROM told GROUP BY run")
def q23_account(spark, sf_dir):
    return prefixes.trace_account(prefixes.untraced_gotos(*_sides(spark, sf_dir)))
