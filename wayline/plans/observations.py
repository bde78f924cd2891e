"""Queries over observations and units: what is missing, excluded, pooled."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.functions import observations, urls
from wayline.operators import units
from wayline.plans.catalog import query
from wayline.session import table

#: An observation made of a document, in words that both dialects read.
OBSERVED = {
    "id": "doc_id",
    "present": "doc_id % 13 <> 0",
    "url": "concat('https://', source, '.example/', lang)",
    "title": "CASE WHEN doc_id % 17 = 0 THEN 'Just a moment' ELSE lang END",
    "body": "CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 11 = 1 THEN '' ELSE text END",
    "preview": "CASE WHEN doc_id % 2 = 0 THEN substr(text, 1, 40) END",
    "truncated": "n_chars > 4000",
    "kept": "CASE WHEN doc_id % 11 <= 1 THEN 0 ELSE n_chars % 9 END",
    "total": "CASE WHEN doc_id % 3 = 0 THEN n_chars % 9 + doc_id % 2 END",
}
_OBS = "obs AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in OBSERVED.items()) + ", CASE doc_id % 10 WHEN 0 THEN ['links_missing', 'body_short'] WHEN 1 THEN ['navigation'] WHEN 2 THEN ['nav_cut'] ELSE [] END AS degraded FROM documents)"


def _observed(spark, sf_dir):
    listed = {0: ["links_missing", "body_short"], 1: ["navigation"], 2: ["nav_cut"]}
    empty = F.array().cast("array<string>")
    degraded = F.coalesce(*(F.when(F.col("doc_id") % 10 == k, F.array(*map(F.lit, v))) for k, v in listed.items()), empty)
    return table(spark, sf_dir, "documents").select(*(F.expr(e).alias(n) for n, e in OBSERVED.items()), degraded.alias("degraded"))


@query(f"WITH {_OBS} SELECT id, CASE WHEN present AND coalesce(body, '') = '' THEN CASE WHEN coalesce(preview, '') <> '' THEN 'body_preview_only' ELSE 'no_body' END ELSE '-' END AS missing FROM obs")
def p10_observation_missing(spark, sf_dir):
    rows = _observed(spark, sf_dir)
    return rows.select("id", F.coalesce(observations.missing_marker(F.col("present"), F.col("body"), F.col("preview")), F.lit("-")).alias("missing"))


@query(f"""
WITH {_OBS} SELECT id, CASE WHEN NOT present THEN 'none' WHEN len(degraded) > 0 THEN 'degraded' WHEN truncated THEN 'truncated' WHEN coalesce(nullif(total, 0), kept) > kept THEN 'elements_cropped'
  WHEN trim(coalesce(body, '')) = '' AND kept = 0 THEN 'empty' ELSE '' END AS reason FROM obs
""")
def p11_shortfall(spark, sf_dir):
    rows = _observed(spark, sf_dir)
    return rows.select("id", observations.shortfall(*(F.col(c) for c in ("present", "degraded", "truncated", "kept", "total", "body"))).alias("reason"))


@query(f"WITH {_OBS} SELECT a.id, coalesce(a.url = b.url AND a.kept = b.kept AND a.body = b.body, false) AS same FROM obs a JOIN obs b ON b.id = a.id + a.id % 2")
def p14_same_page(spark, sf_dir):
    """Every other observation and the next; the others and themselves."""
    rows = _observed(spark, sf_dir)
    each = F.explode(F.when(F.col("id") % 2 == 0, F.array(F.col("id"), F.col("id") - 1)).otherwise(F.array(F.lit(-1).cast("long"))))
    after = rows.select(each.alias("id"), *(F.col(c).alias(f"next_{c}") for c in ("url", "kept", "body")))
    names = ("url", "kept", "body")
    return rows.join(after, "id").select("id", observations.same_page([F.col(c) for c in names], [F.col(f"next_{c}") for c in names]).alias("same"))


@query(f"WITH {_OBS} SELECT id, list_has_any(degraded, ['links_missing', 'nav_cut']) AS blocked FROM obs")
def p31_blocks_candidates(spark, sf_dir):
    return _observed(spark, sf_dir).select("id", observations.blocks_candidates(F.col("degraded"), {"links_missing": "links", "nav_cut": "nav", "body_short": "body"}).alias("blocked"))


@query(f"""
WITH {_OBS} SELECT id, CASE WHEN NOT present THEN 'normal' WHEN contains(url, 's3.') OR contains(lower(title), 'moment') THEN CASE WHEN contains(lower(title), 'just a moment') THEN 'blocked_edge' ELSE 'captcha' END
  WHEN contains(lower(coalesce(body, '')), 'rate limit') OR contains(lower(coalesce(body, '')), 'licensed') THEN 'blocked_edge' WHEN id % 19 = 0 THEN 'dead_loop' WHEN contains(lower(coalesce(body, '')), 'password') THEN 'login_wall'
  WHEN contains(lower(coalesce(body, '')), 'token') THEN 'paywall' WHEN len(degraded) > 0 THEN 'degraded' ELSE 'normal' END AS verdict FROM obs
""")
def p16_page_verdict(spark, sf_dir):
    rows, body = _observed(spark, sf_dir), F.lower("body")
    words = {"urls": ["s3."], "titles": ["moment"], "limits": ["rate limit", "licensed"], "edge": ["just a moment"]}
    verdict = observations.page_verdict(F.col("present"), F.col("url"), F.lower("title"), body, F.col("id") % 19 == 0, F.contains(body, F.lit("password")), F.contains(body, F.lit("token")), F.col("degraded"), words)
    return rows.select("id", verdict.alias("verdict"))


@query(f"WITH {_OBS} SELECT id, md5(concat_ws(chr(10), url, title, body, array_to_string(degraded, chr(10)), preview)) AS bag FROM obs")
def f15_searchable(spark, sf_dir):
    bag = observations.searchable(F.col("url"), F.col("title"), F.col("body"), F.col("degraded"), F.when(F.col("preview").isNotNull(), F.array("preview")))
    return _observed(spark, sf_dir).select("id", F.md5(bag).alias("bag"))


_UNITS = """visited AS (SELECT user_id AS run, event_id % 5 AS unit, event_id AS place, event_type || '.host' || (event_id % 4) || '.example' AS host, event_id % 3 AS outcome, 'https://' || event_type AS url,
    CASE WHEN value < 60 THEN event_type END AS branch FROM events),
declared AS (SELECT DISTINCT user_id AS run, 'host' || (user_id % 4) || '.example' AS platform FROM events WHERE user_id % 2 = 0),
gone AS (SELECT run, unit, arg_min(platform, place) AS platform FROM visited JOIN declared USING (run) WHERE host = platform OR suffix(host, '.' || platform) GROUP BY run, unit),
out AS (SELECT DISTINCT run, unit * 10 + outcome AS outcome FROM visited JOIN gone USING (run, unit))"""


def _visited(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    host = F.concat("event_type", F.lit(".host"), (F.col("event_id") % 4).cast("string"), F.lit(".example"))
    unit = F.col("event_id") % 5
    places = rows.select(F.col("user_id").alias("run"), unit.alias("unit"), F.col("event_id").alias("place"), host.alias("host"), (unit * 10 + F.col("event_id") % 3).alias("outcome"), F.concat(F.lit("https://"), "event_type").alias("url"), F.when(F.col("value") < 60, F.col("event_type")).alias("branch"))
    declared = rows.where("user_id % 2 = 0").select(F.col("user_id").alias("run"), F.concat(F.lit("host"), (F.col("user_id") % 4).cast("string"), F.lit(".example")).alias("platform")).distinct()
    return places, units.excluded_units(places, declared, ["run"])


@query(f"WITH {_UNITS} SELECT * FROM gone")
def p4_excluded_units(spark, sf_dir):
    """Users as runs; every other one has declared a platform."""
    return _visited(spark, sf_dir)[1]


@query(f"WITH {_UNITS} SELECT run, CAST(count(*) AS BIGINT) AS n, string_agg(unit || '=' || platform, ',' ORDER BY unit) AS units FROM gone GROUP BY run")
def p5_excluded_unit_map(spark, sf_dir):
    found = _visited(spark, sf_dir)[1]
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit", "platform"))), lambda x: F.concat_ws("=", x["unit"].cast("string"), x["platform"])), ",")
    return found.groupBy("run").agg(F.count("*").alias("n"), listed.alias("units"))


@query(f"WITH {_UNITS} SELECT * FROM out")
def p6_excluded_outcomes(spark, sf_dir):
    places, found = _visited(spark, sf_dir)
    return units.excluded_outcomes(places, found, ["run"])


@query(f"""
WITH {_UNITS}, wanted AS (SELECT run, unit * 10 + outcome AS outcome, url, branch FROM visited WHERE branch IS NOT NULL AND branch NOT IN ('error'))
SELECT DISTINCT run, url, branch FROM wanted WHERE (run, url, branch) NOT IN (SELECT run, url, branch FROM wanted JOIN out USING (run, outcome))
""")
def p12_pool_members(spark, sf_dir):
    places, found = _visited(spark, sf_dir)
    return units.pool_members(places, units.excluded_outcomes(places, found, ["run"]), ["run"], ["error"])


@query(r"""
SELECT page_id, CASE WHEN NOT regexp_matches(link, '^https?://') THEN 'non_http_scheme' WHEN host = '' THEN 'no_host' WHEN host = 'go.example.com' AND path = '/r' THEN CASE WHEN regexp_matches(link, '[?&]url=http') THEN 'redirect_wrapper' ELSE '' END
  WHEN host = 'search.example.com' THEN 'engine_self' WHEN host = 'example.net' OR suffix(host, '.example.net') THEN 'excluded_host:example.net' WHEN host = 'example.org' OR suffix(host, '.example.org') THEN 'impossible_content:example.org'
  WHEN regexp_matches(path, '/(?:login|tag)/') THEN 'path_noise' WHEN regexp_matches(link, '[?&]url=http') THEN 'redirect_wrapper' ELSE '' END AS reason
FROM (SELECT page_id, link, lower(regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host, regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)(?::[0-9]*)?([^?#]*)', 2) AS path
  FROM (SELECT page_id, CASE page_id % 9 WHEN 0 THEN 'javascript:void(0)' WHEN 1 THEN 'https:///x' WHEN 2 THEN 'https://go.example.com/r?url=https%3A%2F%2Fa.b' WHEN 3 THEN 'https://go.example.com/r?u=1' WHEN 4 THEN 'https://search.example.com/' || page_id
    WHEN 5 THEN 'https://a.b/login/' || page_id WHEN 6 THEN 'https://a.b/c?k=1&url=https://x' ELSE url END AS link FROM pages))
""")
def p13_candidate_exclusion(spark, sf_dir):
    """Pages' urls, and links of the other kinds in place of some."""
    links = ["javascript:void(0)", "https:///x", "https://go.example.com/r?url=https%3A%2F%2Fa.b", "https://go.example.com/r?u=1", "https://search.example.com/", "https://a.b/login/", "https://a.b/c?k=1&url=https://x"]
    number = F.col("page_id") % 9
    made = F.coalesce(*(F.when(number == k, F.concat(F.lit(link), F.when(F.lit(k).isin(4, 5), F.col("page_id").cast("string")).otherwise(""))) for k, link in enumerate(links)), F.col("url"))
    reason = urls.exclusion_reason(made, "search.example.com", ("go.example.com", "/r"), ["example.net"], ["example.org"], "/(?:login|tag)/")
    return table(spark, sf_dir, "pages").select("page_id", reason.alias("reason"))


@query(r"SELECT page_id, CASE WHEN host = 'example.com' OR suffix(host, '.example.com') THEN 'example.com' WHEN host = 'example.net' OR suffix(host, '.example.net') THEN 'example.net' ELSE '' END AS root, CAST(page_id % 3 AS BIGINT) AS pick FROM (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host FROM pages)")
def g7_host_family(spark, sf_dir):
    root = urls.host_root(urls.host(F.col("url")), ["example.com", "example.net"])
    return table(spark, sf_dir, "pages").select("page_id", root.alias("root"), (F.col("page_id") % 3).alias("pick"))


@query()
def g10_rotation(spark, sf_dir):
    """One of three wordings for each task, by the checksum of its name."""
    words = ["watch online", "streaming sites", "full episodes"]
    return table(spark, sf_dir, "benchmark").select("item_id", urls.rotated(F.col("text"), words).alias("wording"))
