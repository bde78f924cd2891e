"""Queries over urls, hashes and predicates on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.functions import text, urls
from wayline.operators import matching, sequence
from wayline.plans.catalog import query
from wayline.session import table

_P = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)(?::[0-9]*)?([^?#]*)(?:\?([^#]*))?"
_HOST, _PATH, _QUERY = (f"regexp_extract(url, '{_P}', {k})" for k in (1, 2, 3))
EXCLUDED = ("free-bets.example.com", "example.org")


@query(f"""
SELECT page_id, lower({_HOST}) || '|' || regexp_replace({_PATH}, '/+$', '') AS landing, regexp_replace(lower({_HOST}), '^www\\.', '') || '|' || regexp_replace({_PATH}, '/+$', '') AS page_key,
  lower({_HOST}) || '|' || regexp_replace({_PATH}, '/+$', '') || '?' || {_QUERY} AS trace_key, {_PATH} IN ('', '/') AS homepage FROM pages
""")
def g1_page_identities(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.landing_identity(url).alias("landing"), urls.page_key(url).alias("page_key"), urls.trace_key(url).alias("trace_key"), urls.is_homepage(url).alias("homepage"))


@query(f"""
SELECT page_id, lower({_HOST}) AS host, lower({_HOST}) = 'example.org' OR lower({_HOST}) LIKE '%.example.org' OR lower({_HOST}) = 'free-bets.example.com' OR lower({_HOST}) LIKE '%.free-bets.example.com' AS excluded
FROM pages
""")
def p3_excluded_platforms(spark, sf_dir):
    host = urls.host(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", host.alias("host"), urls.in_domains(host, EXCLUDED).alias("excluded"))


@query("""
SELECT page_id, substr(md5(url), 1, 8) AS url_hash, substr(sha256(html), 1, 16) AS body_key, CAST(('0x' || substr(sha256(url), 1, 2)) AS INTEGER) % 3 AS pick FROM pages
""")
def g8_hashes(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.url_hash(F.col("url")).alias("url_hash"), urls.body_key(F.col("html")).alias("body_key"), urls.pick(F.col("url"), 3).alias("pick"))


@query(r"""
WITH linked AS (SELECT page_id, url, 'http://go.example.com/?a=1&url=' || replace(replace(url, ':', '%3A'), '/', '%2F') AS link FROM pages)
SELECT page_id, CASE WHEN regexp_matches(t, '^https?://') THEN t ELSE link END AS target
FROM (SELECT page_id, link, url_decode(replace(regexp_extract(regexp_extract(link, '\?([^#]*)', 1), '(?:^|&)url=([^&]*)', 1), '+', '%2B')) AS t FROM linked)
""")
def g5_redirects(spark, sf_dir):
    link = F.concat(F.lit("http://go.example.com/?a=1&url="), F.replace(F.replace("url", F.lit(":"), F.lit("%3A")), F.lit("/"), F.lit("%2F")))
    return table(spark, sf_dir, "pages").select("page_id", urls.redirect_target(link).alias("target"))


@query(f"""
WITH p AS (SELECT page_id, lower({_HOST}) AS host, regexp_replace({_PATH}, '/+$', '') AS path FROM pages)
SELECT a.page_id, a.host = b.host AND (a.path = b.path OR (a.path <> '' AND starts_with(b.path, a.path || '/'))) AS landed FROM p a JOIN p b ON b.page_id = a.page_id + 1
""")
def g2_landed(spark, sf_dir):
    """Whether a visit to each page would count as landed on the next one."""
    a = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("target"))
    b = table(spark, sf_dir, "pages").select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("seen"))
    return a.join(b, "page_id").select("page_id", urls.landed(F.col("target"), F.col("seen")).alias("landed"))


@query("SELECT event_type || chr(1) || string_agg(k || '=' || json_extract_string(props, '$.' || k), chr(1) ORDER BY k) AS signature, event_id FROM (SELECT event_id, event_type, props, unnest(json_keys(props)) AS k FROM events) GROUP BY event_id, event_type")
def g12_action_signature(spark, sf_dir):
    params = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", urls.action_signature(F.col("event_type"), params).alias("signature"))


@query("""
SELECT era, event_type, count(*) AS n FROM (SELECT event_type, CASE WHEN day >= '2024-01-20' THEN 'e2' WHEN day >= '2024-01-10' THEN 'e1' WHEN day >= '2000-01-01' THEN 'e0' END AS era
FROM (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day FROM events)) GROUP BY era, event_type
""")
def a5_era_distribution(spark, sf_dir):
    eras = spark.createDataFrame([("e0", "2000-01-01"), ("e1", "2024-01-10"), ("e2", "2024-01-20")], "era string, since string")
    rows = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return matching.era_of(rows, eras, "day").groupBy("era", "event_type").agg(F.count("*").alias("n"))


@query(f"""
WITH p AS (SELECT page_id, lower({_HOST}) AS host FROM pages)
SELECT page_id, host, host = '' OR row_number() OVER (PARTITION BY host ORDER BY page_id) <= 2 AS admitted FROM p
""")
def w19_host_quota(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("host"))
    return sequence.admitted(rows, [], "host", ["page_id"], 2)


@query(f"""
WITH p AS (SELECT page_id, lower({_HOST}) AS host, {_PATH} IN ('', '/') AS home FROM pages),
firsts AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS rn FROM p)
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN host = '' THEN 'bad_url' WHEN home THEN 'homepage' WHEN host = 'example.org' OR host LIKE '%.example.org' THEN 'excluded' WHEN rn > 1 THEN 'same_host' ELSE 'kept' END AS reason FROM firsts) GROUP BY reason
""")
def t7_candidate_reasons(spark, sf_dir):
    """Why candidates are dropped, the first reason counting."""
    rows = table(spark, sf_dir, "pages").select("page_id", "url", urls.host(F.col("url")).alias("host"))
    rows = sequence.admitted(rows, [], "host", ["page_id"], 1)
    reason = F.when(F.col("host") == "", "bad_url").when(urls.is_homepage(F.col("url")), "homepage").when(urls.in_domains(F.col("host"), ["example.org"]), "excluded").when(~F.col("admitted"), "same_host").otherwise("kept")
    return rows.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(f"""
WITH p AS (SELECT DISTINCT lower({_HOST}) AS host, regexp_replace({_PATH}, '\\.html$', '') AS path FROM pages),
t AS (SELECT DISTINCT host, CASE WHEN path = '' THEN '/' ELSE path END AS s FROM p)
SELECT count(*) AS pairs, count(DISTINCT a.host) AS hosts FROM t a JOIN t b ON a.host = b.host AND CASE WHEN a.s = '/' OR b.s = '/' THEN a.s = b.s ELSE starts_with(a.s, b.s) OR starts_with(b.s, a.s) END
""")
def j17_prefix_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(urls.host(F.col("url")).alias("host"), F.regexp_replace(urls.path(F.col("url")), r"\.html$", "").alias("path")).distinct()
    pairs = matching.prefix_pairs(rows, rows)
    return pairs.agg(F.count("*").alias("pairs"), F.countDistinct("host").alias("hosts"))


@query(r"SELECT doc_id, split_part(regexp_replace('[was ' || lang || '] ' || text, '^\[was [^\]]*\]\s*', ''), chr(10), 1) AS evidence FROM documents")
def f32_base_evidence(spark, sf_dir):
    marked = F.concat(F.lit("[was "), F.col("lang"), F.lit("] "), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.base_evidence(marked).alias("evidence"))
