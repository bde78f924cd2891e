"""Queries over golden versions: labelled documents are a version, all documents the candidates of the next."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import freezing
from wayline.plans.catalog import query
from wayline.session import table

_TABLES = """
told AS (
  SELECT 'd' || d.doc_id AS golden_id, source || '/' || (n_chars // 500) AS url, quality, toxic, lang, n_chars FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id),
previous AS (
  SELECT golden_id, CAST(NULL AS VARCHAR) AS golden_id_legacy, CASE WHEN n_chars < 500 THEN 'calibration' WHEN n_chars < 1500 THEN 'regression' ELSE 'holdout' END AS split, url,
    CASE WHEN quality = 1 THEN 'success' WHEN toxic = 1 THEN 'blocked' ELSE 'unresolved' END AS label, CASE WHEN toxic = 1 THEN 'blocked' WHEN n_chars > 3000 THEN 'paywall' END AS code, lang AS surface
  FROM told WHERE quality IS NOT NULL AND lang <> 'es'),
candidates AS (
  SELECT CASE WHEN lang = 'de' THEN 'e' || golden_id ELSE golden_id END AS golden_id, url, CASE WHEN quality = 1 THEN 'success' WHEN quality = 0 THEN 'blocked' END AS label,
    CASE WHEN n_chars > 2000 THEN 'paywall' WHEN n_chars < 300 THEN 'blocked' END AS code, lang AS surface FROM told),
alias AS (SELECT golden_id AS old, 'e' || golden_id AS new FROM told WHERE lang = 'de'),
moved AS (
  SELECT coalesce(a.new, p.golden_id) AS golden_id, CASE WHEN a.new IS NOT NULL THEN p.golden_id END AS golden_id_legacy, split, url, label, code, surface FROM previous p LEFT JOIN alias a ON a.old = p.golden_id),
carried AS (
  SELECT m.golden_id, golden_id_legacy, split, m.url, m.label, coalesce(c.code, m.code) AS code, m.surface, CASE WHEN c.code IS NOT NULL AND c.code IS DISTINCT FROM m.code THEN 'refreshed' ELSE 'carried' END AS origin
  FROM moved m LEFT JOIN candidates c ON c.golden_id = m.golden_id
  UNION ALL SELECT golden_id, NULL, 'holdout', url, label, code, surface, 'backfilled' FROM candidates c WHERE label IS NOT NULL AND NOT EXISTS (SELECT 1 FROM moved m WHERE m.golden_id = c.golden_id))"""


def _tables(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    told = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    told = told.select(F.concat(F.lit("d"), "doc_id").alias("golden_id"), F.concat_ws("/", "source", F.floor(F.col("n_chars") / 500)).alias("url"), "quality", "toxic", "lang", "n_chars")
    n = F.col("n_chars")
    previous = told.where("quality IS NOT NULL AND lang <> 'es'").select(
        "golden_id",
        F.lit(None).cast("string").alias("golden_id_legacy"),
        F.when(n < 500, "calibration").when(n < 1500, "regression").otherwise("holdout").alias("split"),
        "url",
        F.when(F.col("quality") == 1, "success").when(F.col("toxic") == 1, "blocked").otherwise("unresolved").alias("label"),
        F.when(F.col("toxic") == 1, "blocked").when(n > 3000, "paywall").alias("code"),
        F.col("lang").alias("surface"),
    )
    renamed = F.when(F.col("lang") == "de", F.concat(F.lit("e"), "golden_id")).otherwise(F.col("golden_id"))
    candidates = told.select(renamed.alias("golden_id"), "url", F.when(F.col("quality") == 1, "success").when(F.col("quality") == 0, "blocked").alias("label"), F.when(n > 2000, "paywall").when(n < 300, "blocked").alias("code"), F.col("lang").alias("surface"))
    alias = told.where("lang = 'de'").select(F.col("golden_id").alias("old"), F.concat(F.lit("e"), "golden_id").alias("new"))
    return previous, candidates, alias


def _carried(spark, sf_dir):
    previous, candidates, alias = _tables(spark, sf_dir)
    return previous, freezing.carried(previous, candidates, alias, ["code"], backfill="holdout")


@query(f"WITH {_TABLES} SELECT * FROM carried")
def q27_carried_rows(spark, sf_dir):
    """The next version: splits kept, ids renamed, codes refreshed, labelled candidates added."""
    return _carried(spark, sf_dir)[1]


@query(f"""WITH {_TABLES},
pairs AS (SELECT p.golden_id, p.code AS before, c.code AS after FROM previous p JOIN carried c ON c.golden_id = p.golden_id OR c.golden_id_legacy = p.golden_id)
SELECT golden_id, 'code' AS field, before, after FROM pairs WHERE before IS DISTINCT FROM after
""")
def q27_guards(spark, sf_dir):
    """What that version changes if no field may change."""
    return freezing.broken_guards(*_carried(spark, sf_dir))


_DIGEST = "md5(concat_ws('|', " + ", ".join(f"coalesce('=' || {c}, '-')" for c in freezing.COLUMNS) + "))"


@query(f"""WITH {_TABLES}, digests AS (SELECT split, {_DIGEST} AS h FROM carried),
lanes AS (SELECT split, count(*) AS n, bit_xor(CAST('0x' || h[1:15] AS BIGINT)) AS a, bit_xor(CAST('0x' || h[17:31] AS BIGINT)) AS b FROM digests GROUP BY split)
SELECT split, n, n || '-' || lower(to_hex(a)) || '-' || lower(to_hex(b)) AS fingerprint FROM lanes
""")
def q27_fingerprints(spark, sf_dir):
    return freezing.fingerprints(_carried(spark, sf_dir)[1])


@query(f"""WITH {_TABLES},
kinds AS (SELECT split, CASE WHEN label IN ('unresolved') OR coalesce(code, 'success') IN ('unresolved') THEN 'u' WHEN label = coalesce(code, 'success') THEN 'a' ELSE 'd' END AS kind FROM carried),
scoped AS (SELECT split AS scope, kind FROM kinds UNION ALL SELECT 'all', kind FROM kinds)
SELECT scope, count(*) AS total, count(*) FILTER (kind = 'a') AS agree, count(*) FILTER (kind = 'd') AS disagree, count(*) FILTER (kind = 'u') AS undetermined,
  CASE WHEN count(*) FILTER (kind <> 'u') > 0 THEN count(*) FILTER (kind = 'a') / count(*) FILTER (kind <> 'u') END AS ratio FROM scoped GROUP BY scope
""")
def q28_agreement(spark, sf_dir):
    """How far labels and codes of the version agree, by split."""
    return freezing.agreement(_carried(spark, sf_dir)[1], ["unresolved"])


@query(f"WITH {_TABLES} SELECT url, array_to_string(list_sort(list_distinct(array_agg(label))), ',') AS labels, count(*) AS n FROM carried GROUP BY url HAVING count(DISTINCT label) > 1")
def q28_url_conflicts(spark, sf_dir):
    return freezing.url_conflicts(_carried(spark, sf_dir)[1]).withColumn("labels", F.array_join("labels", ","))
