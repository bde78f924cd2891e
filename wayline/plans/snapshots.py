"""Queries over snapshots: labelled documents are rows, their lengths and languages scores and surfaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import snapshots
from wayline.plans.catalog import query
from wayline.session import table

CLASSES = {"success": "open", "trailer": "shut", "paywall": "shut", "blocked": "barred"}
FACES = {"d2": "code", "d3": "llm", "d4": "code"}
PROVENANCE = {"code": ("reproduced", "7"), "llm": ("diverged", "")}

_ROWS = """
told AS (
  SELECT 'd' || d.doc_id AS golden_id, n_chars AS n, source, lang, quality, toxic FROM documents d JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id),
rows AS (
  SELECT *, CASE WHEN n < 400 THEN 'regression' WHEN n > 4000 THEN 'holdout' ELSE 'calibration' END AS split,
    CASE WHEN quality = 1 THEN 'success' WHEN toxic = 1 THEN 'blocked' WHEN n % 2 = 0 THEN 'trailer' ELSE 'paywall' END AS gold_value,
    CASE WHEN lang = 'fr' THEN 'success' WHEN n % 3 = 0 THEN 'blocked' WHEN n % 5 = 0 THEN 'paywall' ELSE 'trailer' END AS pred_value,
    CASE WHEN n % 4 = 0 THEN NULL ELSE 'human' END AS gold_surface, CASE WHEN lang = 'de' THEN 'human' ELSE 'machine' END AS pred_surface,
    CASE WHEN n % 7 < 3 THEN 'x@code:9/llm:4' WHEN n % 7 = 3 THEN 'x@code:9' END AS scorer FROM told),
faced AS (SELECT *, CASE WHEN gold_surface IS NOT NULL THEN gold_surface = pred_surface END AS surface_comparable FROM rows),
soft AS (
  SELECT *, 'd2' AS dim, 1 + n % 5 AS g, 1 + (n // 7) % 5 AS p, 'code' AS face FROM faced
  UNION ALL SELECT *, 'd3', CASE WHEN n % 6 > 0 THEN n % 7 END, CASE WHEN n % 6 = 0 OR n % 11 > 2 THEN n % 6 END, 'llm' FROM faced WHERE n % 6 > 0 OR n % 6 = 0
  UNION ALL SELECT *, 'zz', NULL, 3, '' FROM faced WHERE lang = 'es'),
entries AS (
  SELECT golden_id, split, 'd10' AS dimension, gold_value, pred_value,
    CASE WHEN gold_value = pred_value THEN 'agree' WHEN gold_value IN ('trailer', 'paywall') AND pred_value IN ('trailer', 'paywall') THEN 'detail_mismatch' ELSE 'disagree' END AS verdict,
    CASE WHEN gold_value = pred_value THEN NULL WHEN gold_value IN ('trailer', 'paywall') AND pred_value IN ('trailer', 'paywall') THEN 'label_mismatch' ELSE 'equivalence_class_mismatch' END AS delta_kind,
    CAST(NULL AS INTEGER) AS tier_gap, 'collection' AS pred_face, 'unrecorded' AS pred_version, 'not_applicable' AS pred_status, gold_surface, pred_surface, surface_comparable FROM faced
  UNION ALL
  SELECT golden_id, split, dim, CAST(g AS VARCHAR), CAST(p AS VARCHAR), CASE WHEN face = '' OR g IS NULL OR p IS NULL OR g NOT BETWEEN 1 AND 5 OR p NOT BETWEEN 1 AND 5 THEN 'ungraded' WHEN abs(g - p) <= 1 THEN 'agree' ELSE 'tier_gap' END AS v,
    CASE WHEN v = 'tier_gap' THEN v END, CASE WHEN face <> '' THEN abs(g - p) END, face,
    CASE WHEN face = 'code' AND scorer IS NOT NULL THEN '9' WHEN face = 'llm' AND scorer = 'x@code:9/llm:4' THEN '4' WHEN face = 'code' THEN '7' ELSE 'unrecorded' END,
    CASE WHEN face = 'code' AND scorer IS NOT NULL OR face = 'llm' AND scorer = 'x@code:9/llm:4' THEN 'recorded' WHEN face = 'code' THEN 'reproduced' WHEN face = 'llm' THEN 'diverged' ELSE 'unrecorded' END,
    gold_surface, pred_surface, surface_comparable FROM soft),
differing AS (SELECT *, coalesce(NOT surface_comparable, false) AND pred_value = 'blocked' AS blocked FROM entries WHERE verdict IN ('disagree', 'detail_mismatch', 'tier_gap') AND split = 'calibration')"""


def _entries(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = table(spark, sf_dir, "documents").join(labels, "doc_id")
    n, lang = F.col("n_chars").cast("int"), F.col("lang")
    dims = lambda **scores: F.map_filter(F.map_from_arrays(F.array(*map(F.lit, scores)), F.array(*scores.values())), lambda _, v: v.isNotNull())
    nothing = F.lit(None).cast("int")
    rows = rows.select(
        F.concat(F.lit("d"), "doc_id").alias("golden_id"),
        F.when(n < 400, "regression").when(n > 4000, "holdout").otherwise("calibration").alias("split"),
        F.when(F.col("quality") == 1, "").when(F.col("toxic") == 1, "blocked").when(n % 2 == 0, "trailer").otherwise("paywall").alias("label"),
        F.when(lang == "fr", None).when(n % 3 == 0, "blocked").when(n % 5 == 0, "paywall").otherwise("trailer").alias("branch"),
        dims(d2=1 + n % 5, d3=F.when(n % 6 > 0, n % 7)).alias("gold_dims"),
        dims(d2=1 + F.floor(n / 7).cast("int") % 5, d3=F.when((n % 6 == 0) | (n % 11 > 2), n % 6), zz=F.when(lang == "es", F.lit(3)).otherwise(nothing)).alias("pred_dims"),
        F.when(n % 7 < 3, "x@code:9/llm:4").when(n % 7 == 3, "x@code:9").alias("scorer_version"),
        F.when(n % 4 == 0, None).otherwise("human").alias("gold_surface"),
        F.when(lang == "de", "human").otherwise("machine").alias("pred_surface"),
    )
    return snapshots.snapshot(rows, CLASSES, "success", FACES, provenance=PROVENANCE)


@query(f"WITH {_ROWS} SELECT * FROM entries")
def q16_snapshot(spark, sf_dir):
    """Gold against prediction for every label and every scored dimension."""
    return _entries(spark, sf_dir)


@query(f"""WITH {_ROWS}
SELECT 'v3:' || golden_id || ':' || dimension AS disagreement_id, 'open' AS status,
  CASE WHEN pred_status = 'diverged' THEN 'other' WHEN pred_version = 'unrecorded' THEN 'undetermined' WHEN (pred_face = 'code' AND pred_version = '9') OR (pred_face = 'llm' AND pred_version = '5') THEN 'same' ELSE 'other' END AS comparability,
  * EXCLUDE (blocked) FROM differing WHERE NOT blocked
""")
def q17_cards(spark, sf_dir):
    """What of it is to be triaged."""
    return snapshots.cards(_entries(spark, sf_dir), 3, ["blocked"], {"code": "9", "llm": "5"})


@query(f"""WITH {_ROWS}
SELECT 'v3:' || golden_id || ':collection' AS account_id, golden_id, split, gold_surface, pred_surface, string_agg(DISTINCT dimension, ',' ORDER BY dimension) AS dimensions, 'evidence_missing' AS bucket
FROM differing WHERE blocked GROUP BY golden_id, split, gold_surface, pred_surface
""")
def q17_accounts(spark, sf_dir):
    """Rows whose collection was blocked on another surface than the gold's."""
    return snapshots.accounts(_entries(spark, sf_dir), 3, ["blocked"]).withColumn("dimensions", F.array_join("dimensions", ","))
