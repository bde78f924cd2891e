"""Queries over golden rows: users are trajectories, their events sites; labelled documents are cards."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import golden
from wayline.plans.catalog import query
from wayline.session import table

_SITES = """sites AS (SELECT user_id, event_id AS outcome_index, event_type AS branch, CASE WHEN event_id % 3 = 0 THEN 't' || user_id END AS task_id, CASE event_id % 4 WHEN 0 THEN 'calibration' WHEN 1 THEN 'holdout' WHEN 2 THEN 'other' END AS split FROM events)"""


def _trajectories(spark, sf_dir):
    split = F.coalesce(*(F.when(F.col("event_id") % 4 == k, s) for k, s in enumerate(["calibration", "holdout", "other"])))
    site = F.struct(F.col("event_id").alias("outcome_index"), F.col("event_type").alias("branch"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("t"), F.col("user_id").cast("string"))).alias("task_id"), F.lit(None).cast("string").alias("run_id"), split.alias("split"))
    name = lambda letter: F.concat(F.lit(letter), F.col("user_id").cast("string"))
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(site).alias("sites"), F.max("event_id").alias("last"))
    return rows.select("user_id", name("g").alias("golden_id"), name("task").alias("task_id"), name("run").alias("run_id"), "sites", F.when(F.col("user_id") % 3 == 1, -1).when(F.col("user_id") % 3 == 2, F.col("last")).alias("code_index"))


@query(f"WITH {_SITES} SELECT 'g' || user_id AS trajectory_id, outcome_index, branch, coalesce(task_id, 'task' || user_id) AS task_id, 'run' || user_id AS run_id, coalesce(split, '') AS split FROM sites")
def h20_site_views(spark, sf_dir):
    return golden.site_views(_trajectories(spark, sf_dir))


@query(f"""
WITH {_SITES}, c AS (SELECT user_id, CASE user_id % 3 WHEN 1 THEN -1 WHEN 2 THEN max(outcome_index) END AS code_index FROM sites GROUP BY user_id)
SELECT c.user_id, CASE WHEN split IN ('calibration', 'regression', 'holdout') THEN split ELSE '' END AS split FROM c LEFT JOIN sites s ON s.user_id = c.user_id AND outcome_index = code_index
""")
def h22_headline_split(spark, sf_dir):
    rows = _trajectories(spark, sf_dir)
    return rows.select("user_id", golden.headline_split(F.col("sites"), F.col("code_index"), ["calibration", "regression", "holdout"]).alias("split"))


@query("""
SELECT doc_id, array_to_string([x FOR x IN [CASE WHEN quality + 1 <= 2 THEN 'd4_failed' END, CASE WHEN doc_id % 5 > 0 AND doc_id % 5 <= 2 THEN 'd5_failed' END, CASE WHEN toxic = 1 THEN 'd6_failed' END, CASE WHEN toxic = 1 THEN 'veto' END] IF x IS NOT NULL], ',') AS tags FROM labels
""")
def q13_scout_tags(spark, sf_dir):
    score = lambda name, value, veto: F.struct(F.lit(name).alias("dimension"), value.cast("int").alias("score"), veto.alias("is_veto"))
    scores = F.array(score("d4", F.col("quality") + 1, F.lit(False)), score("d5", F.nullif(F.col("doc_id") % 5, F.lit(0)), F.lit(False)), score("d6", F.when(F.col("toxic") == 1, 1).otherwise(5), F.col("toxic") == 1))
    return table(spark, sf_dir, "labels").select("doc_id", F.array_join(golden.scout_tags(scores, 2), ",").alias("tags"))


@query("""
SELECT doc_id, CASE WHEN source = 'src1' THEN '-' WHEN doc_id % 7 = 0 THEN 'false' WHEN coalesce(pred, '') IN ('', 'unrecorded') OR cur = '' THEN '-' WHEN pred = cur THEN 'true' ELSE 'false' END AS comparable
FROM (SELECT *, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'unrecorded' WHEN 2 THEN '' ELSE lang END AS pred, CASE WHEN doc_id % 6 = 0 THEN '' ELSE 'en' END AS cur FROM documents)
""")
def q18_comparability(spark, sf_dir):
    n = F.col("doc_id")
    pred = F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, "unrecorded").when(n % 5 == 2, "").otherwise(F.col("lang"))
    told = golden.comparability(F.when(F.col("source") == "src1", "collection").otherwise("code"), F.when(n % 7 == 0, "diverged"), pred, F.when(n % 6 == 0, "").otherwise("en"))
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(told.cast("string"), F.lit("-")).alias("comparable"))


@query("""
WITH r AS (SELECT event_id, event_type AS gold, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'unknown' WHEN 2 THEN 'unverifiable' WHEN 3 THEN 'agree' WHEN 4 THEN 'maybe' ELSE 'disagree' END AS verdict,
  CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'not_applicable' WHEN 2 THEN 'view' ELSE event_type END AS branch, CASE WHEN event_id % 11 = 0 THEN 'holdout' ELSE 'calibration' END AS split, CASE WHEN event_id % 13 = 0 THEN 'other' ELSE event_type END AS annotated FROM events)
SELECT event_id, CASE WHEN split = 'holdout' THEN 'skip:holdout' WHEN coalesce(verdict, 'unknown') = 'unknown' THEN 'skip:not_reviewed' WHEN verdict = 'unverifiable' THEN 'skip:unverifiable' WHEN annotated <> gold THEN 'skip:label_drift'
  WHEN verdict = 'agree' THEN 'confirm:agree' WHEN verdict <> 'disagree' THEN 'skip:not_reviewed' WHEN branch = '' THEN 'skip:no_branch' WHEN branch = 'not_applicable' THEN 'skip:branch_not_applicable'
  WHEN branch = gold OR (branch IN ('click', 'view') AND gold IN ('click', 'view')) THEN 'confirm:equivalent' ELSE 'relabel:not_equivalent' END AS reading FROM r
""")
def q38_reflow(spark, sf_dir):
    n, kind = F.col("event_id"), F.col("event_type")
    verdict = F.when(n % 7 == 0, F.lit(None)).when(n % 7 == 1, "unknown").when(n % 7 == 2, "unverifiable").when(n % 7 == 3, "agree").when(n % 7 == 4, "maybe").otherwise("disagree")
    branch = F.when(n % 5 == 0, "").when(n % 5 == 1, "not_applicable").when(n % 5 == 2, "view").otherwise(kind)
    same = (branch == kind) | (branch.isin("click", "view") & kind.isin("click", "view"))
    told = golden.reflow_kind(verdict, branch, kind, F.when(n % 13 == 0, "other").otherwise(kind), F.when(n % 11 == 0, "holdout").otherwise("calibration"), same)
    return table(spark, sf_dir, "events").select("event_id", F.concat_ws(":", told["kind"], told["reason"]).alias("reading"))


@query("""
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'confirm:kept' WHEN page_id % 4 = 1 THEN '-:human' WHEN contains(url, '.org') OR contains(url, 'example.net') THEN 'confirm_not_play_site:auto_portal' ELSE 'need_browser:auto_insufficient' END AS reading FROM pages
""")
def q34_review_prefill(spark, sf_dir):
    n = F.col("page_id") % 4
    told = golden.review_prefill(F.when(n == 0, "confirm").when(n == 2, " "), F.when(n == 1, 3), F.col("url"), [".org", "example.net"])
    return table(spark, sf_dir, "pages").select("page_id", F.concat_ws(":", F.coalesce(told["verdict"], F.lit("-")), told["reviewed_by"]).alias("reading"))


_AGREED = """r AS (SELECT event_type AS label, CASE event_id % 4 WHEN 0 THEN 'click' WHEN 1 THEN 'purchase' WHEN 2 THEN event_type END AS branch, CASE event_id % 5 WHEN 0 THEN 'calibration' WHEN 1 THEN 'holdout' END AS split FROM events),
c AS (SELECT *, CASE label WHEN 'click' THEN 'use' WHEN 'view' THEN 'use' WHEN 'purchase' THEN 'pay' END AS a, CASE coalesce(branch, 'success') WHEN 'click' THEN 'use' WHEN 'view' THEN 'use' WHEN 'purchase' THEN 'pay' WHEN 'success' THEN 'pay' END AS b FROM r)"""


@query(f"""
WITH {_AGREED} SELECT 'all' AS scope, count(*) AS total, count(*) FILTER (label = branch) AS strict, count(*) FILTER (a = b) AS agree, count(*) FILTER (a IS NULL OR b IS NULL) AS unregistered, count(*) FILTER (a = b) / count(*) AS ratio FROM c
UNION ALL SELECT 'headline', count(*), count(*) FILTER (label = branch), count(*) FILTER (a = b), count(*) FILTER (a IS NULL OR b IS NULL), count(*) FILTER (a = b) / count(*) FROM c WHERE split = 'calibration'
""")
def a48_strict_and_class(spark, sf_dir):
    n, kind = F.col("event_id"), F.col("event_type")
    branch = F.when(n % 4 == 0, "click").when(n % 4 == 1, "purchase").when(n % 4 == 2, kind)
    rows = table(spark, sf_dir, "events").select(kind.alias("label"), branch.alias("branch"), F.when(n % 5 == 0, "calibration").when(n % 5 == 1, "holdout").alias("split"))
    return golden.class_agreement(rows, {"click": "use", "view": "use", "purchase": "pay", "success": "pay"}, "calibration")


@query("""
WITH m AS (SELECT unnest(list_concat(CASE WHEN doc_id % 2 = 0 THEN ['sample.no_body'] ELSE [] END, CASE WHEN doc_id % 3 = 0 THEN ['sample.cropped'] ELSE [] END, CASE WHEN doc_id % 5 = 0 THEN ['unit.no_body'] ELSE [] END)) AS marker, quality, toxic FROM labels)
SELECT marker, count(*) AS samples, count(*) FILTER (quality = 1) AS n_d4, count(*) FILTER (toxic = 1) AS n_d5 FROM m GROUP BY marker
""")
def a25_marker_counts(spark, sf_dir):
    n = F.col("doc_id")
    some = lambda k, name: F.when(n % k == 0, F.lit(name))
    rows = table(spark, sf_dir, "labels").select(F.array_compact(F.array(some(2, "no_body"), some(3, "cropped"))).alias("sample"), F.when(n % 5 == 0, F.array(F.lit("no_body"))).alias("unit"), (F.col("quality") == 1).alias("d4"), (F.col("toxic") == 1).alias("d5"))
    return golden.marker_counts(rows, ["sample", "unit"], ["d4", "d5"])


@query("""
SELECT event_id, label_before, label_after FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'Click' WHEN event_id % 3 = 1 THEN event_type END AS label_before, CASE coalesce(branch, 'success') WHEN 'click' THEN 'Click' WHEN 'success' THEN 'Done' ELSE branch END AS label_after,
  event_id % 4 < 2 AS stamped FROM (SELECT *, CASE WHEN event_type <> 'signup' THEN event_type END AS branch FROM events)) WHERE stamped AND label_before IS DISTINCT FROM label_after
""")
def p33_label_fixes(spark, sf_dir):
    n, kind = F.col("event_id"), F.col("event_type")
    rows = table(spark, sf_dir, "events").select("event_id", F.when(kind != "signup", kind).alias("branch"), F.when(n % 3 == 0, "Click").when(n % 3 == 1, kind).alias("branch_label"), F.when(n % 4 == 0, "x").alias("branch_before_downgrade"), F.when(n % 4 == 1, "y").alias("branch_before_relabel"))
    fixes = golden.label_fixes(rows, {"click": "Click", "success": "Done"}, ["branch_before_downgrade", "branch_before_relabel"])
    return fixes.select("event_id", "label_before", "label_after")


@query("""
WITH z AS (SELECT user_id, u, t, row_number() OVER (PARTITION BY user_id, u ORDER BY event_id) AS rn, event_id FROM (SELECT user_id, event_id, trim('https://' || event_type || event_id % 3 || ' ') AS u, trim(CASE WHEN event_id % 4 = 0 THEN ' ' ELSE 't' || event_id END) AS t FROM events) WHERE t <> '' AND user_id % 3 > 0)
SELECT user_id, string_agg(u || '=' || t, ',' ORDER BY event_id) AS titles FROM z WHERE rn = 1 GROUP BY user_id
UNION ALL SELECT DISTINCT user_id, '' FROM events WHERE user_id % 3 = 0
""")
def j22_titles_by_url(spark, sf_dir):
    """Titles and addresses of a user's events; every third user has one title too many."""
    title = F.when(F.col("event_id") % 4 == 0, " ").otherwise(F.concat(F.lit("t"), F.col("event_id").cast("string")))
    url = F.concat(F.lit("https://"), "event_type", (F.col("event_id") % 3).cast("string"), F.lit(" "))
    lists = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", url.alias("u"), title.alias("t")))).alias("x"))
    titles = F.when(F.col("user_id") % 3 == 0, F.array_append("x.t", F.lit("more"))).otherwise(F.col("x.t"))
    pairs = golden.titles_by_url(titles, F.col("x.u"))
    return lists.select("user_id", F.array_join(F.transform(pairs, lambda p: F.concat_ws("=", p["url"], p["title"])), ",").alias("titles"))


@query(r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines, CASE WHEN doc_id % 5 = 0 THEN [] ELSE [1, doc_id % 3 + 1] END AS picked FROM documents)
SELECT doc_id, CASE WHEN len(picked) = 0 THEN 'nothing' WHEN len([i FOR i IN range(1, len(lines) + 1) IF contains(lines[i], 'license')]) > 0 AND NOT list_has_any([i FOR i IN range(1, len(lines) + 1) IF contains(lines[i], 'license')], picked) THEN 'target_lost'
  WHEN len([i FOR i IN range(1, len(lines) + 1) IF contains(lines[i], 'the') OR contains(lines[i], 'die')]) > 0 AND NOT list_has_any([i FOR i IN range(1, len(lines) + 1) IF contains(lines[i], 'the') OR contains(lines[i], 'die')], picked) THEN 'focus_lost' ELSE '' END AS problem FROM l
""")
def h7_selection_problem(spark, sf_dir):
    n = F.col("doc_id")
    picked = F.when(n % 5 == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(1), (n % 3 + 1).cast("int")))
    words = lambda *w: F.array(*map(F.lit, w))
    problem = golden.selection_problem(picked, F.split("text", "\n", -1), words("the", "die", ""), words("license"))
    return table(spark, sf_dir, "documents").select("doc_id", problem.alias("problem"))


@query("SELECT doc_id AS golden_id, lang, source, quality FROM labels JOIN documents USING (doc_id)")
def j10_worklist(spark, sf_dir):
    cards = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("golden_id"), "quality")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("golden_id"), "lang", "source")
    return golden.worklist(cards, rows, ["lang", "source"])


@query("""
WITH d AS (SELECT doc_id, [CASE WHEN doc_id % 4 > 0 THEN 1 END, CASE WHEN doc_id % 3 > 0 THEN 1 END, CASE WHEN doc_id % 2 = 0 THEN 1 END] AS s, CASE WHEN doc_id % 3 > 0 AND doc_id % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 2 = 0 AND doc_id % 7 = 0 THEN 1 ELSE 0 END AS est, quality, toxic FROM labels),
n AS (SELECT *, len([x FOR x IN s IF x IS NOT NULL]) AS n FROM d)
SELECT doc_id, CASE WHEN n * 2 < 3 THEN '-' WHEN toxic = 1 AND doc_id % 4 > 0 THEN 'reject' WHEN quality = 0 AND doc_id % 3 > 0 THEN 'revise' ELSE 'accept' END AS decision, CASE WHEN n * 2 < 3 OR n <= 2 OR est >= 3 THEN 'low' WHEN est > 0 THEN 'medium' ELSE 'high' END AS confidence FROM n
""")
def a46_overall(spark, sf_dir):
    n = F.col("doc_id")

    def dimension(name, scored, estimated, score, non_pass):
        source = F.when(scored, F.when(estimated, "estimated").otherwise("measured")).otherwise("missing")
        return F.struct(F.lit(name).alias("id"), source.alias("source"), score.cast("double").alias("score"), non_pass.cast("int").alias("non_pass"))

    dims = F.array(dimension("redline", n % 4 > 0, F.lit(False), F.col("toxic"), F.lit(0)), dimension("criterion_coverage", n % 3 > 0, n % 5 == 0, F.lit(1), 1 - F.col("quality")), dimension("training_value", n % 2 == 0, n % 7 == 0, F.lit(0.3), F.lit(0)))
    told = golden.overall_decision(dims)
    return table(spark, sf_dir, "labels").select("doc_id", F.coalesce(told["decision"], F.lit("-")).alias("decision"), told["confidence"].alias("confidence"))


@query("""
SELECT event_id, CASE WHEN t NOT IN ('click', 'view', 'error') THEN 'no_question' WHEN q <> '' AND NOT list_contains(tq, q) THEN 'other_question' WHEN q <> '' OR list_has_any(fq, tq) THEN '' ELSE 'no_common_question' END AS problem
FROM (SELECT event_id, t, q, CASE t WHEN 'click' THEN ['q1', 'q2'] WHEN 'view' THEN ['q2'] WHEN 'error' THEN ['q3'] ELSE [] END AS tq, CASE event_type WHEN 'click' THEN ['q1', 'q2'] WHEN 'view' THEN ['q2'] WHEN 'error' THEN ['q3'] ELSE [] END AS fq
  FROM (SELECT event_id, event_type, CASE event_id % 4 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'error' ELSE 'signup' END AS t, CASE event_id % 5 WHEN 0 THEN 'q2' WHEN 1 THEN 'q3' ELSE '' END AS q FROM events))
""")
def p29_attribution(spark, sf_dir):
    n = F.col("event_id")
    target = F.when(n % 4 == 0, "click").when(n % 4 == 1, "view").when(n % 4 == 2, "error").otherwise("signup")
    asked = F.array(F.when(n % 5 == 0, "q2").when(n % 5 == 1, "q3").otherwise(""))
    problem = golden.attribution(asked, F.col("event_type"), target, {"click": ["q1", "q2"], "view": ["q2"], "error": ["q3"]})
    return table(spark, sf_dir, "events").select("event_id", problem.alias("problem"))
