"""Composite queries: reports, asserts, snapshots, corrections."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.functions import urls
from wayline.operators import gates, metrics, selection, sequence
from wayline.plans.catalog import query
from wayline.session import table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query("""
SELECT key, CAST(sum(v) AS BIGINT) AS total FROM (SELECT unnest(json_keys(props)) AS key, CAST(json_extract_string(props, '$.' || unnest(json_keys(props))) AS BIGINT) AS v FROM events WHERE event_type <> 'error') GROUP BY key
""")
def a3_merged_counters(spark, sf_dir):
    """Counters of all runs merged; failed runs count for nothing."""
    rows = _events(spark, sf_dir).where("event_type <> 'error'").select(F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "v"))
    return rows.groupBy("key").agg(F.sum("v").alias("total"))


@query("SELECT event_type, median(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS median FROM events GROUP BY event_type")
def a7_stage_medians(spark, sf_dir):
    rows = _events(spark, sf_dir).withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return metrics.medians(rows, "k", "event_type").where("event_type is not null").select("event_type", "median")


_CLAUSES = """entries AS (SELECT doc_id, source AS clause, quality AS gold, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE CAST((doc_id // 3) % 2 AS INTEGER) END AS pred FROM documents JOIN labels USING (doc_id))"""


def _entries(spark, sf_dir):
    pred = F.when(F.col("doc_id") % 6 == 0, None).otherwise(F.floor(F.col("doc_id") / 3) % 2).cast("int")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("clause"))
    return docs.join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "clause", F.col("quality").alias("gold"), pred.alias("pred"))


@query(f"""WITH {_CLAUSES} SELECT clause, count(*) AS n, count(*) FILTER (pred IS NULL) AS ungraded, count(*) FILTER (pred = gold) AS agree, count(*) FILTER (pred <> gold) AS disagree,
  count(*) FILTER (pred <> gold) / count(*) AS rate, count(*) >= 20 AND count(*) FILTER (pred <> gold) / count(*) > 0.3 AS over FROM entries GROUP BY clause
""")
def a14_clause_stats(spark, sf_dir):
    """Verdicts per clause, and whether the rate of disagreement is over the line on enough rows."""
    state = gates.hard_agreement(F.col("gold"), F.col("pred"))
    count = lambda name: F.count(F.when(state == name, 1))
    out = _entries(spark, sf_dir).groupBy("clause").agg(F.count("*").alias("n"), count("pred_missing").alias("ungraded"), count("agree").alias("agree"), count("disagree").alias("disagree"))
    rate = F.col("disagree") / F.col("n")
    return out.withColumn("rate", rate).withColumn("over", (F.col("n") >= 20) & (rate > 0.3))


@query(f"""WITH {_CLAUSES}, s AS (SELECT clause, CASE WHEN pred IS NULL THEN 'pred_missing' WHEN pred = gold THEN 'agree' ELSE 'disagree' END AS verdict FROM entries)
SELECT coalesce(clause, '*') AS clause, coalesce(verdict, '*') AS verdict, count(*) AS n FROM s GROUP BY GROUPING SETS ((clause), (verdict), (clause, verdict), ())
""")
def q26_read_out(spark, sf_dir):
    """Verdicts by clause, by verdict, by both and over all."""
    rows = _entries(spark, sf_dir).select("clause", gates.hard_agreement(F.col("gold"), F.col("pred")).alias("verdict"))
    out = rows.groupingSets([["clause"], ["verdict"], ["clause", "verdict"], []], "clause", "verdict").agg(F.count("*").alias("n"))
    return out.select(F.coalesce("clause", F.lit("*")).alias("clause"), F.coalesce("verdict", F.lit("*")).alias("verdict"), "n")


@query("SELECT source, avg(CASE WHEN NOT regexp_matches(text, '[0-9]') THEN 1.0 ELSE 0.0 END) AS vague FROM documents WHERE n_chars > 0 GROUP BY source")
def a17_vague_rate(spark, sf_dir):
    """The share of texts that hold no marker."""
    return table(spark, sf_dir, "documents").where("n_chars > 0").groupBy("source").agg(F.avg((~F.col("text").rlike("[0-9]")).cast("double")).alias("vague"))


@query("""
SELECT user_id, CASE max(CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 2 WHEN 'click' THEN 1 ELSE 0 END * (value > 120)::INT) WHEN 3 THEN 'llm' WHEN 2 THEN 'no_client' WHEN 1 THEN 'data' ELSE '' END AS cause FROM events GROUP BY user_id
""")
def a23_cause(spark, sf_dir):
    """The gravest cause of each run; events of small value are no causes."""
    rank = F.when(F.col("event_type") == "error", 3).when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "click", 1).otherwise(0)
    name = F.element_at(F.array(*map(F.lit, ("", "data", "no_client", "llm"))), F.max(F.when(F.col("value") > 120, rank).otherwise(0)) + 1)
    return _events(spark, sf_dir).groupBy("user_id").agg(name.alias("cause"))


@query("""
SELECT event_type, coalesce(hour, -1) AS hour, count(*) AS checked, count(*) FILTER (value > 100) AS violations FROM (SELECT event_type, date_part('hour', ts) AS hour, value FROM events) GROUP BY ROLLUP (event_type, hour)
""")
def a28_trace_batch(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_type", F.hour("ts").cast("long").alias("hour"), "value")
    out = rows.rollup("event_type", "hour").agg(F.count("*").alias("checked"), F.count(F.when(F.col("value") > 100, 1)).alias("violations"))
    return out.withColumn("hour", F.coalesce("hour", F.lit(-1)))


@query("""
WITH ranked AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
SELECT user_id, least(count(*), 20) AS denominator, count(*) FILTER (rn <= 20 AND event_type <> 'view') AS covered, count(*) FILTER (rn <= 20 AND event_type <> 'view') / least(count(*), 20) AS coverage FROM ranked GROUP BY user_id
""")
def a30_candidate_coverage(spark, sf_dir):
    """How many of a run's first twenty candidates were visited."""
    rows = _events(spark, sf_dir).withColumn("rn", F.row_number().over(W.partitionBy("user_id").orderBy("event_id")))
    n = F.least(F.count("*"), F.lit(20))
    hit = F.count(F.when((F.col("rn") <= 20) & (F.col("event_type") != "view"), 1))
    return rows.groupBy("user_id").agg(n.alias("denominator"), hit.alias("covered"), metrics.ratio(hit, n).alias("coverage"))


@query("""
SELECT event_type, count(*) FILTER (NOT list_contains(json_keys(props), 'k')) AS empty, count(*) FILTER (list_contains(json_keys(props), 'k') AND json_extract_string(props, '$.k') IS NULL) AS judged_na,
  count(*) FILTER (json_extract_string(props, '$.k') IS NOT NULL) AS filled FROM events GROUP BY event_type
""")
def a35_key_coverage(spark, sf_dir):
    """A key that is absent, null or filled: three different things."""
    props = F.from_json("props", "map<string,string>")
    has, value = F.map_contains_key(props, F.lit("k")), F.try_element_at(props, F.lit("k"))
    return _events(spark, sf_dir).groupBy("event_type").agg(F.count(F.when(~has, 1)).alias("empty"), F.count(F.when(has & value.isNull(), 1)).alias("judged_na"), F.count(F.when(value.isNotNull(), 1)).alias("filled"))


_SCORES = """parts AS (SELECT conv_id, count(*) AS n, count(*) FILTER (role = 'assistant') / count(*) AS a, least(sum(length(text)) / 2000.0, 1) AS len, CASE WHEN bool_or(regexp_matches(text, '[0-9]')) THEN 1.0 ELSE 0.0 END AS d FROM conversations GROUP BY conv_id),
scored AS (SELECT conv_id, 0.5 * a + 0.3 * len + 0.2 * d AS score FROM parts)"""


def _quality(spark, sf_dir):
    part = F.count(F.when(F.col("role") == "assistant", 1)) / F.count("*")
    size = F.least(F.sum(F.length("text")) / 2000.0, F.lit(1.0))
    digits = F.max(F.col("text").rlike("[0-9]").cast("double"))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg((0.5 * part + 0.3 * size + 0.2 * digits).alias("score"))


@query(f"WITH {_SCORES} SELECT conv_id, score, CASE WHEN score >= 0.7 THEN 'easy' WHEN score >= 0.4 THEN 'medium' ELSE 'hard' END AS tier FROM scored")
def a39_quality(spark, sf_dir):
    """Weighted quality of each session and its tier."""
    return _quality(spark, sf_dir).withColumn("tier", F.when(F.col("score") >= 0.7, "easy").when(F.col("score") >= 0.4, "medium").otherwise("hard"))


@query(f"WITH {_SCORES} SELECT conv_id, CAST(greatest(1, least(5, round_even(1 + 4 * score, 0))) AS BIGINT) AS sub FROM scored")
def a41_sub_scores(spark, sf_dir):
    """Scores from 0 to 1 as 1 to 5, halves to even."""
    return _quality(spark, sf_dir).select("conv_id", F.greatest(F.lit(1), F.least(F.lit(5), F.bround(1 + 4 * F.col("score"), 0))).cast("long").alias("sub"))


@query("""
SELECT a.doc_id, CASE WHEN a.url IS NOT NULL THEN 'index' WHEN b.doc IS NOT NULL THEN 'url' ELSE 'none' END AS by FROM (
  SELECT d.doc_id, l.doc_id AS url, 'u' || (d.doc_id % 83) AS key FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) a
LEFT JOIN (SELECT 'u' || (doc_id % 179) AS key, max(doc_id) AS doc FROM labels GROUP BY 1) b USING (key)
""")
def j18_overlay(spark, sf_dir):
    """Sites meet views by index first, else by the last view of their url."""
    labels = table(spark, sf_dir, "labels").select("doc_id")
    sites = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("u"), (F.col("doc_id") % 83).cast("string")).alias("key"))
    by_index = labels.distinct().withColumn("by_index", F.lit(True))
    by_url = labels.groupBy(F.concat(F.lit("u"), (F.col("doc_id") % 179).cast("string")).alias("key")).agg(F.max("doc_id").alias("doc"))
    rows = sites.join(by_index, "doc_id", "left").join(by_url, "key", "left")
    return rows.select("doc_id", F.when(F.col("by_index"), "index").when(F.col("doc").isNotNull(), "url").otherwise("none").alias("by"))


@query("""
WITH calls AS (SELECT *, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM events)
SELECT c.event_id AS call, min(r.event_id) AS result FROM calls c JOIN calls r ON c.user_id = r.user_id AND c.island = r.island AND r.event_id > c.event_id WHERE c.event_type = 'click' AND r.event_type = 'purchase' GROUP BY c.event_id
""")
def j23_call_results(spark, sf_dir):
    """Each call with the first later result before the stretch ends."""
    w = W.partitionBy("user_id").orderBy("event_id")
    rows = _events(spark, sf_dir).select("event_id", "user_id", "event_type").withColumn("island", F.sum((F.col("event_type") == "view").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    after = W.partitionBy("user_id", "island").orderBy(F.desc("event_id")).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("result", F.min(F.when(F.col("event_type") == "purchase", F.col("event_id"))).over(after))
    return rows.where("event_type = 'click' and result is not null").select(F.col("event_id").alias("call"), "result")


@query("""
WITH p AS (SELECT DISTINCT source FROM documents), s AS (SELECT DISTINCT event_type FROM events) SELECT source, event_type FROM p, s WHERE NOT (source = 'src1' AND event_type IN ('click', 'error')) AND NOT (source = 'src2' AND event_type = 'view')
""")
def j19_compatible_pairs(spark, sf_dir):
    """Personas with the skeletons they go with: both are catalogs of a few entries, so every persona carries all."""
    kinds = _events(spark, sf_dir).agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    pairs = table(spark, sf_dir, "documents").select("source").distinct().withColumn("_k", F.lit(1)).join(kinds.withColumn("_k", F.lit(1)), "_k")
    bad = spark.createDataFrame([("src1", "click"), ("src1", "error"), ("src2", "view")], "source string, event_type string")
    return pairs.select("source", F.explode("kinds").alias("event_type")).join(F.broadcast(bad), ["source", "event_type"], "left_anti")


@query("""
WITH f AS (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY 1, 2), e AS (SELECT * FROM events WHERE value > 90)
SELECT e.event_id, count(f.event_type) AS known FROM e LEFT JOIN f ON f.user_id = e.user_id AND f.first < e.event_id GROUP BY e.event_id
""")
def w11_running_anchors(spark, sf_dir):
    """How many different anchors a run had shown before each step: a running count of first sightings."""
    first = F.row_number().over(W.partitionBy("user_id", "event_type").orderBy("event_id")) == 1
    rows = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "value").withColumn("fresh", first.cast("long"))
    known = F.sum("fresh").over(W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn("known", F.coalesce(known, F.lit(0))).where("value > 90").select("event_id", "known")


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS step FROM conversations WHERE role <> 'system'")
def w15_flat_steps(spark, sf_dir):
    rank = F.row_number().over(W.partitionBy("conv_id").orderBy("turn")) - 1
    return table(spark, sf_dir, "conversations").where("role <> 'system'").select("conv_id", "turn", rank.cast("long").alias("step"))


@query("SELECT key, string_agg(side, '+' ORDER BY side) AS sides FROM (SELECT DISTINCT 'u' || (doc_id % 700) AS key, 'a' AS side FROM documents UNION SELECT DISTINCT 'u' || (doc_id % 900), 'b' FROM labels) GROUP BY key")
def u3_sides(spark, sf_dir):
    """Keys of two corpora: in one, the other or both."""
    key = lambda df, n, side: df.select(F.concat(F.lit("u"), (F.col("doc_id") % n).cast("string")).alias("key"), F.lit(side).alias("side")).distinct()
    rows = key(table(spark, sf_dir, "documents"), 700, "a").unionByName(key(table(spark, sf_dir, "labels"), 900, "b"))
    return rows.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("side")), "+").alias("sides"))


@query("""
WITH a AS (SELECT doc_id, 'archive' AS origin FROM documents WHERE lang <> 'en'), p AS (SELECT doc_id, 'pool' AS origin FROM labels) SELECT * FROM a UNION ALL SELECT * FROM p WHERE doc_id NOT IN (SELECT doc_id FROM a)
""")
def u1_candidate_union(spark, sf_dir):
    """Archives, and pool rows that are in none."""
    a = table(spark, sf_dir, "documents").where("lang <> 'en'").select("doc_id", F.lit("archive").alias("origin"))
    return a.unionByName(table(spark, sf_dir, "labels").join(a, "doc_id", "left_anti").select("doc_id", F.lit("pool").alias("origin")))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'skip' WHEN value IS NULL OR event_id % 13 = 0 THEN 'quarantine' WHEN event_type = 'view' OR value <= 20 THEN 'negative' ELSE 'positive' END AS bucket FROM events
""")
def q12_buckets(spark, sf_dir):
    kind = F.col("event_type")
    rows = _events(spark, sf_dir).select("event_id", F.when(kind == "error", "failed").alias("reason"), (F.col("event_id") % 13 == 0).alias("undetermined"), (kind == "view").alias("veto"), F.when(F.col("value") <= 20, 1).otherwise(5).alias("min_score"))
    return gates.scout_bucket(rows).select("event_id", "bucket")


@query("""
WITH c AS (SELECT * FROM events WHERE event_id % 2 = 0), d AS (SELECT * FROM events WHERE event_id % 2 = 1),
a AS (SELECT event_type AS branch, count(*) / (SELECT count(*) FROM c) AS a FROM c GROUP BY 1), b AS (SELECT event_type AS branch, count(*) / (SELECT count(*) FROM d) AS b FROM d GROUP BY 1)
SELECT branch, coalesce(a, 0) AS a, coalesce(b, 0) AS b, abs(coalesce(a, 0) - coalesce(b, 0)) > 0.05 AS over FROM a FULL JOIN b USING (branch)
""")
def q22_dual_run(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", F.col("event_type").alias("branch"))
    return gates.dual_run(rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1"))


@query("""
SELECT event_id, CASE WHEN value > 100 THEN 'unresolved' ELSE branch END AS branch, CASE WHEN value > 100 THEN '[was ' || coalesce(branch, 'success') || '] ' || props ELSE props END AS evidence, coalesce(CASE WHEN value > 100 THEN coalesce(branch, 'success') END, '-') AS before
FROM (SELECT *, nullif(event_type, 'purchase') AS branch FROM events)
""")
def q31_downgrade(spark, sf_dir):
    """Outcomes with the weak ones set back, what they were first being kept."""
    rows = _events(spark, sf_dir).select("event_id", "value", F.nullif("event_type", F.lit("purchase")).alias("branch"), F.col("props").alias("evidence"), F.lit(None).cast("string").alias("branch_before"))
    out = gates.downgraded(gates.downgraded(rows, F.col("value") > 100, "unresolved"), F.col("value") > 100, "blocked")
    return out.select("event_id", "branch", "evidence", F.coalesce("branch_before", F.lit("-")).alias("before"))


@query("""
SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN a IS NULL AND b IS NULL THEN 'both_silent' WHEN a IS NULL OR b IS NULL THEN 'one_silent' WHEN a = b THEN 'agree' ELSE 'diverge' END AS verdict
FROM (SELECT CASE WHEN value < 10 THEN NULL ELSE event_type END AS a, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 'click' ELSE event_type END AS b FROM events)) GROUP BY verdict
""")
def q37_replay(spark, sf_dir):
    """Two perceptions of the same pages: agreement, divergence and silence."""
    k = F.col("event_id") % 4
    rows = _events(spark, sf_dir).select(F.when(F.col("value") >= 10, F.col("event_type")).alias("a"), F.when(k == 1, "click").when(k != 0, F.col("event_type")).alias("b"))
    a, b = F.col("a"), F.col("b")
    verdict = F.when(a.isNull() & b.isNull(), "both_silent").when(a.isNull() | b.isNull(), "one_silent").when(a == b, "agree").otherwise("diverge")
    return rows.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("""
SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)password|secret|token') THEN 'reject' WHEN n_chars < 100 THEN 'repair' WHEN n_chars > 15000 THEN 'prune' ELSE 'accept' END AS decision FROM documents
""")
def q40_policy(spark, sf_dir):
    rules = [("reject", F.col("text").rlike("(?i)password|secret|token")), ("repair", F.col("n_chars") < 100), ("prune", F.col("n_chars") > 15000)]
    return table(spark, sf_dir, "documents").select("doc_id", gates.first_rule(rules, "accept").alias("decision"))


@query("""
SELECT user_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS ok, count(*) AS n, greatest(0, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) / count(*) - 0.01 * count(*) FILTER (event_type = 'error')) AS health FROM events GROUP BY user_id
""")
def a43_health(spark, sf_dir):
    ok = F.count(F.when(F.col("event_type") == "purchase", 1))
    penalty = 0.01 * F.count(F.when(F.col("event_type") == "error", 1))
    return _events(spark, sf_dir).groupBy("user_id").agg(ok.alias("ok"), F.count("*").alias("n"), F.greatest(F.lit(0.0), ok / F.count("*") - penalty).alias("health"))


@query("""
WITH h AS (SELECT 'u' || (doc_id % 41) AS url, quality AS label, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE toxic END AS code FROM labels)
SELECT url, count(*) AS n, count(*) FILTER (code = label) AS agree, count(*) FILTER (code IS NULL) AS silent, count(*) FILTER (code = label) / nullif(count(*) FILTER (code IS NOT NULL), 0) AS agreement FROM h GROUP BY url
""")
def a48_class_agreement(spark, sf_dir):
    """Agreement per url; silence leaves the denominator, and a url of silence alone has none."""
    rows = table(spark, sf_dir, "labels").select(F.concat(F.lit("u"), (F.col("doc_id") % 41).cast("string")).alias("url"), F.col("quality").alias("label"), F.when(F.col("doc_id") % 3 != 0, F.col("toxic")).alias("code"))
    out = metrics.three_state(rows, ["url"], F.col("label"), F.col("code"), F.col("code").isNull())
    return out.select("url", "n", "agree", F.col("undetermined").alias("silent"), "agreement")


@query(r"""
WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)<a href="([^"]*)"', 1)) AS href FROM pages)
SELECT page_id, count(*) AS links, count(DISTINCT href) AS different FROM l WHERE href <> '#' AND NOT starts_with(href, 'javascript:') GROUP BY page_id
""")
def t4_links(spark, sf_dir):
    """Links of each page that lead anywhere."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('(?i)<a href="([^"]*)"'), F.lit(1))).alias("href"))
    rows = rows.where((F.col("href") != "#") & ~F.startswith("href", F.lit("javascript:")))
    return rows.groupBy("page_id").agg(F.count("*").alias("links"), F.countDistinct("href").alias("different"))


def g6_absolute_links(spark, sf_dir):
    """Links of each page as absolute urls, by host; no SQL has urljoin."""
    from wayline.functions.python import absolute_url

    rows = table(spark, sf_dir, "pages").select("url", F.explode(F.regexp_extract_all("html", F.lit('(?i)<a href="([^"]*)"'), F.lit(1))).alias("href"))
    host = urls.host(absolute_url("url", "href"))
    return rows.groupBy(host.alias("host")).agg(F.count("*").alias("links"))


query()(g6_absolute_links)


def w9_similar_runs(spark, sf_dir):
    """The longest run of neighbouring messages of one role that are alike; no SQL has the ratio of matching blocks."""
    from wayline.functions.python import alike

    w = W.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("before", F.when(F.col("role") == F.lag("role").over(w), F.lag("text").over(w)))
    rows = rows.select("conv_id", "turn", alike("before", "text").alias("alike"))
    runs = sequence.islands(rows, ["conv_id"], ["turn"], F.sum((~F.col("alike")).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy("conv_id").agg((F.max("place") + 1).alias("longest"))


query()(w9_similar_runs)


@query("""
WITH s AS (SELECT event_id, event_type AS stratum, count(*) OVER (PARTITION BY event_type) AS population, row_number() OVER (PARTITION BY event_type ORDER BY sha256('x4' || chr(1) || event_id), event_id) AS rn FROM events)
SELECT stratum, max(population) AS population, count(*) AS drawn, greatest(40 - max(population), 0) AS short_by FROM s WHERE rn <= 40 GROUP BY stratum
""")
def x4_sample_account(spark, sf_dir):
    """What a stratified sample drew, and by how much strata fell short."""
    drawn = selection.draw(_events(spark, sf_dir).select("event_id", F.col("event_type").alias("stratum")), ["stratum"], 40, "x4", ["event_id"])
    return drawn.groupBy("stratum").agg(F.max("population").alias("population"), F.count("*").alias("drawn"), F.greatest(40 - F.max("population"), F.lit(0)).alias("short_by"))
