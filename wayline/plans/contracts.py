"""Queries over scores, screens, contracts and batches: users are runs, their events steps."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.functions import urls
from wayline.operators import contracts, gates, scoring
from wayline.plans.catalog import query
from wayline.session import table


def _check(kind, tier):
    return F.struct(kind.alias("kind"), F.lit(tier).alias("tier"))


_KIND = "CASE {n} % 7 WHEN 0 THEN 'wrong' WHEN 3 THEN 'undetermined' ELSE 'right' END"


def _kind(n):
    return F.when(n % 7 == 0, "wrong").when(n % 7 == 3, "undetermined").otherwise("right")


@query(f"""
WITH c AS (SELECT doc_id, doc_id % 11 > 0 AS has, {_KIND.format(n='doc_id')} AS a, {_KIND.format(n='(doc_id // 2)')} AS b, {_KIND.format(n='(doc_id // 3)')} AS c, {_KIND.format(n='(doc_id // 5)')} AS d FROM documents),
w AS (SELECT *, (a = 'wrong')::INT + (b = 'wrong')::INT + (c = 'wrong')::INT + (d = 'wrong')::INT AS wrong, 'undetermined' IN (a, b, c, d) AS open FROM c),
s AS (SELECT doc_id, CASE WHEN has THEN CASE WHEN wrong > 0 THEN CASE WHEN a = 'wrong' OR wrong >= 2 THEN 1 WHEN b = 'wrong' THEN 2 WHEN c = 'wrong' THEN 4 ELSE 3 END WHEN NOT open THEN 5 END END AS score FROM w)
SELECT doc_id, coalesce(score, 0) AS score, CASE WHEN score IS NULL THEN 'undetermined' ELSE 'scored' END AS kind FROM s
""")
def q9_component_score(spark, sf_dir):
    """Four checks of each document, of the tiers skip_record, direction, premature and other."""
    n = F.col("doc_id")
    part = lambda k: F.floor(n / k)
    checks = F.array(_check(_kind(n), "skip_record"), _check(_kind(part(2)), "direction"), _check(_kind(part(3)), "premature"), _check(_kind(part(5)), "other"))
    told = scoring.component_score(n % 11 > 0, checks)
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(told["score"], F.lit(0)).alias("score"), told["kind"].alias("kind"))


@query("""
WITH f AS (SELECT doc_id, doc_id % 11 > 0 AS has, (coalesce(text, '') = '')::INT + (lang = 'de')::INT + (doc_id % 5 = 0)::INT AS missing, doc_id % 6 = 0 AS open FROM documents),
s AS (SELECT doc_id, CASE WHEN has THEN CASE WHEN missing >= 2 THEN 2 WHEN missing = 1 THEN 3 WHEN NOT open THEN 5 END END AS score FROM f)
SELECT doc_id, coalesce(score, 0) AS score, CASE WHEN score IS NULL THEN 'undetermined' ELSE 'scored' END AS kind FROM s
""")
def q11_field_score(spark, sf_dir):
    n = F.col("doc_id")
    field = lambda missing, open_=None: F.struct(F.when(missing, "missing").when(F.lit(False) if open_ is None else open_, "undetermined").otherwise("present").alias("kind"))
    fields = F.array(field(F.coalesce("text", F.lit("")) == ""), field(F.col("lang") == "de"), field(n % 5 == 0), field(F.lit(False), n % 6 == 0))
    told = scoring.field_score(n % 11 > 0, fields)
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(told["score"], F.lit(0)).alias("score"), told["kind"].alias("kind"))


@query("""
WITH w AS (SELECT user_id, event_id, event_type = 'signup' AND event_id % 2 = 0 AS lost, coalesce(event_type = lag(event_type) OVER o, false) AS same, NOT (event_id % 199 = 7) AS usable FROM events WINDOW o AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM w),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) AS nth FROM r),
p AS (SELECT user_id, event_id, 'goto_not_landed' AS code FROM n WHERE lost UNION ALL SELECT user_id, event_id, 'repeat_action' FROM n WHERE same AND (lost OR nth % 2 = 0)),
u AS (SELECT user_id, bool_and(usable) AS ok FROM w GROUP BY user_id)
SELECT user_id, CASE WHEN ok THEN 'screenable' ELSE 'undetermined' END AS state, CASE WHEN ok THEN coalesce((SELECT string_agg(event_id || ':' || code, ',' ORDER BY event_id, code) FROM p WHERE p.user_id = u.user_id), '') ELSE '' END AS points FROM u
""")
def q7_screen(spark, sf_dir):
    """Chains of a user's events; a signup with an even number is a goto that did not land."""
    order = W.partitionBy("user_id").orderBy("event_id")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", (F.col("event_type") == F.lag("event_type").over(order)).alias("same"))
    landed = F.when(F.col("event_type") == "signup", F.col("event_id") % 2 != 0)
    out = scoring.screened(rows, ["user_id"], "event_id", landed, F.col("same"), F.col("event_id") % 199 != 7)
    return out.select("user_id", "state", F.array_join(F.transform("points", lambda p: F.concat_ws(":", p["step"].cast("string"), p["code"])), ",").alias("points"))


@query("""
WITH o AS (SELECT user_id, event_id AS "at", event_type || event_id % 40 AS entity, event_id % 3 > 0 AS complete FROM events WHERE event_type <> 'error'), m AS (SELECT DISTINCT user_id, event_id AS step, event_type || (event_id * 7) % 45 AS entity FROM events),
f AS (SELECT user_id, entity, min("at") AS first, max("at") FILTER (NOT complete) AS shaky, max("at") FILTER (complete) AS sure FROM o GROUP BY 1, 2), v AS (SELECT user_id, min("at") AS any_, min("at") FILTER (complete) AS complete FROM o GROUP BY 1)
SELECT user_id, step, entity, CASE WHEN first < step THEN 'supported' WHEN NOT coalesce(complete < step, false) THEN 'undeterminable' WHEN shaky >= step THEN 'undeterminable' WHEN sure >= step THEN 'supported' ELSE 'unsupported' END AS verdict
FROM m LEFT JOIN f USING (user_id, entity) LEFT JOIN v USING (user_id) WHERE any_ < step
""")
def q3_entity_support(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    named = lambda n: F.concat("event_type", n.cast("string")).alias("entity")
    n = F.col("event_id")
    observed = rows.where("event_type <> 'error'").select("user_id", n.alias("at"), named(n % 40), (n % 3 > 0).alias("complete"))
    mentions = rows.select("user_id", n.alias("step"), named(n * 7 % 45)).distinct()
    return scoring.unsupported_entities(mentions, observed, ["user_id"])


@query("""
SELECT conv_id, turn, CASE WHEN trim(text) = '' OR turn % 5 = 0 THEN 'not_run' WHEN contains(text, 'token') OR (length(text) > 300 AND turn % 2 = 0) THEN 'failed' ELSE 'passed' END AS status FROM conversations
""")
def q2_gate_status(spark, sf_dir):
    """Messages as rationales; an entity that nothing supports is hard, doubt is soft."""
    finding = lambda test, severity: F.when(test, F.struct(F.lit(severity).alias("severity")))
    findings = F.array_compact(F.array(finding(F.contains("text", F.lit("token")), "hard"), finding(F.contains("text", F.lit("maybe")), "soft"), finding((F.length("text") > 300) & (F.col("turn") % 2 == 0), "hard")))
    text = F.when(F.col("turn") % 5 == 0, F.lit(None)).otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", scoring.gate_status(text, findings).alias("status"))


@query("""
WITH b AS (SELECT conv_id, turn, role, CASE turn % 4 WHEN 1 THEN 'toolcall' WHEN 3 THEN 'toolresult' ELSE 'text' END AS type, text FROM conversations),
c AS (SELECT conv_id, count(*) FILTER (type = 'toolcall') AS calls, count(*) FILTER (type = 'toolresult') AS results FROM b GROUP BY conv_id),
l AS (SELECT conv_id, arg_max(type, turn) AS type, arg_max(text, turn) AS text FROM b WHERE role = 'assistant' GROUP BY conv_id),
r AS (SELECT conv_id, concat_ws(',', CASE WHEN type = 'toolcall' THEN 'last_is_call:assistant' END, CASE WHEN calls > results AND NOT (type = 'text' AND regexp_matches(text, '[.]$')) THEN 'mismatch:' || calls || '_vs_' || results END,
  CASE WHEN type = 'text' AND length(text) < 60 THEN 'last_text_incomplete' END) AS reasons FROM l JOIN c USING (conv_id))
SELECT * FROM r WHERE reasons <> ''
""")
def f40_incomplete_sessions(spark, sf_dir):
    kind = F.when(F.col("turn") % 4 == 1, "toolcall").when(F.col("turn") % 4 == 3, "toolresult").otherwise("text")
    blocks = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("message"), F.lit(0).alias("at"), "role", kind.alias("type"), F.col("role").alias("name"), "text")
    found = scoring.incomplete_session(blocks, "conv_id", F.col("text").rlike("[.]$"), F.length("text") < 60)
    return found.select("conv_id", F.array_join("reasons", ",").alias("reasons"))


@query("""
WITH s AS (SELECT user_id, count(*) - 3 AS n FROM events GROUP BY user_id), r AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS step, CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'error' THEN 'failed' ELSE 'written' END AS status, event_type, event_id FROM events)
SELECT user_id, step, coalesce(status, 'unavailable') AS status, CASE WHEN status = 'written' THEN event_type ELSE '' END AS text, CASE WHEN status = 'written' THEN '' ELSE 'r' || event_id END AS reason FROM r JOIN s USING (user_id) WHERE step < n AND event_id % 6 > 0
""")
def j4_aligned_rationales(spark, sf_dir):
    """Each user's events as steps, but for the last three, and as rationales, all of them."""
    order = W.partitionBy("user_id").orderBy("event_id")
    rows = table(spark, sf_dir, "events").withColumn("step", F.row_number().over(order) - 1)
    n = F.count("*").over(W.partitionBy("user_id"))
    steps = rows.withColumn("n", n).where("step < n - 3").select("user_id", "step")
    status = F.when(F.col("event_type") == "view", F.lit(None)).when(F.col("event_type") == "error", "failed").otherwise("written")
    given = rows.select("user_id", "step", status.alias("status"), F.col("event_type").alias("text"), F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("reason"), (F.col("event_id") % 6 > 0).alias("has_payload"))
    return contracts.aligned_rationales(steps, given, ["user_id"])


@query("""
SELECT doc_id AS id, CASE WHEN coalesce(text, '') = '' OR doc_id % 3 = 0 OR lang = 'es' THEN 0 ELSE 1 END AS n FROM documents
""")
def j6_refined_lines(spark, sf_dir):
    """Bodies with their first lines picked; in every third a line it does not have."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("x"), F.col("doc_id").cast("string"), F.lit("\n"), "text")).otherwise(F.concat("text", F.when(F.col("lang") == "es", " es").otherwise(F.lit("")))).alias("body"), "lang")
    key = F.substring(F.sha2("body", 256), 1, 16).alias("body_key")
    picked = docs.where("lang <> 'es'").select(key, F.when(F.col("id") % 3 == 0, F.array(F.lit("no such line"))).otherwise(F.slice(F.split("body", "\n", -1), 1, 1)).alias("lines"))
    return contracts.refined_lines(docs.select("id", "body"), picked).select("id", F.size("lines").alias("n"))


@query("SELECT user_id, CASE WHEN NOT bool_or(event_type = 'purchase' AND value > 60) THEN '' WHEN user_id % 2 = 0 THEN 'pre_action' ELSE 'post_hoc' END AS era FROM events GROUP BY user_id")
def q6_rationale_era(spark, sf_dir):
    written = F.when((F.col("event_type") == "purchase") & (F.col("value") > 60), "written").otherwise("unavailable")
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(written).alias("statuses"))
    return rows.select("user_id", contracts.rationale_era(F.col("statuses"), F.col("user_id") % 2 == 0).alias("era"))


@query(r"""
SELECT doc_id, CASE WHEN doc_id % 7 > 0 AND doc_id % 5 > 0 AND doc_id % 4 > 0 AND doc_id % 3 > 0 AND len(regexp_extract_all(coalesce(text, '') || repeat(' http://x.y', (doc_id % 4)::INT), 'https?://[^ \n\t]+')) < doc_id % 3 + 1 THEN 'failed' WHEN doc_id % 4 = 0 THEN 'not_run' ELSE 'passed' END AS status FROM documents
""")
def q5_output_contract(spark, sf_dir):
    n = F.col("doc_id")
    answer = F.concat(F.coalesce("text", F.lit("")), F.repeat(F.lit(" http://x.y"), (n % 4).cast("int")))
    least = F.when(n % 3 > 0, n % 3 + 1)
    status = contracts.output_contract(F.when(n % 4 == 0, "not_run").otherwise("passed"), answer, n % 7 > 0, n % 5 > 0, least)
    return table(spark, sf_dir, "documents").select("doc_id", status.alias("status"))


@query("""
WITH d AS (SELECT DISTINCT user_id % 3 AS surface, event_type AS tool, user_id FROM events), h AS (SELECT DISTINCT user_id % 3 AS surface, event_type AS tool FROM events WHERE event_type = 'error' AND user_id % 3 < 2)
SELECT surface, tool, user_id FROM d WHERE (surface, tool) NOT IN (SELECT surface, tool FROM h)
""")
def p9_visible_tools(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("surface"), F.col("event_type").alias("tool"), "user_id").distinct()
    catalog = rows.where("surface < 2").select("surface", "tool", F.when(F.col("tool") == "error", "platform").otherwise("model").alias("visibility"))
    return contracts.visible_tools(rows, catalog).select("surface", "tool", "user_id")


@query("SELECT user_id, coalesce(string_agg(DISTINCT event_type, ',' ORDER BY event_type) FILTER (event_type NOT IN (SELECT DISTINCT event_type FROM events e WHERE e.user_id = events.user_id AND value > 150)), '') AS unused FROM events GROUP BY user_id")
def u6_unused_tools(spark, sf_dir):
    """The tools a run declares and does not use."""
    sets = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("declared"), F.collect_set(F.when(F.col("value") > 150, F.col("event_type"))).alias("used"))
    return sets.select("user_id", F.array_join(F.array_sort(F.array_except("declared", "used")), ",").alias("unused"))


@query("SELECT DISTINCT user_id AS version FROM events WHERE user_id >= 5 AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 120)")
def u7_pending_versions(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    pushed = rows.where("value > 120").select(F.col("user_id").alias("version"), F.col("event_type").alias("scope"))
    return contracts.pending_versions(rows.select(F.col("user_id").alias("version")), pushed, 5, "signup")


@query("""
SELECT source, count(*) FILTER (toxic IS NOT NULL AND doc_id % 4 > 0) AS n, count(*) FILTER (quality = toxic AND doc_id % 4 > 0) AS hits, count(*) FILTER (quality = toxic AND doc_id % 4 > 0) / nullif(count(*) FILTER (toxic IS NOT NULL AND doc_id % 4 > 0), 0) AS rate,
  CASE WHEN count(*) FILTER (toxic IS NOT NULL AND doc_id % 4 > 0) = 0 THEN 'untestable' WHEN count(*) FILTER (quality = toxic AND doc_id % 4 > 0) / count(*) FILTER (toxic IS NOT NULL AND doc_id % 4 > 0) >= 0.5 THEN 'passed' ELSE 'failed' END AS status
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source
""")
def a31_batch_agreement(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return contracts.batch_agreement(rows, ["source"], F.when(F.col("doc_id") % 4 > 0, F.col("quality")), F.col("toxic"), 0.5)


@query("""
WITH k AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host, CASE page_id % 4 WHEN 0 THEN 'dead' WHEN 1 THEN 'region' WHEN 2 THEN 'odd' END AS kind FROM pages)
SELECT page_id, CASE WHEN page_id % 9 = 0 THEN ':' WHEN page_id % 5 = 0 THEN ':other_host' WHEN coalesce(kind, 'odd') = 'odd' THEN ':' WHEN kind = 'dead' AND page_id % 3 > 0 THEN ':no_error_page' WHEN kind = 'dead' THEN 'broken:terminal_shape' ELSE 'region_locked:terminal_shape' END AS reading FROM k
""")
def p26_terminal_branch(spark, sf_dir):
    n = F.col("page_id")
    host = urls.host(F.col("url"))
    kind = F.when(n % 4 == 0, "dead").when(n % 4 == 1, "region").when(n % 4 == 2, "odd")
    told = contracts.terminal_branch(n % 9 > 0, F.col("html"), host, F.when(n % 5 == 0, "other.example").otherwise(host), kind, n % 3 == 0, {"dead": "broken", "region": "region_locked"})
    return table(spark, sf_dir, "pages").select("page_id", F.concat_ws(":", told["branch"], told["why"]).alias("reading"))


@query("SELECT event_type, CAST(sum(n) AS BIGINT) AS rows, count(*) AS \"distinct\", CAST(sum(n - 1) AS BIGINT) AS repeated FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY event_type")
def k14_pool_census(spark, sf_dir):
    return contracts.pool_census(table(spark, sf_dir, "events"), ["event_type"], ["user_id"])


@query()
def f25_media_links(spark, sf_dir):
    """Pages with a player put in; two captures of an attribute in one pattern have no like in DuckDB."""
    player = F.concat(F.lit('<video src="/v/'), F.col("page_id").cast("string"), F.lit('.mp4"></video><iframe src="https://p.example/e"></iframe><a href="/f.m3u8?x=1">y</a>'))
    rows = table(spark, sf_dir, "pages").select("page_id", contracts.media_links(F.concat("html", player), ["mp4", "m3u8"]).alias("m"))
    return rows.select("page_id", F.array_join("m.media", ",").alias("media"), F.array_join("m.frames", ",").alias("frames"))


@query("""
SELECT CASE WHEN trim(source) = '' OR regexp_matches(source, '^(?:src1|src2)') THEN 'automated' ELSE 'human' END AS signature, count(*) AS n, count(*) FILTER (quality = toxic) / count(*) AS agreement FROM documents JOIN labels USING (doc_id) GROUP BY 1
""")
def a20_signature_strata(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", contracts.signature_class(F.col("source"), "^(?:src1|src2)").alias("signature")).join(table(spark, sf_dir, "labels"), "doc_id")
    return rows.groupBy("signature").agg(F.count("*").alias("n"), (F.count(F.when(F.col("quality") == F.col("toxic"), 1)) / F.count("*")).alias("agreement"))


@query("""
WITH p AS (SELECT 'd10' AS dimension, CAST(quality AS VARCHAR) AS judge, CAST(toxic AS VARCHAR) AS gold FROM labels UNION ALL SELECT 'd4', CAST(doc_id % 5 + 1 AS VARCHAR), CAST((doc_id // 2) % 5 + 1 AS VARCHAR) FROM labels UNION ALL SELECT 'd5', '1', '1' FROM labels WHERE doc_id = 0),
w AS (SELECT *, CASE WHEN dimension = 'd10' THEN (judge = gold)::INT::DOUBLE ELSE 1 - abs(judge::INT - gold::INT) / 4.0 END AS w FROM p), o AS (SELECT dimension, count(*) AS n, avg(w) AS po FROM w GROUP BY 1),
e AS (SELECT a.dimension, avg(CASE WHEN a.dimension = 'd10' THEN (a.judge = b.gold)::INT::DOUBLE ELSE 1 - abs(a.judge::INT - b.gold::INT) / 4.0 END) AS pe FROM p a JOIN p b USING (dimension) GROUP BY 1)
SELECT dimension, n, CASE WHEN dimension = 'd10' THEN 'cohen' ELSE 'linear_weighted' END AS kind, (po - pe) / (1 - pe) AS kappa FROM o JOIN e USING (dimension) WHERE n >= 2 AND pe < 1
""")
def a16_judge_agreement(spark, sf_dir):
    rows, n = table(spark, sf_dir, "labels"), F.col("doc_id")
    pair = lambda name, judge, gold: F.struct(F.lit(name).alias("dimension"), judge.cast("string").alias("judge"), gold.cast("string").alias("gold"))
    pairs = F.array(pair("d10", F.col("quality"), F.col("toxic")), pair("d4", n % 5 + 1, F.floor(n / 2) % 5 + 1))
    flat = rows.select(F.explode(pairs).alias("p")).select("p.*")
    return contracts.judge_agreement(flat, "dimension", "d10", 1, 5)


@query("""
WITH m AS (SELECT lang, median(n_chars) FILTER (source >= 'src5') AS a, median(n_chars) FILTER (source < 'src5') AS b FROM documents GROUP BY lang)
SELECT lang, a, b, abs(a - b) / nullif(a, 0) AS difference, coalesce(abs(a - b) / nullif(a, 0) > 0.3, false) AS over FROM m WHERE a IS NOT NULL OR b IS NOT NULL
""")
def q22_median_shift(spark, sf_dir):
    """Lengths of two corpora by language: those of some sources, and those of the others."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return gates.median_shift(docs.where("source >= 'src5'"), docs.where("source < 'src5'"), "n_chars", "lang")
