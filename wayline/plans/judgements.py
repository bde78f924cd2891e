"""Queries that judge: predicates over texts, gates over runs, verdicts over rounds."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.functions import predicates
from wayline.operators import gates, matching, metrics
from wayline.plans.catalog import query
from wayline.session import table

#: Latin stand-ins that occur in the test texts.
WALLS = predicates.Walls(gate=("licensed under",), action=("token", "secret"), context=("ation", "heit"), login=("sign in to",), kinds=(("challenge", ("###",)), ("not_found", ("404",)), ("forbidden", ("403",)), ("region", ("not licensed",))))

_LOW = r"lower(regexp_replace(text, '\s+', ' ', 'g'))"


@query(f"""
SELECT doc_id, CASE WHEN contains(low, '###') THEN 'challenge' WHEN contains(low, '404') THEN 'not_found' WHEN contains(low, '403') THEN 'forbidden' WHEN contains(low, 'not licensed') THEN 'region' ELSE '-' END AS kind
FROM (SELECT doc_id, {_LOW} AS low FROM documents)
""")
def p20_access_kind(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(predicates.access_kind(F.col("text"), WALLS), F.lit("-")).alias("kind"))


@query(rf"""
WITH s AS (SELECT doc_id, {_LOW} AS low FROM documents)
SELECT doc_id, CASE WHEN contains(low, 'licensed under') THEN 1
  WHEN len([x for x in string_split_regex(low, '[.!?]+\s*') if regexp_matches(x, '\b(?:token|secret)\b') AND regexp_matches(regexp_replace(x, '\b(?:token|secret)\b', ' ', 'g'), 'ation|heit')]) > 0 THEN 2 ELSE 0 END AS tier FROM s
""")
def p18_paywall_tier(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(predicates.paywall_tier(F.col("text"), WALLS), F.lit(0)).alias("tier"))


@query("SELECT doc_id, coalesce(nullif(regexp_extract(text, '([$€£])\\s?([0-9]+(?:[.,][0-9]{1,2})?)', 1), ''), '-') AS currency, coalesce(TRY_CAST(replace(regexp_extract(text, '([$€£])\\s?([0-9]+(?:[.,][0-9]{1,2})?)', 2), ',', '.') AS DOUBLE), -1) AS amount FROM documents")
def f26_prices(spark, sf_dir):
    price = predicates.prices(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(price["currency"], F.lit("-")).alias("currency"), F.coalesce(price["amount"], F.lit(-1.0)).alias("amount"))


@query("""
WITH p AS (SELECT doc_id, unnest(['the ', 'ation', 'licensed', 'zz']) AS phrase, instr(text, unnest(['the ', 'ation', 'licensed', 'zz'])) AS pos FROM documents)
SELECT d.doc_id, coalesce(string_agg(phrase, '|' ORDER BY pos), '') AS phrases FROM documents d LEFT JOIN (SELECT * FROM p WHERE pos > 0) p USING (doc_id) GROUP BY d.doc_id
""")
def f13_phrase_spans(spark, sf_dir):
    found = predicates.phrase_spans(F.col("text"), ["the ", "ation", "licensed", "zz"])
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(found, "|").alias("phrases"))


@query("""
SELECT user_id, CASE WHEN count(*) = 0 THEN 'not_run' WHEN bool_or(event_type = 'error' AND value > 100) THEN 'failed' ELSE 'passed' END AS gate, count(*) FILTER (event_type = 'error' AND value > 100) AS reasons FROM events GROUP BY user_id
""")
def q4_gate_summary(spark, sf_dir):
    bad = (F.col("event_type") == "error") & (F.col("value") > 100)
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.when(F.bool_or(bad), "failed").otherwise("passed").alias("gate"), F.count(F.when(bad, 1)).alias("reasons"))


_CRITERIA = """c AS (SELECT event_type AS name, CASE WHEN event_type = 'view' THEN NULL ELSE avg(CASE WHEN value > 20 THEN 1.0 ELSE 0.0 END) END AS value, 0.65 AS line, event_type <> 'signup' AS enforced FROM events GROUP BY event_type)"""


@query(f"""WITH {_CRITERIA}
SELECT NOT bool_or(enforced AND coalesce(value < line, true)) AS passed, coalesce(string_agg(name, ',' ORDER BY name) FILTER (enforced AND value < line), '') AS missed,
  coalesce(string_agg(name, ',' ORDER BY name) FILTER (enforced AND value IS NULL), '') AS not_evaluable FROM c
""")
def q19_gate(spark, sf_dir):
    """A release gate over shares by type; what cannot be evaluated rejects."""
    share = F.when(F.col("event_type") != "view", F.avg((F.col("value") > 20).cast("double")))
    rows = table(spark, sf_dir, "events").groupBy("event_type").agg(share.alias("value"))
    rows = rows.select(F.col("event_type").alias("name"), "value", F.lit(0.65).alias("line"), (F.col("event_type") != "signup").alias("enforced"))
    return gates.gate(rows).select("passed", F.array_join("missed", ",").alias("missed"), F.array_join("not_evaluable", ",").alias("not_evaluable"))


@query("""
WITH b AS (SELECT doc_id AS id, 'c' || (doc_id % 5) AS clause, quality AS pred FROM labels), n AS (SELECT id, clause, CASE WHEN id % 10 = 1 OR id % 25 = 7 THEN 1 - pred ELSE pred END AS pred FROM b)
SELECT clause, count(*) AS n, count(*) FILTER (b.pred <> n.pred) AS moved, count(*) FILTER (b.pred <> n.pred) > 0 AND clause <> 'c1' AS violation FROM b JOIN n USING (id, clause) GROUP BY clause
""")
def q20_clause_invariance(spark, sf_dir):
    old = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.concat(F.lit("c"), (F.col("doc_id") % 5).cast("string")).alias("clause"), F.col("quality").alias("pred"))
    moves = (F.col("id") % 10 == 1) | (F.col("id") % 25 == 7)
    return gates.clause_invariance(old, old.withColumn("pred", F.when(moves, 1 - F.col("pred")).otherwise(F.col("pred"))), ["c1"])


@query("""
WITH r AS (SELECT quality AS x, CASE WHEN doc_id % 9 = 0 THEN 1 - quality ELSE quality END AS y FROM labels), t AS (SELECT count(*) AS n, count(*) FILTER (x = y) AS same, avg(x) AS px, avg(y) AS py FROM r)
SELECT n, same, (same / n - (px * py + (1 - px) * (1 - py))) / (1 - (px * py + (1 - px) * (1 - py))) AS kappa FROM t
""")
def q29_retest(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.first("quality").alias("quality"))
    again = F.when(F.col("doc_id") % 9 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    rounds = labels.select(F.col("doc_id").alias("id"), F.explode(F.array(F.struct(F.lit(1).alias("round"), F.col("quality").alias("label")), F.struct(F.lit(2).alias("round"), again.alias("label")))).alias("r"))
    return gates.retest(rounds.select("id", "r.*"))


@query("""
WITH o AS (SELECT event_id, user_id AS run, 'u' || (event_id % 50) AS url, event_type AS branch, CASE WHEN event_id % 2 = 0 THEN 'q1' ELSE 'q2' END AS question FROM events),
v AS (SELECT user_id AS run, 'u' || (event_id % 50) AS url, max(event_type) AS verdict FROM events WHERE value > 200 GROUP BY 1, 2)
SELECT event_id, CASE WHEN fit THEN verdict ELSE branch END AS branch, coalesce(CASE WHEN NOT fit THEN verdict END, '-') AS site_verdict, CASE WHEN fit THEN 'human' ELSE 'code' END AS source
FROM (SELECT o.*, verdict, coalesce(question = 'q1' AND verdict IN ('view', 'signup'), false) AS fit FROM o LEFT JOIN v USING (run, url))
""")
def q33_review_apply(spark, sf_dir):
    """People's verdicts on outcomes: those that fit the question count."""
    url = F.concat(F.lit("u"), (F.col("event_id") % 50).cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("run"), url.alias("url"), F.col("event_type").alias("branch"), F.when(F.col("event_id") % 2 == 0, "q1").otherwise("q2").alias("question"), F.lit("code").alias("source"), "value")
    verdicts = rows.where("value > 200").groupBy("run", "url").agg(F.max("branch").alias("verdict"))
    out = gates.reviewed(rows.drop("value"), verdicts, {"q1": ["view", "signup"]})
    return out.select("event_id", "branch", F.coalesce("site_verdict", F.lit("-")).alias("site_verdict"), "source")


@query("""
WITH a AS (SELECT doc_id, quality AS label, CASE WHEN toxic = 1 THEN 2 ELSE 1 END AS round FROM labels), m AS (SELECT doc_id + 100 AS old, doc_id AS new FROM documents WHERE lang = 'fr')
SELECT coalesce(m.new, a.doc_id) AS doc_id, count(*) AS n, CAST(sum(label) AS BIGINT) AS positive FROM a LEFT JOIN m ON a.doc_id = m.old WHERE round = 1 AND coalesce(m.new, a.doc_id) IN (SELECT doc_id FROM documents) GROUP BY 1
""")
def j21_annotations(spark, sf_dir):
    """First-round annotations on the candidates their ids, old or new, stand for."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    alias = table(spark, sf_dir, "documents").where("lang = 'fr'").select((F.col("doc_id") + 100).alias("old"), F.col("doc_id").alias("new"))
    rows = table(spark, sf_dir, "labels").where("toxic = 0").join(alias, F.col("doc_id") == F.col("old"), "left")
    rows = rows.select(F.coalesce("new", "doc_id").alias("doc_id"), "quality").join(docs, "doc_id", "left_semi")
    return rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("quality").cast("long").alias("positive"))


@query("""
SELECT conv_id, max(turn) FILTER (role = 'assistant' AND length(text) > 40) AS turn, coalesce(arg_max(md5(text), turn) FILTER (role = 'assistant' AND length(text) > 40), '-') AS body FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'assistant' AND length(text) > 40) > 0
""")
def w2_last_written(spark, sf_dir):
    """The last written reflection of each session."""
    written = (F.col("role") == "assistant") & (F.length("text") > 40)
    last = F.max(F.when(written, F.struct("turn", F.md5("text").alias("body"))))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(last.alias("last")).where("last is not null").select("conv_id", "last.turn", "last.body")


@query("""
WITH d AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT user_id, event_type, n, sum(n) OVER (PARTITION BY user_id) AS total FROM d)
SELECT user_id, min(n / total) AS least, min(n / total) < 0.05 AS degenerate FROM r GROUP BY user_id
""")
def a37_spread(spark, sf_dir):
    """The smallest share of a type in each run."""
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(W.partitionBy("user_id"))
    out = counts.withColumn("share", share).groupBy("user_id").agg(F.min("share").alias("least"))
    return out.withColumn("degenerate", F.col("least") < 0.05)


@query("""
WITH u AS (SELECT source, lang, doc_id, 'tag' || (doc_id % 4) AS tag, CASE WHEN n_chars > 2000 THEN 'long:' || doc_id ELSE '' END AS evidence FROM documents),
t AS (SELECT source, tag, min(doc_id) AS first FROM u GROUP BY 1, 2), e AS (SELECT source, min(doc_id) AS d FROM u WHERE evidence <> '' GROUP BY 1)
SELECT source, string_agg(tag, ',' ORDER BY first) AS tags, coalesce(max('long:' || d), '') AS evidence FROM t LEFT JOIN e USING (source) GROUP BY source
""")
def a22_run_merge(spark, sf_dir):
    """Tags of a run in order of first sight, and its first evidence."""
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.concat(F.lit("tag"), (F.col("doc_id") % 4).cast("string")).alias("tag"), F.when(F.col("n_chars") > 2000, F.concat(F.lit("long:"), F.col("doc_id").cast("string"))).alias("evidence"))
    tags = rows.groupBy("source", "tag").agg(F.min("doc_id").alias("first"), F.min(F.when(F.col("evidence").isNotNull(), F.struct("doc_id", "evidence"))).alias("e"))
    out = tags.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "tag"))), lambda x: x["tag"]), ",").alias("tags"), F.coalesce(F.min("e").getField("evidence"), F.lit("")).alias("evidence"))
    return out


@query("""
SELECT event_id, CASE WHEN gold IS NULL AND pred IS NULL THEN 'both_missing' WHEN pred IS NULL THEN 'pred_missing' WHEN gold IS NULL THEN 'gold_missing' WHEN gold = pred THEN 'agree' ELSE 'disagree' END AS state, coalesce(CASE WHEN a BETWEEN 1 AND 5 AND b BETWEEN 1 AND 5 THEN abs(a - b) END, -1) AS gap
FROM (SELECT event_id, CASE WHEN value > 10 THEN event_type END AS gold, CASE WHEN event_id % 7 > 0 THEN 'click' END AS pred, event_id % 7 AS a, event_id % 6 AS b FROM events)
""")
def g15_agreement_states(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("value") > 10, F.col("event_type")).alias("gold"), F.when(F.col("event_id") % 7 > 0, "click").alias("pred"), (F.col("event_id") % 7).alias("a"), (F.col("event_id") % 6).alias("b"))
    return rows.select("event_id", gates.hard_agreement(F.col("gold"), F.col("pred")).alias("state"), F.coalesce(gates.tier_gap(F.col("a"), F.col("b")), F.lit(-1)).alias("gap"))


@query("SELECT event_type, count(*) AS rows, sum(value) FILTER (value > 50) AS big, CASE WHEN count(*) FILTER (value < 0) > 0 THEN 1.0 END IS NULL AS undefined FROM events GROUP BY event_type")
def law2_null_ratios(spark, sf_dir):
    """A ratio without a denominator is null."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("rows"), F.sum(F.when(F.col("value") > 50, F.col("value"))).alias("big"), metrics.ratio(F.lit(1.0), F.count(F.when(F.col("value") < 0, 1))).isNull().alias("undefined"))


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'error')")
def j12_run_semi_join(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.where("event_type = 'purchase'").select("user_id").distinct().join(rows.where("event_type = 'error'").select("user_id"), "user_id", "left_semi")


@query("SELECT doc_id, quality FROM labels")
def j9_unique_index(spark, sf_dir):
    """Labels by document; a second one for a document would fail the job."""
    return matching.require_unique(table(spark, sf_dir, "labels").select("doc_id", "quality"), ["doc_id"])
