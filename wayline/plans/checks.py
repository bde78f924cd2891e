"""Queries of ordered checks, lenient parsers and small scores."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.functions import checks, predicates, text, urls
from wayline.plans.catalog import query
from wayline.plans.judgements import WALLS
from wayline.session import table

_LOW = r"lower(regexp_replace(text, '\s+', ' ', 'g'))"


@query(r"""
SELECT doc_id, array_to_string([x FOR x IN [CASE WHEN regexp_matches(text, '(?i)(?:password|secret|token|api_?key)\s*[:=]\s*\S{6,}') THEN 'assignment' END, CASE WHEN regexp_matches(text, 'AKIA[A-Z0-9]{16,}') THEN 'access' END,
  CASE WHEN regexp_matches(text, '[0-9a-f]{24,}') THEN 'hex' END, CASE WHEN regexp_matches(text, '(?i)bearer\s+[a-z0-9._-]{16,}') THEN 'bearer' END] IF x IS NOT NULL], ',') AS classes FROM documents
""")
def p34_credential_classes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(checks.credential_classes(F.col("text")), ",").alias("classes"))


@query("SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '[a-z]', 'a', 'g'), '[A-Z]', 'A', 'g'), '[0-9]', '9', 'g') AS shape FROM pages")
def p35_credential_shape(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", checks.shape(F.col("url")).alias("shape"))


@query("SELECT page_id, CASE WHEN contains(url, 'promo') OR contains(html, '<title>Just') THEN 'captcha' WHEN contains(html, 'cookies') OR contains(html, 'footer') THEN 'rate_limit' ELSE '-' END AS kind FROM pages")
def p15_block_kind(spark, sf_dir):
    kind = checks.block_kind(F.col("url"), F.col("html"), F.col("html"), ["promo"], ["<title>Just"], ["cookies", "footer"])
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(kind, F.lit("-")).alias("kind"))


@query(f"""
SELECT doc_id, regexp_matches(low, '(?:[$€£]\\s?[0-9]+(?:[.,][0-9]{{2}})?|[0-9]+(?:[.,][0-9]{{2}})?\\s?(?:eur|usd))') AND (contains(low, 'token') OR contains(low, 'secret')) AND NOT contains(low, 'sign in to') AS gated FROM (SELECT doc_id, {_LOW} AS low FROM documents)
""")
def p19_price_gate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", predicates.price_gate(F.col("text"), WALLS).alias("gated"))


@query("SELECT conv_id, turn, CASE WHEN contains(label, 'system') THEN false WHEN contains(label, 'user') THEN true ELSE regexp_matches(label, '^assistant [02468]$') END AS control FROM (SELECT conv_id, turn, role || ' ' || turn AS label FROM conversations)")
def p23_play_control(spark, sf_dir):
    label = F.concat_ws(" ", "role", "turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", predicates.is_play_control(label, ["system"], ["user"], "^assistant [02468]$").alias("control"))


@query(f"SELECT doc_id, (contains(low, 'the ') OR contains(low, ' und ')) AND NOT (contains(low, 'token') OR contains(low, 'licensed')) AS certain FROM (SELECT doc_id, {_LOW} AS low FROM documents)")
def f14_certain_tone(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", predicates.has_certain_tone(F.col("text"), ["the ", " und "], ["token", "licensed"]).alias("certain"))


@query(r"SELECT conv_id, turn, trim(text) = '' OR trim(text) IN ('ok', 'thanks') OR regexp_matches(trim(text), '[?]$') AS boilerplate FROM conversations")
def f11_boilerplate(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", checks.is_boilerplate(F.col("text"), ["ok", "thanks"], "[?]$").alias("boilerplate"))


@query(r"SELECT item_id, CASE WHEN len(p) >= 2 THEN array_to_string(p, '|') ELSE '' END AS parts FROM (SELECT item_id, [x FOR x IN string_split_regex(text, '\s*[,;/]\s*') IF length(trim(x)) >= 2] AS p FROM benchmark)")
def f12_composite_parts(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(checks.composite_parts(F.col("text")), "|").alias("parts"))


@query("SELECT doc_id, CASE WHEN contains(text, lang) THEN 2 ELSE 0 END + CASE WHEN contains(text, 'token') THEN 1 ELSE 0 END AS score FROM documents")
def f5_item_score(spark, sf_dir):
    score = F.when(text.focus_hit(F.col("text"), F.col("lang")), 2).otherwise(0) + F.when(F.contains("text", F.lit("token")), 1).otherwise(0)
    return table(spark, sf_dir, "documents").select("doc_id", score.alias("score"))


@query("SELECT page_id, url, md5(html) AS body, length(html) >= 1000 * 0.95 AS truncated FROM pages")
def f20_snapshot(spark, sf_dir):
    """Snapshots written as text and taken apart again."""
    snapshot = F.concat(F.lit("URL: "), F.col("url"), F.lit("\nTitle: page\n\n"), F.col("html"))
    rows = table(spark, sf_dir, "pages").select("page_id", checks.snapshot_parts(snapshot).alias("s"))
    return rows.select("page_id", "s.url", F.md5("s.body").alias("body"), checks.is_truncated(F.col("s.body"), 1000).alias("truncated"))


@query("SELECT user_id, count(*) AS lines, count(*) FILTER (event_id % 5 > 0) AS kept FROM events GROUP BY user_id")
def f21_ndjson(spark, sf_dir):
    """JSON lines of each user; every fifth is cut off and drops out."""
    line = F.when(F.col("event_id") % 5 == 0, F.lit('{"k": ')).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("lines"), F.count(F.try_parse_json(line)).alias("kept"))


@query("SELECT event_id, 'e' || event_id AS ref, event_type AS tag, props AS label FROM events")
def f22_element_line(spark, sf_dir):
    line = F.concat(F.lit("e"), F.col("event_id").cast("string"), F.lit("= "), F.col("event_type"), F.lit(' "'), F.col("props"), F.lit('"'))
    return table(spark, sf_dir, "events").select("event_id", checks.element_line(line).alias("e")).select("event_id", "e.*")


@query("SELECT event_id, coalesce(CASE WHEN value / 50 BETWEEN 0 AND 1 THEN value / 50 END, -1) AS confidence, coalesce(CASE WHEN lower(event_type) IN ('true', 'view') THEN true END, false) AS known FROM events")
def f34_lenient_values(spark, sf_dir):
    flag = text.as_bool(F.when(F.col("event_type") == "view", " Yes ").otherwise(F.col("event_type")))
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(checks.confidence(F.col("value") / 50), F.lit(-1.0)).alias("confidence"), F.coalesce(flag, F.lit(False)).alias("known"))


@query("SELECT conv_id, turn, text AS body FROM conversations")
def f35_lead_in(spark, sf_dir):
    """Texts with a lead-in put before them, and stripped of it."""
    led = F.concat(F.when(F.col("turn") % 2 == 0, "Sure! ").otherwise("Of course. "), F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", checks.lead_in_stripped(led, ["Sure! ", "Of course. "]).alias("body"))


@query("SELECT event_id, greatest(1, least(5, CAST(round_even(value / 100 * 4, 0) AS INTEGER) + 1)) AS tier FROM events")
def g18_tiers(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", checks.five_tiers(F.col("value") / 100).alias("tier"))


@query("""
SELECT event_type, coalesce(abs(coalesce(b, 0) - a) / nullif(a, 0), -1) AS difference FROM (SELECT event_type, sum(value) FILTER (event_id % 2 = 0) AS a, sum(value) FILTER (event_id % 2 = 1 AND event_type <> 'view') AS b FROM events GROUP BY event_type)
""")
def g19_ratio_difference(spark, sf_dir):
    even = F.sum(F.when(F.col("event_id") % 2 == 0, F.col("value")))
    odd = F.sum(F.when((F.col("event_id") % 2 == 1) & (F.col("event_type") != "view"), F.col("value")))
    sums = table(spark, sf_dir, "events").groupBy("event_type").agg(even.alias("a"), odd.alias("b"))
    return sums.select("event_type", F.coalesce(checks.ratio_difference(F.col("a"), F.col("b")), F.lit(-1.0)).alias("difference"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE epoch(date_trunc('second', ts)) END AS seconds FROM events")
def g22_ordering_time(spark, sf_dir):
    stamp = F.when(F.col("event_id") % 4 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "events").select("event_id", checks.ordering_time(stamp).alias("seconds"))


@query("SELECT event_id, CAST(user_id AS VARCHAR) AS code, event_type AS llm FROM events")
def g20_faces(spark, sf_dir):
    version = F.concat(F.lit("v1@code:"), F.col("user_id").cast("string"), F.lit("/llm:"), F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", checks.face(version, "code").alias("code"), checks.face(version, "llm").alias("llm"))


@query("""
SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '-' ELSE array_to_string([k FOR k IN [turn, turn + 1, 0, 99] IF k >= 1 AND k <= 5], ',') END AS lines FROM conversations
""")
def h6_selected_lines(spark, sf_dir):
    """Line numbers in an answer; one with words in it selects nothing."""
    turn = F.col("turn")
    answer = F.when(turn % 3 == 0, "lines 1 and 2").otherwise(F.concat_ws(", ", turn, turn + 1, F.lit(0), F.lit(99)))
    lines = checks.selected_lines(answer, F.lit(5))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(F.array_join(lines.cast("array<string>"), ","), F.lit("-")).alias("lines"))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' AND value > 50 THEN 'stop' WHEN same THEN 'dead_loop' WHEN value < 5 THEN 'too_little' ELSE 'go_on' END AS verdict
FROM (SELECT *, coalesce(event_type = lag(event_type) OVER w AND event_type = lag(event_type, 2) OVER w, false) AS same FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
""")
def p16_intercept(spark, sf_dir):
    """A verdict on every step, the first rule counting."""
    kind, before = F.col("event_type"), W.partitionBy("user_id").orderBy("event_id")
    rows = table(spark, sf_dir, "events").withColumn("same", (kind == F.lag(kind).over(before)) & (kind == F.lag(kind, 2).over(before)))
    verdict = checks.intercept([("stop", (kind == "error") & (F.col("value") > 50)), ("dead_loop", F.col("same")), ("too_little", F.col("value") < 5)])
    return rows.select("event_id", verdict.alias("verdict"))


@query(r"""
SELECT page_id, CASE WHEN host = '' THEN 'bad_url' WHEN regexp_matches(path, '(?i)[.](?:pdf|zip)$') THEN 'file' WHEN path IN ('', '/') THEN 'homepage' WHEN page_id % 7 = 0 THEN 'redirect' ELSE '-' END AS reason
FROM (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)(?::[0-9]*)?([^?#]*)', 2) AS path FROM pages)
""")
def p13_exclusion_reason(spark, sf_dir):
    """Why a candidate is left out; a link through a redirect is told by what it wraps."""
    link = F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("http://go.example.com/r?url="), F.replace(F.replace("url", F.lit(":"), F.lit("%3A")), F.lit("/"), F.lit("%2F")))).otherwise(F.col("url"))
    target = urls.redirect_target(link)
    rules = [("bad_url", urls.host(target) == ""), ("file", urls.path(target).rlike("(?i)[.](?:pdf|zip)$")), ("homepage", urls.is_homepage(target)), ("redirect", target != link)]
    reason = checks.intercept(rules)
    return table(spark, sf_dir, "pages").select("page_id", F.when(reason == "go_on", "-").otherwise(reason).alias("reason"))


@query(r"SELECT conv_id, turn, trim(regexp_replace('<think>plan' || chr(10) || 'more</think> ' || text, '<think>.*?</think>', '', 's')) AS answer FROM conversations")
def f33_strip_think(spark, sf_dir):
    led = F.concat(F.lit("<think>plan\nmore</think> "), F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.strip_think(led).alias("answer"))
