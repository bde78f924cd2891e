"""Queries over texts: lines, noise, digests, clean-up, scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.functions import arrays, text
from wayline.operators import bodies
from wayline.plans.catalog import query
from wayline.session import table

#: Latin stand-ins for the navigation vocabulary; the operators take any.
NOISE = text.Noise(words=("Is.", "On.", "De.", "The.", "And."), pattern=r"^[^A-Za-z]*$", short_pattern=r"^[A-Z][a-z]+[.]$")
KEEP, KEYWORDS, FOCUS = ("Licensed under", "http"), ("tion", "heit"), "nation"

_LINES = "(SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw FROM documents)"
_NOISE = "(line IN ('Is.', 'On.', 'De.', 'The.', 'And.') OR regexp_matches(line, '^[^A-Za-z]*$') OR (regexp_matches(line, '^[A-Z][a-z]+[.]$') AND length(line) < 40))"
_STRIPPED = rf"(SELECT doc_id, source, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM {_LINES})"


@query(f"""
SELECT source, count(*) AS n_lines, count(*) FILTER ({_NOISE}) AS n_noise, count(DISTINCT CASE WHEN NOT {_NOISE} THEN line END) AS n_kept
FROM {_STRIPPED} WHERE line <> '' GROUP BY source
""")
def f1_noise_profile(spark, sf_dir):
    """Per source: lines, noise lines, different lines kept."""
    rows = table(spark, sf_dir, "documents").select("source", F.explode(text.lines(F.col("text"))).alias("line"))
    noise = text.is_noise(F.col("line"), NOISE)
    kept = F.countDistinct(F.when(~noise, F.col("line")))
    return rows.groupBy("source").agg(F.count("*").alias("n_lines"), F.count(F.when(noise, 1)).alias("n_noise"), kept.alias("n_kept"))


@query(f"""
SELECT doc_id, count(DISTINCT CASE WHEN line <> '' AND NOT {_NOISE} THEN line END) AS n_lines,
  count(*) FILTER (line <> '') - count(DISTINCT CASE WHEN line <> '' AND NOT {_NOISE} THEN line END) AS n_dropped
FROM {_STRIPPED} GROUP BY doc_id
""")
def f3_candidate_lines(spark, sf_dir):
    """Per document: lines left without noise and repeats, and lines dropped."""
    n = F.size(text.candidate_lines(F.col("text"), NOISE)).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", n.alias("n_lines"), (F.size(text.lines(F.col("text"))) - n).cast("long").alias("n_dropped"))


def _scored(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.candidate_lines(F.col("text"), NOISE)).alias("idx", "line"))
    return rows.withColumn("score", text.line_score(F.col("line"), KEEP, F.lit(FOCUS), KEYWORDS))


_SCORE = """CASE WHEN contains(line, 'Licensed under') OR contains(line, 'http') THEN 4
  WHEN contains(line, 'nat') OR contains(line, 'ati') OR contains(line, 'tio') OR contains(line, 'ion') THEN 3
  WHEN contains(line, 'tion') OR contains(line, 'heit') THEN 2 WHEN length(line) >= 6 THEN 1 ELSE 0 END"""


@query(f"SELECT score, count(*) AS n FROM (SELECT doc_id, line, {_SCORE} AS score FROM (SELECT DISTINCT doc_id, line FROM {_STRIPPED} WHERE line <> '' AND NOT {_NOISE})) GROUP BY score")
def f2_line_scores(spark, sf_dir):
    """How many lines have each score."""
    return _scored(spark, sf_dir).groupBy("score").agg(F.count("*").alias("n"))


@query(rf"""
WITH raw AS (SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
stripped AS (SELECT doc_id, place, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM raw),
kept AS (SELECT doc_id, line, min(place) AS idx FROM stripped WHERE line <> '' AND NOT {_NOISE} GROUP BY doc_id, line),
scored AS (SELECT *, {_SCORE} AS score FROM kept),
budget AS (
  SELECT *, 400 - coalesce(sum(CASE WHEN score >= 4 THEN length(line) + 1 END) OVER (PARTITION BY doc_id), 0)
    - coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id, score >= 4 ORDER BY score DESC, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM scored),
taken AS (SELECT *, CASE WHEN score >= 4 OR length(line) + 1 <= room THEN line WHEN room > 0 THEN left(line, CAST(room AS INTEGER)) END AS part FROM budget),
joined AS (
  SELECT doc_id, coalesce(string_agg(part, chr(10) ORDER BY idx), '') AS text, bool_or(part IS NULL OR length(part) < length(line)) AS cut FROM taken GROUP BY doc_id)
SELECT doc_id, text, cut OR length(text) > 400 AS truncated FROM joined
""")
def t1_digest(spark, sf_dir):
    """A digest of each document within 400 characters."""
    shown = bodies.digest(F.col("text"), NOISE, KEEP, F.lit(FOCUS), KEYWORDS, 400, last_end=False)
    rows = table(spark, sf_dir, "documents").where(F.size(text.candidate_lines(F.col("text"), NOISE)) > 0)
    return rows.select("doc_id", shown.alias("shown")).select("doc_id", "shown.text", "shown.truncated")


#: Lines that a model would have picked, last ones first: those that hold a syllable; those of German documents hold a line that is not there.
SYLLABLE = "an"


@query(rf"""
WITH raw AS (SELECT doc_id, lang, generate_subscripts(parts, 1) AS place, unnest(parts) AS raw FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS parts FROM documents)),
stripped AS (SELECT doc_id, lang, place, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM raw),
lines AS (SELECT doc_id, lang, line, min(place) AS idx, {_NOISE} AS noise, {_SCORE} AS score FROM stripped WHERE line <> '' GROUP BY ALL),
usable AS (SELECT doc_id FROM lines WHERE lang <> 'de' GROUP BY doc_id HAVING count(*) FILTER (contains(line, 'an')) > 0),
kept AS (SELECT *, doc_id IN (SELECT doc_id FROM usable) AS refined FROM lines WHERE NOT noise AND (contains(line, 'an') OR score >= 4 OR doc_id NOT IN (SELECT doc_id FROM usable))),
budget AS (
  SELECT *, 400 - coalesce(sum(CASE WHEN score >= 4 THEN length(line) + 1 END) OVER (PARTITION BY doc_id), 0)
    - coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id, score >= 4 ORDER BY score DESC, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM kept),
taken AS (SELECT *, CASE WHEN score >= 4 OR length(line) + 1 <= room THEN line WHEN room > 0 THEN left(line, CAST(room AS INTEGER)) END AS part FROM budget),
joined AS (
  SELECT doc_id, coalesce(string_agg(part, chr(10) ORDER BY idx), '') AS text, count(part) AS kept, bool_or(part IS NULL OR length(part) < length(line)) AS cut FROM taken GROUP BY doc_id),
totals AS (SELECT doc_id, count(*) FILTER (NOT noise) AS n FROM lines GROUP BY doc_id)
SELECT d.doc_id, coalesce(j.text, '') AS text, CAST(coalesce(kept, 0) AS INTEGER) AS kept, CAST(greatest(coalesce(n, 0) - coalesce(kept, 0), 0) AS INTEGER) AS dropped,
  coalesce(cut OR length(j.text) > 400, false) AS truncated, CASE WHEN d.doc_id IN (SELECT doc_id FROM usable) THEN 'refined' ELSE 'rules' END AS source
FROM documents d LEFT JOIN joined j ON j.doc_id = d.doc_id LEFT JOIN totals t ON t.doc_id = d.doc_id
""")
def t2_refined_view(spark, sf_dir):
    """Each document by the lines that were picked for it, within 400 characters, by rules where they cannot be used."""
    picked = F.reverse(F.filter(text.lines(F.col("text")), lambda x: F.contains(x, F.lit(SYLLABLE))))
    picked = F.when(F.col("lang") == "de", F.concat(picked, F.array(F.lit("a line of another page")))).otherwise(picked)
    shown = bodies.view(F.col("text"), picked, NOISE, KEEP, F.lit(FOCUS), KEYWORDS, 400, last_end=False)
    return table(spark, sf_dir, "documents").select("doc_id", shown.alias("shown")).select("doc_id", "shown.*")


@query("""
SELECT item_id, contains(text, 'station') OR contains(text, 'sta') OR contains(text, 'tat') OR contains(text, 'ati') OR contains(text, 'tio') OR contains(text, 'ion') AS hit
FROM benchmark
""")
def f6_focus_hit(spark, sf_dir):
    """Which passages meet a focus word."""
    return table(spark, sf_dir, "benchmark").select("item_id", text.focus_hit(F.col("text"), F.lit("station")).alias("hit"))


@query(r"""
SELECT doc_id, len(list_distinct(list_concat(list_concat(regexp_extract_all(text, 'https?://[^\s"''<>]+'), regexp_extract_all(text, '"([^"\n]{2,80})"', 1)),
  regexp_extract_all(text, '\b((?:[a-z0-9-]+\.)+(?:com|org|net))\b', 1)))) AS n_entities FROM documents
""")
def f10_entities(spark, sf_dir):
    """How many different entities each document names."""
    return table(spark, sf_dir, "documents").select("doc_id", F.size(text.entities(F.col("text"))).cast("long").alias("n_entities"))


_CLEAN = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'),
  '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g'), '(?is)<(?:script|style)\b[^>]*>[^<]*', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')"""
_SPACED = rf"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({_CLEAN}, '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')"""


@query(f"SELECT page_id, length(body) AS n_chars, md5(body) AS body_md5 FROM (SELECT page_id, {_SPACED} AS body FROM pages)")
def f18_clean_body(spark, sf_dir):
    """The text of each page's markup."""
    rows = table(spark, sf_dir, "pages").select("page_id", text.clean_body(F.col("html")).alias("body"))
    return rows.select("page_id", F.length("body").cast("long").alias("n_chars"), F.md5("body").alias("body_md5"))


@query(r"SELECT page_id, regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '^\s+|\s+$', '', 'g') AS title FROM pages")
def f24_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.title(F.col("html")).alias("title"))


@query("SELECT count(*) FILTER (len(regexp_extract_all(text, '�')) >= 3) AS mojibake, CAST(sum(len(regexp_extract_all(text, 'https?://[^\\s\"''<>]+'))) AS BIGINT) AS urls FROM documents")
def f23_mojibake_and_urls(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.agg(F.count(F.when(text.is_mojibake(F.col("text")), 1)).alias("mojibake"), F.sum(text.count_urls(F.col("text"))).cast("long").alias("urls"))


@query("""
SELECT lang, CASE WHEN regexp_matches(text, '[\\x{3040}-\\x{30ff}]') THEN 'kana' WHEN regexp_matches(text, '[\\x{ac00}-\\x{d7a3}]') THEN 'hangul'
  WHEN regexp_matches(text, '[\\x{4e00}-\\x{9fff}]') THEN 'han' WHEN regexp_matches(text, '[\\x{00df}-\\x{00ff}]') THEN 'latin_accented' ELSE 'latin' END AS script, count(*) AS n
FROM documents GROUP BY 1, 2
""")
def f42_scripts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("lang", text.script_class(F.col("text")).alias("script"))
    return rows.groupBy("lang", "script").agg(F.count("*").alias("n"))


@query(r"""
WITH said AS (SELECT conv_id, turn, role, regexp_replace(text, '\s+$', '') AS bare FROM conversations),
judged AS (SELECT *, CASE WHEN bare = '' THEN 'empty' WHEN regexp_matches(bare, '(\.\.\.|…)$') THEN 'ellipsis' WHEN regexp_matches(bare, '[:,;(\[{-]$') THEN 'open'
  WHEN length(regexp_replace(bare, '[^(]', '', 'g')) > length(regexp_replace(bare, '[^)]', '', 'g')) THEN 'bracket'
  WHEN NOT regexp_matches(bare, '[.!?)\]}"'']$') THEN 'no_end' END AS reason FROM said)
SELECT role, reason, count(*) AS n FROM judged GROUP BY role, reason
""")
def f39_incomplete(spark, sf_dir):
    """Why messages look cut off, by role."""
    rows = table(spark, sf_dir, "conversations").select("role", text.incomplete_reason(F.col("text")).alias("reason"))
    return rows.groupBy("role", "reason").agg(F.count("*").alias("n"))


@query("SELECT doc_id, CAST(coalesce(list_sum([length(x) + 1 for x in string_split(text, chr(10))]), 0) AS BIGINT) > 2000 AS refine FROM documents")
def h8_needs_refine(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", arrays.needs_refine(F.split("text", "\n"), 2000).alias("refine"))


@query("""
SELECT doc_id, CAST(greatest(3, least(40, 2000 // greatest(1, list_sum([length(x) for x in l]) // greatest(len(l), 1)))) AS INTEGER) AS budget
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
""")
def t10_line_budget(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", arrays.line_budget(F.split("text", "\n"), 2000).alias("budget"))


@query(r"""
SELECT source, count(*) FILTER (regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS mail, count(*) FILTER (regexp_matches(text, '\+?[0-9][0-9 ()-]{8,}[0-9]')) AS phone,
  count(*) FILTER (regexp_matches(text, '(?i)(password|passwd|secret|token|api_?key)["'']?\s*[:=]')) AS secret, count(*) FILTER (regexp_matches(text, '(?i)ignore (all|previous) instructions')) AS injection
FROM documents GROUP BY source
""")
def p37_redlines(spark, sf_dir):
    """Documents with mail addresses, phone numbers, secrets and prompt injections, by source."""
    found = {
        "mail": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
        "phone": r"\+?[0-9][0-9 ()-]{8,}[0-9]",
        "secret": r"(?i)(password|passwd|secret|token|api_?key)[\"']?\s*[:=]",
        "injection": r"(?i)ignore (all|previous) instructions",
    }
    return table(spark, sf_dir, "documents").groupBy("source").agg(*(F.count(F.when(F.col("text").rlike(p), 1)).alias(k) for k, p in found.items()))


@query("""
SELECT a.vec_id AS a, b.vec_id AS b, greatest(-1.0, least(1.0, list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
  / sqrt(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])) * list_inner_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))))) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def g17_cosine(spark, sf_dir):
    """Cosine of every vector with the next."""
    a = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("a"), F.col("embedding").alias("x"))
    b = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("b"), (F.col("vec_id") - 1).alias("a"), F.col("embedding").alias("y"))
    return a.join(b, "a").select("a", "b", arrays.cosine(F.col("x"), F.col("y")).alias("cosine"))
