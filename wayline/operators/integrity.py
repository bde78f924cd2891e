"""Integrity of run archives: everything that is wrong with them, each with its severity and its JSON path."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.functions.python import paths_of_leaves
from wayline.operators.matching import match_visits
from wayline.session import stored

FATAL, DEGRADED, INFO, NEGATIVE = "FATAL", "DEGRADED", "INFO", "NEGATIVE"
#: What stands for bytes that could not be read; the text behind it is gone.
REPLACEMENT = "�"

PAGE = "STRUCT<url:STRING,body_text:STRING,body_preview:STRING,video_tag_count:STRING>"
DOCUMENT = f"""STRUCT<task_id:STRING,user_prompt:STRING,run_config:STRING,steps:ARRAY<STRING>,search_observation:{PAGE},
  visits:ARRAY<STRUCT<url:STRING,landed_url:STRING,success:STRING,steps:ARRAY<STRING>,site_obs:{PAGE},player_obs:{PAGE}>>,
  outcomes:ARRAY<STRUCT<url:STRING,site_url:STRING,branch:STRING,evidence:STRING,source:STRING>>>"""

#: Archives with more pairs of a visit and an outcome than these are matched by joins.
PAIRS = 10_000


def said(text: Column) -> Column:
    """Whether a value, as JSON text, is there and neither empty, zero nor false."""
    return F.coalesce(~text.isin("", "{}", "[]", "0", "0.0", "false", "null"), F.lit(False))


def opened(files: DataFrame) -> DataFrame:
    """files(run, raw) with `doc` and `problem`: not_utf8 where raw is null, bad_json where it is no JSON, else null. What parsed() gives stays as it is."""
    if "problem" in files.columns:
        return files
    rows = files.select("run", "raw", F.from_json("raw", DOCUMENT).alias("doc"), F.try_parse_json("raw").isNull().alias("bad"))
    problem = F.when(F.col("raw").isNull(), "not_utf8").when(F.col("bad") | F.col("doc").isNull(), "bad_json")
    return rows.select("run", "raw", "doc", problem.alias("problem"))


def parsed(files: DataFrame, *fields: str) -> DataFrame:
    """opened(), worked out once for all that asks for it, with these fields of the documents alone if any are named.

    Only texts that may hold the replacement character are kept.
    """
    raw = F.when(F.contains("raw", F.lit(REPLACEMENT)) | F.col("raw").rlike(r"\\u[fF]{3}[dD]"), F.col("raw"))
    rows = opened(files)
    if fields:
        return stored(rows.select("run", F.struct(*(f"doc.{name}" for name in fields)).alias("doc"), "problem"))
    return stored(rows.withColumn("raw", raw))


def _found(code: str, severity: str | Column, at: Column | str, when: Column) -> Column:
    """A finding where the condition holds, else null."""
    level = F.lit(severity) if isinstance(severity, str) else severity
    where = F.lit(at) if isinstance(at, str) else at
    return F.when(when, F.struct(F.lit(code).alias("code"), level.alias("severity"), where.alias("path")))


def _page(page: Column, at: Column) -> list[Column]:
    """A page that was seen but not kept whole."""
    there = page.isNotNull() & (F.to_json(page) != "{}") & ~said(page["body_text"])
    preview = said(page["body_preview"])
    return [_found("body_preview_only", DEGRADED, at, there & preview), _found("no_body", DEGRADED, at, there & ~preview)]


def _each(rows: DataFrame, checks: list[Column]) -> DataFrame:
    return rows.select("run", F.inline(F.array_compact(F.array(*checks))))


def _damaged(good: DataFrame) -> DataFrame:
    """Every string that holds the replacement character. Only archives whose text has one are walked: parsed() keeps no other texts."""
    paths = good.where("raw IS NOT NULL").select("run", F.explode(paths_of_leaves("raw", F.lit(REPLACEMENT))).alias("path"))
    evidence = F.col("path").rlike(r"^\$\.outcomes\[.*\.evidence$")
    return paths.select("run", F.when(evidence, "evidence_mojibake").otherwise("mojibake").alias("code"), F.when(evidence, FATAL).otherwise(DEGRADED).alias("severity"), "path")


def visits_and_outcomes(good: DataFrame) -> tuple[DataFrame, DataFrame]:
    """visits(run, visit, url, landed_url, player_url, v) and outcomes(run, idx, url, site_url, branch, evidence, source, task), places from 0."""
    visits = good.select("run", F.posexplode("doc.visits").alias("visit", "v"))
    visits = visits.select("run", "visit", *[F.coalesce(c, F.lit("")).alias(n) for n, c in (("url", F.col("v.url")), ("landed_url", F.col("v.landed_url")), ("player_url", F.col("v.player_obs.url")))], "v")
    return visits, outcomes_of(good)


def outcomes_of(good: DataFrame) -> DataFrame:
    outcomes = good.select("run", F.coalesce("doc.task_id", F.lit("")).alias("task"), F.posexplode("doc.outcomes").alias("idx", "o"))
    return outcomes.select("run", "idx", "o.url", "o.site_url", "o.branch", "o.evidence", "o.source", "task")


def _beside(good: DataFrame) -> DataFrame:
    """visits(run, visit, v, matched, branch, source) of archives, each matched beside its outcomes as match_visits() does, without a shuffle.

    Every visit is held against all outcomes of its archive, so this is for archives with few of them.
    """
    last_first = F.reverse("doc.outcomes")
    rows = good.select("run", F.size("doc.outcomes").alias("n"), *(last_first[name].alias(f"{name}s") for name in ("url", "site_url", "branch", "source")), F.posexplode("doc.visits").alias("visit", "v"))

    def place(key: Column) -> Column:
        """The place from 1, last ones first, of the first outcome that a key meets; null for none."""
        at = [F.nullif(F.array_position(name, key), F.lit(0)) for name in ("urls", "site_urls")]
        return F.when(key != "", F.least(*at))

    found = F.coalesce(place(F.col("v.url")), place(F.col("v.landed_url")), place(F.col("v.player_obs.url"))).cast("int")
    rows = rows.select("run", "visit", "v", "branchs", "sources", found.alias("at"))
    of = lambda name: F.get(name, F.col("at") - 1)
    return rows.select("run", "visit", "v", F.col("at").isNotNull().alias("matched"), of("branchs").alias("branch"), of("sources").alias("source"))


def matched_visits(good: DataFrame) -> DataFrame:
    """visits(run, visit, v, matched, branch, source) of archives: of those with many visits and outcomes by joins, of all others beside their outcomes."""
    many = F.coalesce(F.size("doc.visits").cast("long") * F.size("doc.outcomes") > PAIRS, F.lit(False))
    visits, outcomes = visits_and_outcomes(good.where(many))
    joined = match_visits(visits, outcomes).join(outcomes.select("run", F.col("idx").alias("outcome"), "branch", "source"), ["run", "outcome"], "left")
    return _beside(good.where(~many)).unionByName(joined.select("run", "visit", "v", "matched", "branch", "source"))


def archive_findings(files: DataFrame) -> DataFrame:
    """(run, code, severity, path) of what is wrong with each archive by itself; files(run, raw) or parsed() ones."""
    rows = files if "problem" in files.columns else parsed(files)  # read and parsed once, asked several times
    good = rows.where("problem IS NULL")
    broken = rows.where("problem IS NOT NULL").select("run", F.col("problem").alias("code"), F.lit(FATAL).alias("severity"), F.lit("$").alias("path"))
    doc = F.col("doc")
    whole = _each(
        good,
        [
            _found("missing_task_id", FATAL, "$.task_id", ~said(doc["task_id"])),
            _found("steps_missing", DEGRADED, "$.steps", F.coalesce(F.size(doc["steps"]) < 1, F.lit(True))),
            _found("user_prompt_missing", DEGRADED, "$.user_prompt", ~said(doc["user_prompt"])),
            _found("run_config_missing", DEGRADED, "$.run_config", ~said(doc["run_config"])),
            *_page(doc["search_observation"], F.lit("$.search_observation")),
        ],
    )
    outcomes = outcomes_of(good)
    matched = matched_visits(good)
    at, v = F.concat(F.lit("$.visits["), F.col("visit").cast("string"), F.lit("]")), F.col("v")
    succeeded, won = said(v["success"]), F.col("matched") & F.col("branch").isNull()
    bare = lambda page: F.coalesce(page["video_tag_count"].try_cast("bigint"), F.lit(0)) == 0
    by_visit = _each(
        matched,
        [
            _found("steps_missing", DEGRADED, F.concat(at, F.lit(".steps")), F.coalesce(F.size(v["steps"]) < 1, F.lit(True))),
            *_page(v["site_obs"], F.concat(at, F.lit(".site_obs"))),
            *_page(v["player_obs"], F.concat(at, F.lit(".player_obs"))),
            _found("outcome_missing", DEGRADED, at, ~F.col("matched")),
            _found("success_branch_mismatch", DEGRADED, F.concat(at, F.lit(".success")), F.col("matched") & (succeeded != F.col("branch").isNull())),
            _found(
                "success_without_media",
                F.when(F.col("source") == "llm", INFO).otherwise(FATAL),
                F.concat(at, F.lit(".player_obs.video_tag_count")),
                won & succeeded & bare(v["player_obs"]) & bare(v["site_obs"]),
            ),
        ],
    )
    empty = F.col("branch").isNotNull() & (F.trim(F.coalesce("evidence", F.lit(""))) == "")
    by_outcome = _each(outcomes, [_found("evidence_empty", FATAL, F.format_string("$.outcomes[%d].evidence", "idx"), empty)])
    found = broken
    for part in (_damaged(good), whole, by_visit, by_outcome):
        found = found.unionByName(part)
    return found


def negatives(files: DataFrame, not_pooled: Collection[str], excluded: DataFrame | None = None) -> DataFrame:
    """(run, idx, task, url, branch) of the outcomes that belong into the pool.

    not_pooled: branches that never do. excluded(run, idx): outcomes on platforms a task excludes; all outcomes of their run
    with the same url and branch stay out too.
    """
    outcomes = outcomes_of(opened(files).where("problem IS NULL"))
    rows = outcomes.where(F.col("branch").isNotNull() & ~F.col("branch").isin(*not_pooled)).select("run", "idx", "task", F.trim(F.coalesce("url", F.lit(""))).alias("url"), "branch")
    if excluded is None:
        return rows
    out = rows.join(excluded, ["run", "idx"]).select("run", "url", "branch").distinct()
    return rows.join(out, ["run", "url", "branch"], "left_anti").select("run", "idx", "task", "url", "branch")


def not_in_pool(belonging: DataFrame, pool: DataFrame, quarantined: DataFrame) -> DataFrame:
    """(run, code, severity, path) of negatives() that the pool(task_id, url, branch) lacks; urls in quarantine are not missed."""
    held = pool.select(F.coalesce("task_id", F.lit("")).alias("task"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("branch", F.lit("")).alias("branch")).distinct()
    missed = belonging.join(quarantined.select("url").distinct(), "url", "left_anti").join(held, ["task", "url", "branch"], "left_anti")
    return missed.select("run", F.lit("negative_not_pooled").alias("code"), F.lit(DEGRADED).alias("severity"), F.format_string("$.outcomes[%d]", "idx").alias("path"))


def contradicted(files: DataFrame, pool: DataFrame, quarantined: DataFrame) -> DataFrame:
    """(task_id, url, branch, n_archives, first_run, severity) of pool rows whose url an archive calls a success."""
    outcomes = outcomes_of(opened(files).where("problem IS NULL"))
    won = outcomes.where("branch IS NULL").select(F.trim("url").alias("url"), "run").where("url <> ''")
    won = won.groupBy("url").agg(F.count("*").alias("n_archives"), F.min("run").alias("first_run"))
    rows = pool.withColumn("url", F.trim("url")).join(quarantined.select("url").distinct(), "url", "left_anti").join(won, "url")
    return rows.select("task_id", "url", "branch", "n_archives", "first_run", F.lit(FATAL).alias("severity"))


def report(files: DataFrame, findings: DataFrame, belonging: DataFrame) -> DataFrame:
    """(run, sites, outcomes, negatives, fatal, degraded, ok) of each archive."""
    size = lambda name: F.greatest(F.coalesce(F.size(f"doc.{name}"), F.lit(0)), F.lit(0)).alias("sites" if name == "visits" else name)
    level = lambda name: F.count_if(F.col("severity") == name)
    every = findings.select("run", "severity").unionByName(belonging.select("run", F.lit(NEGATIVE).alias("severity")))
    told = every.groupBy("run").agg(level(FATAL).alias("fatal"), level(DEGRADED).alias("degraded"), level(NEGATIVE).alias("negatives"))
    rows = opened(files).select("run", size("visits"), size("outcomes")).join(told, "run", "left")
    count = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return rows.select("run", "sites", "outcomes", count("negatives"), count("fatal"), count("degraded"), (F.coalesce("fatal", F.lit(0)) == 0).alias("ok"))


def composition(samples: DataFrame, views: DataFrame, tasks: DataFrame) -> DataFrame:
    """(missing_from, present_in, n) of the ids that one derived set has and another lacks; all sets have a column id."""
    marked = [frame.select("id").distinct().select("id", *[F.lit(name == mine).alias(name) for name in ("samples", "views", "tasks")]) for mine, frame in (("samples", samples), ("views", views), ("tasks", tasks))]
    each = marked[0].unionByName(marked[1]).unionByName(marked[2]).groupBy("id").agg(*[F.bool_or(n).alias(n) for n in ("samples", "views", "tasks")])
    pairs = [("samples", "views"), ("views", "samples"), ("samples", "tasks"), ("tasks", "samples")]
    lacks = F.array_compact(F.array(*[F.when(~F.col(a) & F.col(b), F.struct(F.lit(a).alias("missing_from"), F.lit(b).alias("present_in"))) for a, b in pairs]))
    return each.select(F.inline(lacks)).groupBy("missing_from", "present_in").agg(F.count("*").alias("n"))
