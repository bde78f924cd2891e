"""Run archives and append-only logs as DataFrames."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OBSERVATION = """STRUCT<url:STRING,page_title:STRING,body_text:STRING,body_preview:STRING,body_len:INT,truncated:BOOLEAN,degraded:ARRAY<STRING>,
  video_tag_count:INT,iframe_count:INT,interactive_elements:ARRAY<STRUCT<ref:STRING,tag:STRING,label:STRING,role:STRING,name:STRING>>,links:ARRAY<STRUCT<text:STRING,href:STRING>>>"""
STEP = f"STRUCT<action:STRUCT<tool:STRING,params:MAP<STRING,STRING>,target:MAP<STRING,STRING>,origin:STRING>,observation:{OBSERVATION},error:STRING,duration_ms:BIGINT>"
ARCHIVE = f"""STRUCT<schema_version:STRING,task_id:STRING,run_id:STRING,query:STRING,user_prompt:STRING,driver:STRING,search_blocked:STRING,judgement_trustworthy:BOOLEAN,
  run_config:STRUCT<max_candidates:STRING,max_per_host:INT>,warnings:ARRAY<STRING>,steps:ARRAY<{STEP}>,search_observation:{OBSERVATION},
  candidates:ARRAY<STRUCT<url:STRING,text:STRING,rank:INT,host:STRING>>,
  visits:ARRAY<STRUCT<url:STRING,landed_url:STRING,player_url:STRING,success:BOOLEAN,steps:ARRAY<{STEP}>>>,
  outcomes:ARRAY<STRUCT<url:STRING,site_url:STRING,play_page_url:STRING,branch:STRING,evidence:STRING,question:STRING,source:STRING,reached_play_page:BOOLEAN>>>"""


def has_key(raw: Column, path: str, key: str) -> Column:
    """Whether a JSON object holds a key, null values too: what a fixed schema cannot tell."""
    return F.coalesce(F.array_contains(F.json_object_keys(F.get_json_object(raw, path)), key), F.lit(False))


def select_archives(files: DataFrame) -> DataFrame:
    """Of files(name, raw) those named <task>__<run>; a reviewed version stands in for its original."""
    base = F.regexp_replace("name", r"(\.reviewed)?\.json$", "")
    rows = files.where(F.col("name").rlike(r"__.*\.json$")).withColumn("base", base).withColumn("reviewed", F.endswith("name", F.lit(".reviewed.json")))
    best = rows.groupBy("base").agg(F.max(F.struct("reviewed", "name", "raw")).alias("file"))
    return best.select(F.col("file.name").alias("name"), F.split_part("base", F.lit("__"), F.lit(1)).alias("file_task"), F.regexp_extract("base", "__(.*)$", 1).alias("run"), "file.reviewed", "file.raw")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """files(name, raw) of a folder, whole files; bytes that are no UTF-8 stay to be told by integrity()."""
    rows = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return rows.select("name", F.when(F.is_valid_utf8("content"), F.col("content").cast("string")).alias("raw"))


def parse_archives(files: DataFrame) -> DataFrame:
    """Typed archives with what is wrong with them: not_utf8, bad_json, no_task_id, or null."""
    doc = F.from_json("raw", ARCHIVE, {"mode": "PERMISSIVE"})
    rows = files.withColumn("doc", doc)
    whole = F.try_parse_json("raw").isNotNull() if hasattr(F, "try_parse_json") else F.col("doc").isNotNull()
    problem = F.when(F.col("raw").isNull(), "not_utf8").when(~F.coalesce(whole, F.lit(False)), "bad_json").when(F.coalesce("doc.task_id", F.lit("")) == "", "no_task_id")
    return rows.withColumn("problem", problem).withColumn("has_prompt", has_key(F.col("raw"), "$", "user_prompt"))


def visits_of(archives: DataFrame) -> DataFrame:
    """visits(run, visit from 1, url, landed_url, player_url, success, n_steps)."""
    rows = archives.where("problem is null").select("run", F.posexplode("doc.visits").alias("at", "v"))
    return rows.select("run", (F.col("at") + 1).alias("visit"), "v.url", "v.landed_url", "v.player_url", "v.success", F.coalesce(F.size("v.steps"), F.lit(0)).alias("n_steps"))


def outcomes_of(archives: DataFrame) -> DataFrame:
    """outcomes(run, idx from 0, url, site_url, branch, evidence, question, source) in the order they were written."""
    rows = archives.where("problem is null").select("run", F.posexplode("doc.outcomes").alias("idx", "o"))
    return rows.select("run", "idx", "o.url", "o.site_url", "o.branch", "o.evidence", "o.question", "o.source")


def steps_of(archives: DataFrame) -> DataFrame:
    """steps(run, unit, step, tool, params, target, origin, url, body, error): the search is unit 0, visits follow."""
    every = F.concat(F.array(F.col("doc.steps")), F.transform("doc.visits", lambda v: v["steps"]))
    rows = archives.where("problem is null").select("run", F.posexplode(F.coalesce(every, F.array(F.col("doc.steps")))).alias("unit", "steps"))
    rows = rows.select("run", "unit", F.posexplode("steps").alias("step", "s"))
    body = F.coalesce("s.observation.body_text", "s.observation.body_preview")
    return rows.select("run", "unit", "step", "s.action.tool", "s.action.params", "s.action.target", F.coalesce("s.action.origin", F.lit("model")).alias("origin"), F.col("s.observation.url").alias("url"), body.alias("body"), "s.error")


def tolerant_pool(lines: DataFrame, schema: str) -> DataFrame:
    """JSON lines parsed where they can be; bad ones are kept as they are and marked."""
    return lines.select(F.col("value").alias("raw"), F.from_json("value", schema).alias("row"), F.try_parse_json("value").isNull().alias("bad"))


def json_objects(text: str) -> list[str]:
    """The top-level objects of concatenated JSON, each as written; what is no object is passed over."""
    decoder, found, at = json.JSONDecoder(), [], text.find("{")
    while at >= 0:
        try:
            _, end = decoder.raw_decode(text, at)
        except ValueError:
            end = at + 1
        else:
            found.append(text[at:end])
        at = text.find("{", end)
    return found


def split_objects(files: DataFrame) -> DataFrame:
    """(name, seq, event) of files(name, raw) that hold concatenated JSON objects."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(name, k, x) for name, raw in zip(batch["name"], batch["raw"], strict=True) for k, x in enumerate(json_objects(raw or ""))]
            yield pd.DataFrame(rows, columns=["name", "seq", "event"])

    return files.select("name", "raw").mapInPandas(run, "name string, seq int, event string")


def append_new(pool: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows to append: those whose key the pool lacks, of equal keys the row of the smallest hash."""
    rest = [F.col(name) for name in rows.columns if name not in keys]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.xxhash64(*rest) if rest else F.lit(1)))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank").join(pool.select(*keys).distinct(), keys, "left_anti")


def sweep(delivered: DataFrame, roster: DataFrame, key: str) -> DataFrame:
    """delivered with the pool each row belongs to; an empty roster sweeps nothing, it is an error."""
    if not roster.take(1):
        raise ValueError("empty roster: refusing to quarantine everything")
    on = roster.select(key).distinct().withColumn("_on", F.lit(True))
    return delivered.join(on, key, "left").withColumn("pool", F.when(F.col("_on"), "delivery").otherwise("quarantine")).drop("_on")
