"""Derived records: golden versions, refinements, plans, buckets, views and exports, read and written as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.functions.checks import credential_patterns

SPLITS = ("calibration", "regression", "holdout")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def read_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a schema; the first line that is no such JSON fails the query. Empty lines are none."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def frozen_rows(spark: SparkSession, root: str, version: str, schema: str) -> DataFrame:
    """The golden rows of a version with their split, which is the name of their file, in __split__."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", "{" + ",".join(f"{s}.jsonl" for s in SPLITS) + "}").json(f"{root}/{version}")
    return rows.withColumn("__split__", F.regexp_replace(file_name(F.col("_metadata.file_path")), r"\.jsonl$", ""))


def version_list(spark: SparkSession, root: str) -> DataFrame:
    """(version) as numbers of the folders v<n> under root that hold a manifest or a split file."""
    names = ",".join(["manifest.json", *(f"{s}.jsonl" for s in SPLITS)])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "{" + names + "}").load(root)
    number = F.regexp_extract("path", r"/v([0-9]+)/[^/]+$", 1)
    return files.select(number.alias("v")).where("v <> ''").select(F.col("v").cast("int").alias("version")).distinct()


def refinements(spark: SparkSession, path: str, schema_version: str) -> DataFrame:
    """(archive, body_key, lines) of a refinement side table; files of another schema version refine nothing."""
    rows = spark.read.schema("archive STRING, schema_version STRING, body_key STRING, lines ARRAY<STRING>").json(path)
    return rows.where(F.col("schema_version") == schema_version).select("archive", "body_key", "lines")


def plan_entries(plans: DataFrame) -> DataFrame:
    """(task_id, query, rewritten, skip_reason) of plans(entries array<struct<task_id,query,rewritten>>): every entry stays, and
    those that cannot run say why."""
    rows = plans.select(F.explode("entries").alias("e")).select("e.*")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    reason = F.when(blank(F.col("task_id")), "no_task_id").when(blank(F.col("query")), "no_query").when(~F.coalesce("rewritten", F.lit(False)), "not_rewritten")
    return rows.select("task_id", "query", "rewritten", reason.alias("skip_reason"))


def media_index(probes: DataFrame) -> DataFrame:
    """(task_id, url, outcome) of probes(task_id, final_url, outcome, file): the last file, by name, counts."""
    return probes.groupBy("task_id", F.col("final_url").alias("url")).agg(F.max_by("outcome", "file").alias("outcome"))


def scout_records(spark: SparkSession, root: str, buckets: Sequence[str], schema: str) -> DataFrame:
    """The records of the buckets asked for, with their bucket, which is the name of their file."""
    rows = spark.read.schema(schema).option("pathGlobFilter", "{" + ",".join(f"{b}.jsonl" for b in buckets) + "}").json(root)
    return rows.withColumn("bucket", F.regexp_replace(file_name(F.col("_metadata.file_path")), r"\.jsonl$", ""))


def view_records(messages: DataFrame, calls: DataFrame, meta: DataFrame, key: str = "sample_id") -> DataFrame:
    """The three views of each sample side by side; a sample that lacks one is marked incomplete."""
    named = [df.select(key, F.struct(*(c for c in df.columns if c != key)).alias(name)) for df, name in ((messages, "messages"), (calls, "calls"), (meta, "meta"))]
    rows = named[0].join(named[1], key, "full").join(named[2], key, "full")
    return rows.withColumn("complete", F.col("messages").isNotNull() & F.col("calls").isNotNull() & F.col("meta").isNotNull())


def latest_annotations(tasks: DataFrame) -> DataFrame:
    """(task, golden_id, verdict, branch, annotator) of tasks(task, golden_id, annotations array<struct<updated_at, cancelled,
    annotator, verdict, branch>>): the latest annotation that is not cancelled; tasks without one are left out."""
    each = tasks.select("task", "golden_id", F.explode("annotations").alias("a")).where(~F.coalesce("a.cancelled", F.lit(False)))
    last = each.groupBy("task", "golden_id").agg(F.max_by("a", F.struct("a.updated_at", "a.annotator")).alias("a"))
    return last.select("task", "golden_id", "a.verdict", "a.branch", "a.annotator")


def clauses(text: Column) -> Column:
    """(clause, text) of a rubric in markdown: headings '## <clause>' and what follows each up to the next, trimmed."""
    parts = F.slice(F.split(F.concat(F.lit("\n"), text), r"\n##[ \t]+"), 2, 1 << 30)
    head, body = (lambda p: F.trim(F.substring_index(p, "\n", 1))), (lambda p: F.regexp_replace(F.regexp_replace(p, r"^[^\n]*\n?", ""), r"^\s+|\s+$", ""))
    return F.transform(parts, lambda p: F.struct(head(p).alias("clause"), body(p).alias("text")))


def changelog_entries(lines: DataFrame, width: int) -> DataFrame:
    """(at, cells) of the rows of a markdown table in lines(at, line); a row of another width than the table's is an error."""
    row = F.trim("line").startswith("|") & ~F.col("line").rlike(r"^\s*[|][\s:|-]+$")
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^[|]|[|]$", ""), "[|]"), lambda c: F.trim(c))
    rows = lines.where(row).select("at", cells.alias("cells"))
    stop = F.raise_error(F.concat(F.lit("malformed table row at line "), F.col("at").cast("string"))).cast("array<string>")
    rows = rows.withColumn("cells", F.when(F.size("cells") == width, F.col("cells")).otherwise(stop))
    first = rows.agg(F.min("at").alias("head"))
    return rows.join(F.broadcast(first), F.col("at") > F.col("head")).select("at", "cells")


def safe_archives(archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(safe, refused) of archives(name, raw): those with anything like a credential are not written; refused(name, classes)
    tells what was found, never the text."""
    found = archives.withColumn("_classes", credential_patterns(F.col("raw")))
    safe = found.where(F.size("_classes") == 0).drop("_classes")
    return safe, found.where(F.size("_classes") > 0).select("name", F.col("_classes").alias("classes"))


def write_archives(archives: DataFrame, path: str) -> DataFrame:
    """Appends the safe ones of archives(name, raw) to a table of archives and returns the refused ones; names that the table
    has already, and repeated ones, are not written again."""
    safe, refused = safe_archives(archives)
    append_missing(safe, path, ["name"])
    return refused


def append_missing(rows: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str] = ()) -> None:
    """Appends the rows whose keys the Parquet table at path lacks, one of each; a table that does not exist yet is made."""
    spark = rows.sparkSession
    once = rows.dropDuplicates(list(keys))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        exists = bool(found.load(path).select("path").take(1))
    except Exception as e:  # Spark has no test for a folder; anything but a missing one is an error
        if "PATH_NOT_FOUND" not in str(e):
            raise
        exists = False
    if exists:
        once = once.join(spark.read.parquet(path).select(*keys).distinct(), list(keys), "left_anti")
    once.write.mode("append").partitionBy(*partitions).parquet(path)


def write_samples(samples: DataFrame, path: str, account: DataFrame | None = None) -> dict[str, int]:
    """Samples by pool and surface, those of new ids only, and counters of the batch: seen, and left out by reason."""
    append_missing(samples, f"{path}/samples", ["run"], ["pool", "surface"])
    counters = {"seen": samples.count()}
    if account is not None:  # reasons are a closed set
        counters |= {f"out_{r.reason}": r.n for r in account.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    return counters


def write_views(views: dict[str, DataFrame], path: str) -> None:
    """Each view as a table of its own; all of them are planned before the first is written, and an existing view is replaced."""
    for df in views.values():
        df.schema  # noqa: B018  analysis fails before anything is written
    for name, df in views.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_snapshot(entries: DataFrame, path: str, order: Sequence[str]) -> None:
    """A snapshot as one JSON-lines file in a fixed order and without times, so that equal snapshots are equal files. A
    snapshot is a golden set's size, a few thousand rows, and meant to be compared by eye."""
    entries.select(*sorted(entries.columns)).coalesce(1).sortWithinPartitions(*order).write.mode("overwrite").json(path)


def pointers(files: DataFrame) -> DataFrame:
    """(session, files) of files(session, file, content): name, size and digest of what a session's parts hold, in order."""
    one = F.struct("file", F.length(F.col("content").cast("binary")).alias("bytes"), F.sha2(F.col("content").cast("binary"), 256).alias("sha256"))
    return files.groupBy("session").agg(F.array_sort(F.collect_list(one)).alias("files"))


def tuning_rows(messages: DataFrame, mode: str) -> DataFrame:
    """Rows to tune on, of messages(session, at, role, content): chat gives a row per session with all its messages; completion
    one per assistant message, with everything before as its prompt."""
    if mode == "chat":
        return messages.groupBy("session").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "role", "content"))), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))
    if mode != "completion":
        raise ValueError(f"unknown mode {mode!r}: chat or completion")
    order = W.partitionBy("session").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    line = F.concat(F.lit("<"), "role", F.lit("> "), "content")
    rows = messages.withColumn("prompt", F.array_join(F.collect_list(line).over(order), "\n"))
    return rows.where("role = 'assistant'").select("session", "at", "prompt", F.col("content").alias("completion"))


def write_tuning(rows: DataFrame, path: str, form: str) -> None:
    """As JSON lines or Parquet; any other form is an error."""
    if form not in ("jsonl", "parquet"):
        raise ValueError(f"unknown form {form!r}: jsonl or parquet")
    (rows.write.mode("overwrite").json if form == "jsonl" else rows.write.mode("overwrite").parquet)(path)


def migrated(delivered: DataFrame, surfaces: Sequence[str]) -> DataFrame:
    """delivered(group, file, surface) with the pool each file belongs to: a group whose primary file is of another surface than
    those delivered moves to legacy as a whole, files without a surface with it; groups that tell no surface stay, unclassified."""
    told = delivered.groupBy("group").agg(F.max("surface").alias("_surface"))
    pool = F.when(F.col("_surface").isNull(), "unclassified").when(F.col("_surface").isin(list(surfaces)), "delivery").otherwise("legacy")
    return delivered.join(told, "group").withColumn("pool", pool).drop("_surface")
