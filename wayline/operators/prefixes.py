"""Which paths begin with which, and gotos that nothing seen before explains.

Paths are sorted by (group, path) over ranges of a global order. All paths between a beginning and a path that goes on from it
go on from it too, so one pass with a stack of open beginnings meets every pair, and a beginning that reaches over
a border is a beginning of the first path behind it: only those are carried into later ranges. A group may thus hold any share of all rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.session import settled

ROOT = "/"


def _ranges(rows: DataFrame) -> DataFrame:
    """rows with `part`: the range they belong to, and once more for each later range that they reach into."""
    placed = rows.repartitionByRange("group", "path").withColumn("part", F.spark_partition_id())
    placed = settled(placed)  # the borders must be those of the ranges
    # one border a partition
    borders = sorted((r["first"]["group"], r["first"]["path"], r["part"]) for r in placed.groupBy("part").agg(F.min(F.struct("group", "path")).alias("first")).collect())
    firsts = [(group.encode(), path.encode()) for group, path, _ in borders]

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            at, part = [], []
            for i, (group, path, own) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("group", "path", "part")), strict=True)):
                g, p = group.encode(), path.encode()
                k = bisect_left(firsts, (g, p))
                while k < len(firsts) and firsts[k][0] == g and firsts[k][1].startswith(p):
                    if borders[k][2] > own:
                        at.append(i)
                        part.append(borders[k][2])
                    k += 1
            if at:
                more = batch.take(pa.array(at))
                columns = [pa.array(part, pa.int32()) if name == "part" else more.column(name) for name in batch.schema.names]
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return placed.mapInArrow(carried, placed.schema)


def prefix_meetings(rows: DataFrame, pairs: bool = False) -> DataFrame:
    """Which asked paths meet an anchor: one is a beginning of the other, character by character; the root meets the root alone.

    rows(group, path, first, asked): one row for each group and path; first is not null where the path is an anchor, asked whether it is
    asked for. Gives (group, path, first), the smallest first of all anchors that an asked path meets, or with `pairs`
    (group, path, anchor). Empty paths are the root.
    """
    schema = "group string, path string, " + ("anchor string" if pairs else "first long")
    rows = rows.select("group", F.when(F.col("path") == "", ROOT).otherwise(F.col("path")).alias("path"), F.col("first").cast("long").alias("first"), "asked")
    rows = rows.groupBy("group", "path").agg(F.min("first").alias("first"), F.bool_or("asked").alias("asked"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[list] = []  # [group, path, first, asked, smallest first met]
        out: list[tuple] = []

        def close(entry: list) -> None:
            if not pairs and entry[3] and entry[4] is not None:
                out.append((entry[0], entry[1], entry[4]))

        def packed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[], [], []]
            kinds = [pa.string(), pa.string(), pa.string() if pairs else pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["group", "path", "anchor" if pairs else "first"])

        for batch in batches:
            for group, path, first, asked in zip(*(batch.column(c).to_pylist() for c in ("group", "path", "first", "asked")), strict=True):
                while open_ and not (open_[-1][0] == group and path.startswith(open_[-1][1])):
                    close(open_.pop())
                best = first
                for entry in open_:
                    if entry[1] == ROOT:
                        continue
                    if first is not None and entry[3]:
                        if pairs:
                            out.append((group, entry[1], path))
                        elif entry[4] is None or first < entry[4]:
                            entry[4] = first
                    if asked and entry[2] is not None:
                        if pairs:
                            out.append((group, path, entry[1]))
                        elif best is None or entry[2] < best:
                            best = entry[2]
                if pairs and asked and first is not None:
                    out.append((group, path, path))
                open_.append([group, path, first, asked, best])
                if len(out) > 10_000:
                    yield packed()
                    out.clear()
        while open_:
            close(open_.pop())
        yield packed()

    dealt = _ranges(rows).repartition("part").sortWithinPartitions("part", "group", "path")
    # ranges that meet in one task stay apart: what is carried into a later one is told as its own
    met = dealt.withColumn("group", F.concat_ws("\x00", F.col("part").cast("string"), "group")).mapInArrow(meet, schema)
    met = met.withColumn("group", F.substring_index("group", "\x00", -1))
    return met.distinct() if pairs else met.groupBy("group", "path").agg(F.min("first").alias("first"))


def site_of(url: Column) -> list[Column]:
    """Host in small letters, path without trailing slashes, and query of an absolute url; the host of others is empty."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    bare = F.rtrim(path, F.lit("/"))
    return [host, F.when(bare == "", ROOT).otherwise(bare), F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)]


def untraced_gotos(anchors: DataFrame, gotos: DataFrame) -> DataFrame:
    """gotos(run, at, url, landed) with `traced`: whether something seen before explains them; null where they have no url.

    anchors(run, at, url): urls that were seen at a place; one explains gotos at later places. A goto is traced if its url was
    seen as it is, or with the same host, path and query; or if the host and path it landed on meet those of an
    anchor, one path a beginning of the other. Empty urls anchor nothing.
    """
    url = F.trim(F.coalesce("url", F.lit("")))
    host, path, rest = site_of(F.col("url"))
    seen = anchors.select("run", "at", url.alias("url")).where("url <> ''").select("*", host.alias("host"), path.alias("path"), rest.alias("rest"))
    asked = gotos.select("run", "at", "url", "landed", F.coalesce("url", F.lit("")).alias("u"), F.coalesce("landed", F.lit("")).alias("l"))
    own, land = site_of(F.col("u")), site_of(F.col("l"))
    asked = asked.select("*", own[0].alias("host"), own[1].alias("path"), own[2].alias("rest"), F.to_json(F.array(F.col("run").cast("string"), land[0])).alias("group"), land[0].alias("land"), land[1].alias("landing"))
    earliest = lambda keys, name: seen.groupBy(*keys).agg(F.min("at").alias(name))
    by_url = earliest(["run", "url"], "t1").withColumnRenamed("url", "u")
    by_site = earliest(["run", "host", "path", "rest"], "t2").where("host <> ''")
    group = F.to_json(F.array(F.col("run").cast("string"), F.col("host"))).alias("group")
    anchored = seen.where("host <> ''").select(group, "path", F.col("at").alias("first"), F.lit(False).alias("asked"))
    wanted = asked.where("land <> ''").select("group", F.col("landing").alias("path"), F.lit(None).cast("long").alias("first"), F.lit(True).alias("asked"))
    by_landing = prefix_meetings(anchored.unionByName(wanted)).select("group", F.col("path").alias("landing"), F.col("first").alias("t3"))
    found = asked.join(by_url, ["run", "u"], "left").join(by_site, ["run", "host", "path", "rest"], "left").join(by_landing, ["group", "landing"], "left")
    before = F.least("t1", "t2", "t3")
    traced = F.when(F.col("u") != "", F.coalesce(before < F.col("at"), F.lit(False)))
    return found.select("run", "at", "url", "landed", traced.alias("traced"))


def trace_account(told: DataFrame) -> DataFrame:
    """(run, checked, traced, skipped, violations) of each run's untraced_gotos()."""
    return told.groupBy("run").agg(
        F.count("traced").alias("checked"),
        F.count_if("traced").alias("traced"),
        F.count_if(F.col("traced").isNull()).alias("skipped"),
        F.count_if(~F.col("traced")).alias("violations"),
    )
