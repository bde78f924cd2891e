"""What evidence is anchored in, and how visits that went wrong were handled."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.functions.python import text_anchors

# How an element and a count are named, and the branches of visits that went wrong.
ELEMENT, COUNT = "元素名「%s」", "计数 %d"
ABNORMAL = ("unreachable_hard", "login_required", "blocked", "login_wall_or_blocked", "broken", "unresolved")

#: Blanks of any width at the ends; trim() knows one.
BLANKS = r"^\p{Zs}+|\p{Zs}+$"

#: An observation, as anchored() and handling() take them.
OBSERVATION = "struct<body_text:string,labels:array<string>,media:int,frames:int,truncated:boolean,elements_total:int>"


def anchored(evidence: Column, observations: Column, once: bool = True) -> Column:
    """What of the observations the evidence names: of each in turn the quoted part of its body, its element names of two and
    more characters without blanks of any width at their ends, its positive counts; each once, or where once is false as often as
    it is there. Nothing for empty evidence; null evidence is empty."""
    said = F.coalesce(evidence, F.lit(""))
    bodies = text_anchors(F.transform(observations, lambda o: o["body_text"]), said)
    labels = lambda o: F.filter(F.transform(F.coalesce(o["labels"], F.array().cast("array<string>")), lambda x: F.regexp_replace(x, BLANKS, "")), lambda x: (F.length(x) >= 2) & F.contains(said, x))
    counts = lambda o: F.filter(F.array(o["media"], o["frames"]), lambda n: (n > 0) & F.contains(said, n.cast("string")))
    names = F.zip_with(
        observations,
        bodies,
        lambda o, quoted: F.concat(
            F.filter(F.array(quoted), lambda x: x != ""),
            F.transform(labels(o), lambda x: F.format_string(ELEMENT, x)),
            F.transform(counts(o), lambda n: F.format_string(COUNT, n)),
        ),
    )
    every = F.flatten(F.coalesce(names, F.array().cast("array<array<string>>")))
    return F.when(said == "", F.array().cast("array<string>")).otherwise(F.array_distinct(every) if once else every)


def _empty(o: Column) -> Column:
    return (F.trim(F.coalesce(o["body_text"], F.lit(""))) == "") & (F.coalesce(F.size(o["labels"]), F.lit(0)) < 1)


def _incomplete(o: Column) -> Column:
    kept = F.greatest(F.coalesce(F.size(o["labels"]), F.lit(0)), F.lit(0))
    return _empty(o) | F.coalesce(o["truncated"], F.lit(False)) | (F.coalesce(o["elements_total"], F.lit(0)) > kept)


def handling(visits: DataFrame, registered: Collection[str], abnormal: Collection[str] = ABNORMAL) -> DataFrame:
    """(run, visit, branch, problems) of the visits that went wrong; none of the problems means that they were handled well.

    visits(run, visit, url, branch, evidence, errors array<string>, observations array<OBSERVATION>): branch is null or
    empty where none was recorded. A visit went wrong if its branch is abnormal, or if it has a signal (an error, or no observation
    with a body or an element) and no branch. Problems, in order: unrecorded; unknown_branch; same_url_next, the next visit of the run
    goes where this one went; and where nothing anchors the evidence no_anchor_unobserved (the errors are asked instead of
    observations), no_anchor_incomplete or no_anchor.
    """
    branch = F.trim(F.coalesce("branch", F.lit("")))
    errors = F.filter(F.coalesce("errors", F.array().cast("array<string>")), lambda e: F.trim(F.coalesce(e, F.lit(""))) != "")
    seen = F.coalesce("observations", F.array().cast(f"array<{OBSERVATION}>"))
    after = F.lead("url").over(W.partitionBy("run").orderBy("visit"))
    rows = visits.select("run", "visit", "url", branch.alias("branch"), F.coalesce("evidence", F.lit("")).alias("evidence"), errors.alias("errors"), seen.alias("seen"), after.alias("after"))
    signal = (F.size("errors") > 0) | ~F.exists("seen", lambda o: ~_empty(o))
    rows = rows.where(F.col("branch").isin(*abnormal) | (signal & (F.col("branch") == "")))
    rows = rows.withColumn("anchors", anchored(F.col("evidence"), F.col("seen"))).withColumn("quoted", text_anchors(F.col("errors"), F.col("evidence")))
    loose = F.size("anchors") == 0
    unseen = F.size("seen") == 0
    problems = [
        F.when(F.col("branch") == "", "unrecorded").when(~F.col("branch").isin(*registered), "unknown_branch"),
        F.when((F.col("after") != "") & (F.col("after") == F.col("url")), "same_url_next"),
        F.when(loose & unseen & ~F.exists("quoted", lambda x: x != ""), "no_anchor_unobserved")
        .when(loose & ~unseen & F.exists("seen", _incomplete), "no_anchor_incomplete")
        .when(loose & ~unseen, "no_anchor"),
    ]
    return rows.select("run", "visit", "branch", F.array_compact(F.array(*problems)).alias("problems"))


def handling_rate(handled: DataFrame) -> DataFrame:
    """(abnormal, compliant, rate, unobserved, incomplete) of all handling() rows; the rate of none is null, not 1."""
    has = lambda name: F.count_if(F.array_contains("problems", name))
    good = F.count_if(F.size("problems") == 0)
    return handled.agg(
        F.count("*").alias("abnormal"),
        good.alias("compliant"),
        F.when(F.count("*") > 0, good / F.count("*")).alias("rate"),
        has("no_anchor_unobserved").alias("unobserved"),
        has("no_anchor_incomplete").alias("incomplete"),
    )
