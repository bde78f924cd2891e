"""Golden rows and what is derived from them: views by site, labels, agreement, worklists, verdicts from outside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def site_views(rows: DataFrame) -> DataFrame:
    """One row per site of rows(golden_id, task_id, run_id, sites array<struct<..., task_id, run_id, split>>): what a site
    lacks it inherits from its trajectory, and it names that trajectory."""
    each = rows.select("golden_id", F.col("task_id").alias("_task"), F.col("run_id").alias("_run"), F.explode("sites").alias("site"))
    inherited = F.col("site").withField("task_id", F.coalesce("site.task_id", "_task")).withField("run_id", F.coalesce("site.run_id", "_run"))
    inherited = inherited.withField("split", F.coalesce("site.split", F.lit(""))).withField("trajectory_id", F.col("golden_id"))
    return each.select(inherited.alias("site")).select("site.*")


def headline_split(sites: Column, code_index: Column, splits: Sequence[str]) -> Column:
    """The split of the site whose outcome_index is code_index; '' where there is none or its split is no known one."""
    own = F.get(F.filter(sites, lambda s: s["outcome_index"] == code_index), F.lit(0))["split"]
    return F.when(code_index.isNotNull() & (code_index >= 0) & own.isin(list(splits)), own).otherwise("")


def scout_tags(scores: Column, threshold: int) -> Column:
    """<dimension>_failed for every score at or below the threshold, and veto if one of scores(dimension, score, is_veto)
    is a veto."""
    failed = F.transform(F.filter(scores, lambda s: s["score"] <= threshold), lambda s: F.concat(s["dimension"], F.lit("_failed")))
    veto = F.when(F.exists(scores, lambda s: s["is_veto"]), F.array(F.lit("veto"))).otherwise(F.array().cast("array<string>"))
    return F.concat(failed, veto)


def comparability(face: Column, status: Column, predicted: Column, current: Column, unrecorded: str = "unrecorded") -> Column:
    """Whether a prediction was made by the current version of its face; null where that cannot be told."""
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    return (
        F.when(F.coalesce(face == "collection", F.lit(False)), F.lit(None).cast("boolean"))
        .when(F.coalesce(status == "diverged", F.lit(False)), F.lit(False))
        .when(blank(predicted) | (predicted == unrecorded) | blank(current), F.lit(None).cast("boolean"))
        .otherwise(predicted == current)
    )


def reflow_kind(verdict: Column, branch: Column, gold: Column, annotated: Column, split: Column, same_class: Column) -> Column:
    """(kind, reason) of a verdict from outside on a gold label: skip, confirm or relabel, the first rule counting.

    same_class: whether branch and gold are in one equivalence class.
    """
    text = lambda c: F.coalesce(c, F.lit(""))
    say = lambda kind, reason: F.struct(F.lit(kind).alias("kind"), F.lit(reason).alias("reason"))
    return (
        F.when(text(split) == "holdout", say("skip", "holdout"))
        .when(text(verdict).isin("", "unknown"), say("skip", "not_reviewed"))
        .when(verdict == "unverifiable", say("skip", "unverifiable"))
        .when(~annotated.eqNullSafe(gold), say("skip", "label_drift"))
        .when(verdict == "agree", say("confirm", "agree"))
        .when(verdict != "disagree", say("skip", "not_reviewed"))
        .when(text(branch).isin("", "unknown"), say("skip", "no_branch"))
        .when(branch == "not_applicable", say("skip", "branch_not_applicable"))
        .when(F.coalesce(same_class, F.lit(False)), say("confirm", "equivalent"))
        .otherwise(say("relabel", "not_equivalent"))
    )


def review_prefill(verdict: Column, elements: Column, host: Column, portals: Sequence[str]) -> Column:
    """(verdict, reviewed_by) that a worklist row starts with: what is filled stays; rows with elements are left to people;
    others are judged by whether the host is a portal."""
    portal = F.lit(False)
    for name in portals:
        portal = portal | F.contains(host, F.lit(name))
    filled = lambda verdict, who: F.struct(verdict.cast("string").alias("verdict"), F.lit(who).alias("reviewed_by"))
    return (
        F.when(F.trim(F.coalesce(verdict, F.lit(""))) != "", filled(verdict, "kept"))
        .when(F.coalesce(elements, F.lit(0)) > 0, filled(F.lit(None), "human"))
        .when(F.coalesce(portal, F.lit(False)), filled(F.lit("confirm_not_play_site"), "auto_portal"))
        .otherwise(filled(F.lit("need_browser"), "auto_insufficient"))
    )


def class_agreement(rows: DataFrame, classes: dict[str, str], headline: str) -> DataFrame:
    """(scope, total, strict, agree, unregistered, ratio) of rows(label, branch, split), over all and over the headline split.

    strict: label and branch are the same word; agree: both are in one of the classes, a branch that is null standing for
    success; labels without a class are unregistered. Where no row has a split, the headline is all rows.
    """
    pick = lambda c: F.coalesce(*(F.when(c == k, v) for k, v in classes.items()))
    branch = F.coalesce("branch", F.lit("success"))
    told = rows.select(
        (F.col("label") == F.col("branch")).alias("strict"),
        (pick(F.col("label")) == pick(branch)).alias("agree"),
        (pick(F.col("label")).isNull() | pick(branch).isNull()).alias("unregistered"),
        (F.col("split") == headline).alias("own"),
        F.col("split").isNotNull().alias("has"),
    )
    count = lambda flag: F.count(F.when(flag, 1))

    def sums(name: str, here: Column) -> list[Column]:
        parts = {"total": here, "strict": here & F.col("strict"), "agree": here & F.col("agree"), "unregistered": here & F.col("unregistered")}
        return [count(flag).alias(f"{name}_{part}") for part, flag in parts.items()]

    one = told.agg(*sums("all", F.lit(True)), *sums("own", F.col("own")), count(F.col("has")).alias("has"))
    scopes = []
    for scope, source in (("all", F.lit("all")), ("headline", F.when(F.col("has") > 0, "own").otherwise("all"))):
        value = lambda part, source=source: F.when(source == "own", F.col(f"own_{part}")).otherwise(F.col(f"all_{part}")).alias(part)
        scopes.append(F.struct(F.lit(scope).alias("scope"), *(value(p) for p in ("total", "strict", "agree", "unregistered"))))
    flat = one.select(F.explode(F.array(*scopes)).alias("x")).select("x.*")
    return flat.withColumn("ratio", F.coalesce(F.try_divide(F.col("agree").cast("double"), "total"), F.lit(0.0)))


def marker_counts(rows: DataFrame, fields: Sequence[str], scored: Sequence[str]) -> DataFrame:
    """(marker, samples, n_<dimension>...): how many rows have a marker in one of the array columns `fields`, and in how many
    of these each dimension of `scored` (a boolean column) has a score."""
    def named(field: str) -> Column:
        return F.transform(F.coalesce(F.col(field), F.array().cast("array<string>")), lambda m: F.concat(F.lit(f"{field}."), m))

    each = rows.select(F.explode(F.concat(*map(named, fields))).alias("marker"), *scored)
    return each.groupBy("marker").agg(F.count("*").alias("samples"), *(F.count(F.when(F.col(d), 1)).alias(f"n_{d}") for d in scored))


def label_fixes(outcomes: DataFrame, labels: dict[str, str], stamps: Sequence[str]) -> DataFrame:
    """The rows of outcomes(branch, branch_label, ...) that a tool has stamped and whose label is not that of their branch,
    with label_before and label_after; a null branch is success, an unknown branch its own label."""
    want = F.coalesce(*(F.when(F.coalesce("branch", F.lit("success")) == k, F.lit(v)) for k, v in labels.items()), F.col("branch"))
    stamped = F.lit(False)
    for name in stamps:
        stamped = stamped | F.col(name).isNotNull()
    out = outcomes.where(stamped & ~F.col("branch_label").eqNullSafe(want))
    return out.withColumn("label_before", F.col("branch_label")).withColumn("label_after", want)


def titles_by_url(titles: Column, urls: Column) -> Column:
    """(url, title) pairs of two lists of one length, trimmed, none of them empty, the first title of each url; an empty list
    where the lengths differ."""
    pairs = F.filter(F.arrays_zip(F.transform(urls, lambda x: F.trim(x)).alias("url"), F.transform(titles, lambda x: F.trim(x)).alias("title")), lambda p: (p["url"] != "") & (p["title"] != ""))
    start = F.array().cast("array<struct<url:string,title:string>>")
    first = F.aggregate(pairs, start, lambda acc, p: F.when(F.exists(acc, lambda q: q["url"] == p["url"]), acc).otherwise(F.array_append(acc, F.struct(p["url"].alias("url"), p["title"].alias("title")))))
    return F.when(F.coalesce(F.size(titles) == F.size(urls), F.lit(False)), first).otherwise(start)


def selection_problem(picked: Column, lines: Column, focus: Column, keep: Column) -> Column:
    """Why picked line numbers (from 1) are no valid selection of lines: nothing picked, a line to keep lost, or all lines
    with a focus word lost; '' if valid. Words that no line has ask for nothing."""
    numbered = F.transform(lines, lambda text, i: F.struct((i + 1).alias("n"), text.alias("text")))
    having = lambda hit: F.transform(F.filter(numbered, hit), lambda x: x["n"])
    lost_all = lambda numbers: (F.size(numbers) > 0) & ~F.arrays_overlap(numbers, picked)
    lost = F.exists(keep, lambda word: (word != "") & lost_all(having(lambda x: F.contains(x["text"], word))))
    off = lost_all(having(lambda x: F.exists(focus, lambda word: (word != "") & F.contains(x["text"], word))))
    return F.when(F.coalesce(F.size(picked), F.lit(0)) <= 0, "nothing").when(lost, "target_lost").when(off, "focus_lost").otherwise("")


def worklist(cards: DataFrame, rows: DataFrame, facts: Sequence[str]) -> DataFrame:
    """cards(golden_id, ...) with the facts of their frozen rows; a card whose golden_id no row has is an error: cards and rows
    are then of different versions."""
    joined = cards.join(rows.select("golden_id", *facts, F.lit(True).alias("_found")), "golden_id", "left")
    stop = F.raise_error(F.concat(F.lit("no frozen row for card "), F.col("golden_id").cast("string")))
    return joined.withColumn("golden_id", F.when(F.col("_found"), F.col("golden_id")).otherwise(stop.cast("string"))).drop("_found")


def overall_decision(dimensions: Column) -> Column:
    """(decision, confidence) of a scorecard's dimensions(id, source, score, non_pass): nothing is suggested if fewer than half
    are scored; a redline rejects, items that did not pass revise."""
    scored = F.filter(dimensions, lambda d: d["source"] != "missing")
    estimated = F.size(F.filter(scored, lambda d: d["source"].isin("estimated", "partly_estimated")))
    n = F.size(scored)
    confidence = F.when((n <= 2) | (estimated >= 3), "low").when(estimated > 0, "medium").otherwise("high")
    has = lambda name, test: F.exists(scored, lambda d: (d["id"] == name) & F.coalesce(test(d), F.lit(False)))
    decision = F.when(has("redline", lambda d: d["score"] != 0), "reject").when(has("criterion_coverage", lambda d: d["non_pass"] > 0), "revise").otherwise("accept")
    few = (F.size(dimensions) > 0) & (n * 2 < F.size(dimensions))
    return F.struct(F.when(~few, decision).alias("decision"), F.when(few, "low").otherwise(confidence).alias("confidence"))


def attribution(questions: Column, from_branch: Column, to_branch: Column, asked_for: dict[str, list[str]]) -> Column:
    """Why a relabel is not lawful, '' if it is. asked_for: the questions each branch may come from.

    The target must have questions; those of the record must be among them; a record without any needs a question that
    both branches come from.
    """
    none = F.array().cast("array<string>")
    of = lambda branch: F.coalesce(*(F.when(branch == b, F.array(*map(F.lit, q))) for b, q in asked_for.items()), none)
    seen, target = F.filter(questions, lambda q: q != ""), of(to_branch)
    return (
        F.when(F.size(target) == 0, "no_question")
        .when(F.size(F.array_except(seen, target)) > 0, "other_question")
        .when((F.size(seen) > 0) | F.arrays_overlap(of(from_branch), target), "")
        .otherwise("no_common_question")
    )
