"""What a run's records promise and keep: rationales by step, refined bodies, urls of the answer, tools, eras, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aligned_rationales(steps: DataFrame, rationales: DataFrame, by: Sequence[str]) -> DataFrame:
    """(*by, step, status, text, reason) of rationales(*by, step, status, text, reason) at the place of their step; those
    beyond the last step, and steps without one, are left out. What is not written keeps its status, or is unavailable."""
    sizes = steps.groupBy(*by).agg((F.max("step") + 1).alias("_n"))
    rows = rationales.where(F.col("step").isNotNull() & F.col("has_payload")).join(sizes, list(by)).where(F.col("step") < F.col("_n"))
    written = F.col("status") == "written"
    return rows.select(*by, "step", F.coalesce("status", F.lit("unavailable")).alias("status"), F.when(written, F.coalesce("text", F.lit(""))).otherwise("").alias("text"), F.when(written, "").otherwise(F.coalesce("reason", F.lit(""))).alias("reason"))


def refined_lines(bodies: DataFrame, refined: DataFrame) -> DataFrame:
    """bodies(id, body) with the lines picked for them, by the hash of the body, from refined(body_key, lines); a pick with a
    line that the body does not have counts for nothing."""
    keyed = bodies.withColumn("body_key", F.substring(F.sha2("body", 256), 1, 16))
    rows = keyed.join(refined.groupBy("body_key").agg(F.first("lines").alias("lines")), "body_key", "left")
    real = F.size(F.array_except("lines", F.split("body", "\n", -1))) == 0
    return rows.select("id", F.when((F.coalesce("body", F.lit("")) != "") & real, F.col("lines")).otherwise(F.array().cast("array<string>")).alias("lines"))


def rationale_era(statuses: Column, has_reflection: Column) -> Column:
    """When a unit's rationales were written: '' if none is, pre_action if the unit has a reflection, else post_hoc."""
    return F.when(~F.coalesce(F.array_contains(statuses, "written"), F.lit(False)), "").when(has_reflection, "pre_action").otherwise("post_hoc")


def output_contract(status: Column, answer: Column, has_outcome: Column, has_action: Column, least: Column) -> Column:
    """The gate's status after the contract on urls in the answer; units without outcome or visible action, gates that did not
    pass and tasks without a contract stay as they are."""
    found = F.regexp_count(F.coalesce(answer, F.lit("")), F.lit("https?://[^ \\n\\t]+"))
    broken = has_outcome & has_action & (status == "passed") & (found < least)
    return F.when(F.coalesce(broken, F.lit(False)), "failed").otherwise(status)


def visible_tools(declared: DataFrame, catalog: DataFrame) -> DataFrame:
    """declared(surface, tool, ...) without the tools that catalog(surface, tool, visibility) hides from the model; what the
    catalog does not know is visible."""
    hidden = catalog.where("visibility <> 'model'").select("surface", "tool").distinct()
    return declared.join(hidden, ["surface", "tool"], "left_anti")


def pending_versions(frozen: DataFrame, pushed: DataFrame, baseline: int, scope: str) -> DataFrame:
    """The frozen(version) from the baseline on that are not pushed(version, scope) for the scope."""
    done = pushed.where(F.col("scope") == scope).select("version").distinct()
    return frozen.select("version").distinct().where(F.col("version") >= baseline).join(done, "version", "left_anti")


def batch_agreement(pairs: DataFrame, by: Sequence[str], gold: Column, pred: Column, line: float) -> DataFrame:
    """(*by, n, hits, rate, status) of a batch: untestable without a pair, passed from the line on."""
    told = gold.isNotNull() & pred.isNotNull()
    sums = pairs.groupBy(*by).agg(F.count(F.when(told, 1)).alias("n"), F.count(F.when(told & (gold == pred), 1)).alias("hits"))
    rate = F.try_divide(F.col("hits").cast("double"), "n")
    return sums.withColumn("rate", rate).withColumn("status", F.when(F.col("n") == 0, "untestable").when(F.col("rate") >= line, "passed").otherwise("failed"))


def terminal_branch(present: Column, body: Column, host: Column, site_host: Column, kind: Column, error_page: Column, branches: dict[str, str]) -> Column:
    """(branch, why) that the last page alone tells: only on the candidate's own site, by the kind of its access defect, and
    broken only on an error page."""
    say = lambda branch, why: F.struct(branch.alias("branch"), F.lit(why).alias("why"))
    none = F.lit("")
    branch = F.coalesce(*(F.when(kind == k, v) for k, v in branches.items()))
    elsewhere = (F.coalesce(site_host, none) != "") & ((F.coalesce(host, none) == "") | (host != site_host))
    return (
        F.when(~F.coalesce(present, F.lit(False)) | (F.trim(F.coalesce(body, none)) == ""), say(none, ""))
        .when(elsewhere, say(none, "other_host"))
        .when(branch.isNull(), say(none, ""))
        .when((branch == "broken") & ~F.coalesce(error_page, F.lit(False)), say(none, "no_error_page"))
        .otherwise(say(branch, "terminal_shape"))
    )


def pool_census(rows: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(*by, rows, distinct, repeated): how many rows a pool has, how many keys, and how many rows are repeats."""
    counts = rows.groupBy(*by, *keys).agg(F.count("*").alias("_n")).groupBy(*by)
    return counts.agg(F.sum("_n").alias("rows"), F.count("*").alias("distinct"), F.sum(F.col("_n") - 1).alias("repeated"))


def media_links(html: Column, suffixes: Sequence[str]) -> Column:
    """(media, frames): addresses of video, source and links with a media suffix, and of frames, as written, each once."""
    attribute = r"""[^>]*?\ssrc\s*=\s*["']([^"']+)["']"""
    found = lambda pattern: F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), lambda x: F.trim(x))
    sources, frames = found(rf"(?i)<(?:video|source)\b{attribute}"), found(rf"(?i)<iframe\b{attribute}")
    links = F.filter(found(r"""(?i)<a\b[^>]*?\shref\s*=\s*["']([^"']+)["']"""), lambda u: u.rlike(rf"(?i)\.(?:{'|'.join(suffixes)})(?:[?#]|$)"))
    full = lambda urls: F.array_distinct(F.filter(urls, lambda u: u != ""))
    return F.struct(full(F.concat(sources, links)).alias("media"), full(frames).alias("frames"))


def signature_class(reviewed_by: Column, machines: str) -> Column:
    """human or automated: a blank signature, or one that matches the pattern of machines, is no person's."""
    name = F.trim(F.coalesce(reviewed_by, F.lit("")))
    return F.when((name == "") | name.rlike(machines), "automated").otherwise("human")


def judge_agreement(pairs: DataFrame, by: str, hard: str, low: int, high: int) -> DataFrame:
    """(by, n, kind, kappa) of pairs(by, judge, gold): Cohen's kappa of the hard dimension, linear-weighted kappa of the others,
    whose values are scores from low to high; dimensions of less than two pairs, or without a kappa, are left out."""
    cells = pairs.groupBy(by, "judge", "gold").agg(F.count("*").alias("n"))
    total = cells.groupBy(by).agg(F.sum("n").alias("n"))
    sides = [cells.groupBy(by, F.col(c).alias(f"_{c}")).agg(F.sum("n").alias(f"n_{c}")) for c in ("judge", "gold")]
    # values are a closed set of a few labels or scores, so a dimension's grid is small
    grid = sides[0].join(sides[1], by)
    score = lambda c: F.try_to_number(c, F.lit("9")).cast("double")

    def weight(a: Column, b: Column) -> Column:
        return F.when(F.col(by) == hard, (a == b).cast("double")).otherwise(1 - F.abs(score(a) - score(b)) / (high - low))

    seen = cells.groupBy(by).agg(F.sum(F.col("n") * weight(F.col("judge"), F.col("gold"))).alias("seen"))
    chance = grid.groupBy(by).agg(F.sum(F.col("n_judge") * F.col("n_gold") * weight(F.col("_judge"), F.col("_gold"))).alias("chance"))
    out = total.join(seen, by).join(chance, by).where("n >= 2")
    po, pe = F.col("seen") / F.col("n"), F.col("chance") / (F.col("n") * F.col("n"))
    out = out.withColumn("kappa", F.when(pe < 1, (po - pe) / (1 - pe))).where("kappa is not null")
    return out.select(by, "n", F.when(F.col(by) == hard, "cohen").otherwise("linear_weighted").alias("kind"), "kappa")
