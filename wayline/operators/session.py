"""Sessions of tool calls: health, usage, pruning, clipping, admission."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Similar = Callable[[Column, Column], Column]


def thrice_alike(calls: DataFrame, key: str, similar: Similar) -> DataFrame:
    """(key, loop) of calls(key, at, name, input): whether a tool was called three times in a row with inputs each similar
    to the next."""
    order = W.partitionBy(key).orderBy("at")
    back = lambda name, k: F.lag(name, k).over(order)
    rows = calls.select(key, "name", "input", *(back(c, k).alias(f"{c}_{k}") for c in ("name", "input") for k in (1, 2)))
    # only calls of one name three times in a row are compared
    rows = rows.withColumn("same", (F.col("name") == F.col("name_1")) & (F.col("name_1") == F.col("name_2")))
    mine, one, two = (F.when(F.col("same"), F.col(c)) for c in ("input", "input_1", "input_2"))
    looped = F.coalesce(F.col("same") & similar(mine, one) & similar(one, two), F.lit(False))
    return rows.withColumn("looped", looped).groupBy(key).agg(F.max("looped").alias("loop"))


def health(calls: DataFrame, key: str, similar: Similar, switching: tuple[str, str], switches: int, failures: int, least: float) -> DataFrame:
    """(key, calls, succeeded, failed, failures_first, loop, switch, score, healthy) of calls(key, at, name, input, state).

    state is null for a call without a result. The score is the share of calls that succeeded, less 0.4 for `failures`
    failures before the first success (in proportion, at most that), 0.3 for a loop and 0.3 for `switches` changes to and fro
    between the two tools of `switching`.
    """
    order = W.partitionBy(key).orderBy("at")
    before = F.lag("name").over(order)
    swapped = F.col("name").isin(*switching) & before.isin(*switching) & (F.col("name") != before)
    ok, result = F.col("state") == "success", F.col("state").isNotNull()
    won = F.sum(F.when(ok, 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, 0))
    rows = calls.withColumn("swapped", swapped).withColumn("early", result & ~ok & (won == 0))
    count = lambda flag: F.count(F.when(flag, 1))
    sums = rows.groupBy(key).agg(F.count("*").alias("calls"), count(ok).alias("succeeded"), count(result & ~ok).alias("failed"), count(F.col("early")).alias("failures_first"), (count(F.col("swapped")) >= switches).alias("switch"))
    joined = sums.join(thrice_alike(calls, key, similar), key)
    penalty = F.least(F.col("failures_first") / failures, F.lit(1.0)) * 0.4 + F.when(F.col("loop"), 0.3).otherwise(0.0) + F.when(F.col("switch"), 0.3).otherwise(0.0)
    score = F.greatest(F.lit(0.0), F.col("succeeded") / F.col("calls") - penalty)
    return joined.withColumn("score", score).withColumn("healthy", (score >= least) & ~F.col("loop") & ~F.col("switch"))


def usage(blocks: DataFrame, key: str, headline: str) -> DataFrame:
    """(key, tools, skills, headline) of blocks(key, role, type, name, input, text): the distinct tools called, the skills that
    calls of Skill name in their input, and whether an assistant's text matches the pattern `headline`."""
    call = F.col("type") == "toolcall"
    skill = F.get_json_object("input", "$.skill")
    told = (F.col("type") == "text") & (F.col("role") == "assistant") & F.coalesce(F.col("text").rlike(headline), F.lit(False))
    tools = F.array_sort(F.collect_set(F.when(call & (F.col("name") != ""), F.col("name"))))
    return blocks.groupBy(key).agg(tools.alias("tools"), F.array_sort(F.collect_set(F.when(call & (F.col("name") == "Skill") & (skill != ""), skill))).alias("skills"), F.coalesce(F.max(told), F.lit(False)).alias("headline"))


def pruned_tools(declared: DataFrame, called: DataFrame, key: str, least: int, most: int, share: float) -> DataFrame:
    """(key, tool, why) that a session keeps of declared(key, tool) given called(key, tool): every called one, those not
    declared as stubs, and of the unused ones a share, at least `least` and at most `most`, by the order of hashes."""
    known = declared.select(key, "tool").distinct()
    used = called.select(key, "tool").distinct().withColumn("used", F.lit(True))
    both = known.withColumn("known", F.lit(True)).join(used, [key, "tool"], "full")
    why = F.when(F.col("used") & F.col("known"), "called").when(F.col("used"), "stub").otherwise("unused")
    rows = both.select(key, "tool", why.alias("why"))
    unused = F.col("why") == "unused"
    pool = F.count(F.when(unused, 1)).over(W.partitionBy(key))
    wanted = F.least(pool, F.greatest(F.lit(least), F.least(F.lit(most), F.floor(pool * share))))
    place = F.row_number().over(W.partitionBy(key, "why").orderBy(F.sha2(F.concat_ws(":", F.col(key).cast("string"), "tool"), 256), "tool"))
    return rows.withColumn("wanted", wanted).withColumn("place", place).where(~unused | (F.col("place") <= F.col("wanted"))).select(key, "tool", "why")


def clipped(blocks: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """blocks(key, at, type, id) after a clip: of calls only those at kept(key, at) stay, of results only those of calls that
    stay, and all other blocks. A session with nothing kept stays whole."""
    asked = kept.select(key).distinct().withColumn("_clip", F.lit(True))
    chosen = blocks.where("type = 'toolcall'").join(kept.select(key, "at"), [key, "at"], "left_semi").select(key, "id").distinct().withColumn("_kept", F.lit(True))
    marked = blocks.join(asked, key, "left").join(chosen, [key, "id"], "left")
    kept_call = F.col("type").isin("toolcall", "toolresult") & F.col("_kept").isNull()
    # a call stays by its place; ids may repeat
    own = kept.select(key, "at").distinct().withColumn("_own", F.lit(True))
    marked = marked.join(own, [key, "at"], "left")
    gone = F.col("_clip").isNotNull() & (kept_call | (F.col("type") == "toolcall") & F.col("_own").isNull())
    return marked.where(~gone).select(*blocks.columns)


def filtered_sessions(messages: DataFrame, key: str, most: int) -> DataFrame:
    """(key, why) of every session of messages(key, blocks, role, error): '' for those that pass, else the first of too_many
    blocks, no_user or no_assistant message, error."""
    has = lambda role: F.count(F.when(F.col("role") == role, 1))
    sums = messages.groupBy(key).agg(F.sum("blocks").alias("n"), has("user").alias("users"), has("assistant").alias("assistants"), F.count("error").alias("errors"))
    why = F.when(F.col("n") > most, "too_many").when(F.col("users") == 0, "no_user").when(F.col("assistants") == 0, "no_assistant").when(F.col("errors") > 0, "error").otherwise("")
    return sums.select(key, why.alias("why"))


def admitted(sessions: DataFrame, decision: Column, overall: Column) -> DataFrame:
    """sessions without those a score rejects, and compare_warn where the comparison failed though they were accepted."""
    kept = sessions.where(F.coalesce(decision != "scoring_reject", F.lit(True)))
    return kept.withColumn("compare_warn", F.coalesce((overall == "fail") & (decision == "accept"), F.lit(False)))


def element_ladder(elements: DataFrame, keys: Sequence[str], roles: Sequence[str], limit: int) -> DataFrame:
    """(*keys, kept, and what each step drops) of elements(*keys, at, role, name): a known role, a name, no second element of
    that role and name, and the first `limit` of these."""
    known, named = F.col("role").isin(list(roles)), F.coalesce(F.col("name") != "", F.lit(False))
    pairs = elements.groupBy(*keys, "role", "name").agg(F.count("*").alias("n"))
    count = lambda flag: F.coalesce(F.sum(F.when(flag, F.col("n"))), F.lit(0))
    unique = count(known & named & (F.col("n") == 1))
    out = pairs.groupBy(*keys).agg(count(~known).alias("role_unmatched"), count(known & ~named).alias("nameless_dropped"), count(known & named & (F.col("n") > 1)).alias("ambiguous_dropped"), unique.alias("unique"))
    kept = F.least("unique", F.lit(limit))
    return out.withColumn("kept", kept).withColumn("truncated", F.col("unique") - kept).drop("unique")


def training_value(components: dict[str, Column], weights: dict[str, float], easy: float = 0.7, medium: float = 0.4) -> Column:
    """(score, tier) of a session: the weighted mean of its components, each from 0 to 1, and easy, medium or hard by it."""
    total = sum(weights[name] for name in components)
    mean = sum((components[name] * weights[name] for name in components), F.lit(0.0)) / total if total > 0 else F.lit(0.5)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean))
    tier = F.when(score >= easy, "easy").when(score >= medium, "medium").otherwise("hard")
    return F.struct(F.round(score, 4).alias("score"), tier.alias("tier"))


def session_components(calls: DataFrame, key: str) -> DataFrame:
    """(key, health, diversity) of calls(key, name, state): the share of calls and failed results that are no failures, and the
    share of distinct tools among the calls; 0.7 and 0.5 where nothing was called."""
    failed = F.count(F.when(F.coalesce(F.col("state") != "success", F.lit(False)), 1))
    n, kinds = F.count("name"), F.countDistinct("name")
    health = F.when(n == 0, 0.7).otherwise(1 - failed / F.greatest(F.lit(1), n + failed))
    return calls.groupBy(key).agg(health.alias("health"), F.when(n == 0, 0.5).otherwise(kinds / n).alias("diversity"))
