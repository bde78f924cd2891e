"""Sessions of typed blocks: as chat messages, and two versions of a session compared.

blocks(session, message, place, role, type, id, name, text, input, state): a row for each block of a message, in order of message and
place. `text` is what a text, thinking or toolresult block says, `input` the JSON of a toolcall; a message without blocks is a row
of null type. A message of role tool has its call's id and name on its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROLES = ("user", "assistant", "system", "tool")
#: What ids of calls begin with.
CALL = "call_"


def call_id(raw: Column) -> Column:
    """An id that begins as ids of calls do."""
    given = F.coalesce(raw, F.lit(""))
    return F.when(given == "", CALL + "unknown").when(F.startswith(given, F.lit(CALL)), given).otherwise(F.concat(F.lit(CALL), given))


def arguments(raw: Column) -> Column:
    """JSON arguments; what is none is kept under "raw"."""
    given = F.coalesce(raw, F.lit("{}"))
    return F.when(F.try_parse_json(given).isNotNull(), given).otherwise(F.to_json(F.struct(given.alias("raw"))))


def chat_messages(blocks: DataFrame) -> DataFrame:
    """(session, seq from 1, role, content, reasoning, calls, call_id, name, filled) of the messages that blocks make.

    User, system and tool messages are one message each, of their texts. An assistant's message ends at each toolresult, which is a
    tool message of its own; what stands between two is one message of its texts, thoughts and calls, left out if it has
    none. Contents are never null, `filled` tells where an assistant's message had none; reasoning is null where there is none; calls are array<struct<id,name,arguments>>. Other roles
    and kinds of blocks are left out.
    """
    kind = F.coalesce("type", F.lit(""))
    rows = blocks.where(F.col("role").isin(*ROLES)).withColumn("kind", kind)
    of = W.partitionBy("session", "message").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    result = F.col("kind") == "toolresult"
    cuts = F.coalesce(F.count_if(result).over(of), F.lit(0)) * 2 + F.when(result, 1).otherwise(0)
    rows = rows.withColumn("part", F.when(F.col("role") == "assistant", cuts).otherwise(0))
    speaks = F.when(F.col("role") == "assistant", F.col("kind").isin("text", "thinking", "toolcall", "toolresult")).otherwise(True)
    rows = rows.where(speaks)
    pick = lambda *kinds: F.collect_list(F.when(F.col("kind").isin(*kinds), F.struct("place", F.coalesce("text", F.lit("")).alias("x"))))
    joined = lambda c: F.array_join(F.transform(F.array_sort(c), lambda t: t["x"]), "")
    call = F.struct("place", call_id(F.col("id")).alias("id"), F.coalesce("name", F.lit("")).alias("name"), arguments(F.col("input")).alias("arguments"))
    grouped = rows.groupBy("session", "message", "part", "role").agg(
        pick("text").alias("texts"),
        pick("thinking").alias("thoughts"),
        pick("toolresult").alias("results"),
        F.collect_list(F.when(F.col("kind") == "toolcall", call)).alias("calls"),
        F.min_by("id", "place").alias("id"),
        F.min_by("name", "place").alias("name"),
    )
    answers = (F.col("role") == "tool") | (F.size("results") > 0) & (F.col("role") == "assistant")
    seq = F.row_number().over(W.partitionBy("session").orderBy("message", "part"))
    return grouped.select(
        "session",
        seq.alias("seq"),
        F.when(answers, "tool").otherwise(F.col("role")).alias("role"),
        joined(F.when(F.col("part") % 2 == 1, F.col("results")).otherwise(F.col("texts"))).alias("content"),
        F.when((F.col("role") == "assistant") & (F.size("thoughts") > 0), joined(F.col("thoughts"))).alias("reasoning"),
        F.when(F.col("role") == "assistant", F.transform(F.array_sort("calls"), lambda c: c.dropFields("place"))).otherwise(F.slice(F.transform("calls", lambda c: c.dropFields("place")), 1, 0)).alias("calls"),
        F.when(answers, call_id(F.col("id"))).alias("call_id"),
        F.when(answers, F.coalesce("name", F.lit(""))).alias("name"),
        ((F.col("role") == "assistant") & ~answers & (F.size("texts") == 0)).alias("filled"),
    )


def repairs(blocks: DataFrame) -> DataFrame:
    """(session, tool_calls, tool_results, arguments_parsed, arguments_broken, contents_filled, tools) of each session's chat_messages().

    tools are the different names of calls, in the order of their first ones.
    """
    asks = (F.col("role") == "assistant") & (F.col("type") == "toolcall")
    broken = asks & F.col("input").isNotNull() & F.try_parse_json("input").isNull()
    made = chat_messages(blocks)
    first = blocks.where(asks & (F.col("name") != "")).groupBy("session", "name").agg(F.min(F.struct("message", "place")).alias("at"))
    tools = first.groupBy("session").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("tools"))
    counts = blocks.groupBy("session").agg(F.count_if(asks).alias("tool_calls"), F.count_if(asks & ~F.coalesce(broken, F.lit(False))).alias("arguments_parsed"), F.count_if(broken).alias("arguments_broken"))
    of_messages = made.groupBy("session").agg(F.count_if(F.col("role") == "tool").alias("tool_results"), F.count_if("filled").alias("contents_filled"))
    out = counts.join(of_messages, "session", "left").join(tools, "session", "left")
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return out.select("session", "tool_calls", zero("tool_results"), "arguments_parsed", "arguments_broken", zero("contents_filled"), F.coalesce("tools", F.array().cast("array<string>")).alias("tools"))


def breakpoints(blocks: DataFrame) -> DataFrame:
    """(session, step, id, state) of calls without a good result; state is null where there is no result.

    A call's result is the first one of its id behind it in the assistant's blocks, with nothing but calls and results between. Steps
    number all blocks of a session from 0.
    """
    every = W.partitionBy("session").orderBy("message", "place")
    tool = F.col("type").isin("toolcall", "toolresult")
    rows = blocks.where("type IS NOT NULL").withColumn("step", F.row_number().over(every) - 1).where("role = 'assistant'")
    rows = rows.withColumn("run", F.count_if(~tool).over(every.rowsBetween(W.unboundedPreceding, 0))).where(tool)
    same = W.partitionBy("session", "run", "id").orderBy("step").rowsBetween(1, W.unboundedFollowing)
    result = F.when(F.col("type") == "toolresult", F.struct(F.coalesce("state", F.lit("")).alias("state")))
    rows = rows.withColumn("id", F.coalesce("id", F.lit(""))).withColumn("answer", F.first(result, ignorenulls=True).over(same))
    return rows.where("type = 'toolcall' AND (answer IS NULL OR answer.state <> 'success')").select("session", "step", "id", F.col("answer.state").alias("state"))


def elements(blocks: DataFrame, most: int = 2000) -> DataFrame:
    """(session, goal, actions, results) of each session: the first text of a user's message, the names of all calls in order, and the last
    text of the last assistant's message that has one; null where there is none. Texts are cut to `most` characters, as a feature."""
    rows = blocks.withColumn("order", F.struct("message", "place"))
    text = (F.col("type") == "text") & (F.coalesce("text", F.lit("")) != "")
    # of a user's message only the first text counts, even an empty one
    first = F.row_number().over(W.partitionBy("session", "message").orderBy(F.when(F.col("type") == "text", 0).otherwise(1), "place")) == 1
    rows = rows.withColumn("first", first)
    return rows.groupBy("session").agg(
        F.left(F.min_by(F.when((F.col("role") == "user") & text & F.col("first"), F.col("text")), F.when((F.col("role") == "user") & text & F.col("first"), F.col("order"))), F.lit(most)).alias("goal"),
        F.transform(F.array_sort(F.collect_list(F.when((F.col("role") == "assistant") & (F.col("type") == "toolcall"), F.struct("order", F.coalesce("name", F.lit("")).alias("name"))))), lambda x: x["name"]).alias("actions"),
        F.left(F.max_by(F.when((F.col("role") == "assistant") & text, F.col("text")), F.when((F.col("role") == "assistant") & text, F.col("order"))), F.lit(most)).alias("results"),
    )


def call_distance(left: Column, right: Column) -> Column:
    """How many calls must be put in, left out or exchanged to make one sequence of names the other.

    Each name of the two becomes one character, so the alignment is that of two strings; null for more than 30,000 different names.
    """
    names = F.array_union(left, right)
    letter = lambda name: F.decode(F.unhex(F.hex(F.array_position(names, name) + 0x4E00)), "UTF-16BE")
    spelled = lambda calls: F.array_join(F.transform(calls, letter), "")
    return F.when(F.size(names) <= 30_000, F.levenshtein(spelled(left), spelled(right)))


def adherence(kinds: Column) -> Column:
    """pass, review or fail of the kinds of changes that were made: required_change, incidental_change, regression."""
    regressions = F.exists(kinds, lambda k: k == "regression")
    incidental = F.size(F.filter(kinds, lambda k: k == "incidental_change"))
    return F.when(regressions | (incidental > 2), "fail").when(incidental > 0, "review").otherwise("pass")


def change_kind(status: Column, invalid: Column) -> Column:
    """The kind of change of a refined block; null where it was left as it was."""
    return (
        F.when(status == "rollback", "regression")
        .when(status == "needs_review", "incidental_change")
        .when((status == "edited") & F.coalesce(invalid, F.lit(False)), "regression")
        .when(status == "edited", "required_change")
    )


def compared(original: DataFrame, refined: DataFrame, records: DataFrame) -> DataFrame:
    """(session, lost, adherence, coherence, distance, verdict) of each session of both versions.

    records(session, status, invalid): what was done to its blocks. lost names what the refined version lacks of goal and
    results; coherence tells whether breakpoints() became fewer; distance is call_distance(). A session fails if something is lost, if
    adherence() fails, or if it became less coherent.
    """
    sides = elements(original).alias("a").join(elements(refined).alias("b"), "session")
    points = lambda frame, name: breakpoints(frame).groupBy("session").agg(F.count("*").alias(name))
    kinds = records.withColumn("kind", change_kind(F.col("status"), F.col("invalid"))).groupBy("session").agg(F.collect_list("kind").alias("kinds"))
    rows = sides.join(points(original, "before"), "session", "left").join(points(refined, "after"), "session", "left").join(kinds, "session", "left")
    before, after = F.coalesce("before", F.lit(0)), F.coalesce("after", F.lit(0))
    gone = lambda name: F.when((F.coalesce(f"a.{name}", F.lit("")) != "") & (F.coalesce(f"b.{name}", F.lit("")) == ""), name)
    lost = F.array_compact(F.array(gone("goal"), gone("results")))
    rows = rows.select(
        "session",
        lost.alias("lost"),
        adherence(F.coalesce("kinds", F.array().cast("array<string>"))).alias("adherence"),
        F.when(after < before, "improved").when(after == before, "unchanged").otherwise("degraded").alias("coherence"),
        call_distance(F.col("a.actions"), F.col("b.actions")).alias("distance"),
    )
    bad = (F.size("lost") > 0) | (F.col("adherence") == "fail") | (F.col("coherence") == "degraded")
    return rows.withColumn("verdict", F.when(bad, "fail").otherwise("pass"))
