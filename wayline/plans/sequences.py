"""Queries over ordered rows: events as action streams of users, conversations as sessions."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.operators import sequence
from wayline.plans.catalog import query
from wayline.session import table

USER, TIME = ["user_id"], ["ts", "event_id"]
_W = "PARTITION BY user_id ORDER BY ts, event_id"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


@query("""
SELECT run, CASE WHEN n = 0 THEN 'unresolved' ELSE branch END AS branch, CASE WHEN n = 0 THEN 'no_outcome_left' END AS reason FROM (
  SELECT user_id AS run, count(*) FILTER (event_type <> 'view') AS n, nullif(arg_max(event_type, event_id) FILTER (event_type <> 'view'), 'purchase') AS branch FROM events GROUP BY user_id)
""")
def w1_conclusion(spark, sf_dir):
    """Each user's last outcome; a purchase is a success, which is null."""
    rows = _events(spark, sf_dir).select(F.col("user_id").alias("run"), F.col("event_id").alias("idx"), "event_type", F.nullif("event_type", F.lit("purchase")).alias("branch"))
    return sequence.conclusion(rows, F.col("event_type") != "view")


@query(f"SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER ({_W}) AS before, row_number() OVER ({_W}) AS rn FROM events) WHERE rn = 1 OR event_type IS DISTINCT FROM before")
def w3_without_loops(spark, sf_dir):
    return sequence.without_loops(_events(spark, sf_dir), USER, TIME, ["event_type"]).select("event_id", "user_id", "event_type")


@query("SELECT event_id, times, times >= 2 AS repeated FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS times FROM events)")
def w4_repeats(spark, sf_dir):
    return sequence.repeats(_events(spark, sf_dir), USER, TIME, "event_type").select("event_id", F.col("times").cast("long").alias("times"), "repeated")


_ISLANDS = f"""
WITH marked AS (SELECT *, CASE WHEN lag(event_type) OVER ({_W}) = event_type THEN 0 ELSE 1 END AS fresh FROM events),
runs AS (SELECT *, sum(fresh) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM marked),
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) - 1 AS place FROM runs)
"""


@query(f"{_ISLANDS} SELECT event_id, user_id FROM placed WHERE place % 2 = 1")
def w5_adjacent_repeats(spark, sf_dir):
    return sequence.adjacent_repeats(_events(spark, sf_dir), USER, TIME, F.col("event_type")).select("event_id", "user_id")


@query(f"{_ISLANDS} SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n FROM placed GROUP BY user_id, island")
def w6_islands(spark, sf_dir):
    rows = sequence.islands(_events(spark, sf_dir), USER, TIME, F.col("event_type"))
    return rows.groupBy("user_id", "island").agg(F.count("*").alias("n"))


@query(f"{_ISLANDS} SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(ts) AS first FROM placed GROUP BY user_id, island HAVING count(*) >= 3 AND bool_and(value > 5)")
def w7_long_islands(spark, sf_dir):
    rows = sequence.long_islands(_events(spark, sf_dir), USER, TIME, F.col("event_type"), 3, F.col("value") > 5)
    return rows.select("user_id", "island", "n", "first")


@query("""
SELECT event_id, n = 3 AND (lo = hi OR empty = 1) AS dead_loop FROM (
  SELECT event_id, count(*) OVER w AS n, min(event_type) OVER w AS lo, max(event_type) OVER w AS hi, min(CASE WHEN value < 10 THEN 1 ELSE 0 END) OVER w AS empty
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
""")
def w10_dead_loops(spark, sf_dir):
    return sequence.dead_loops(_events(spark, sf_dir), USER, TIME, F.col("event_type"), F.col("value") < 10).select("event_id", "dead_loop")


@query("""
WITH seen AS (SELECT user_id, event_type, min(event_id) AS first_seen FROM events WHERE value > 20 GROUP BY 1, 2)
SELECT e.event_id, e.user_id, first_seen FROM events e JOIN seen USING (user_id, event_type) WHERE e.value <= 20 AND first_seen >= e.event_id
""")
def w12_leaks(spark, sf_dir):
    """Small events of a type that the user's large ones show only later."""
    rows = _events(spark, sf_dir).withColumn("at", F.col("event_id"))
    return sequence.leaks(rows.where("value <= 20"), rows.where("value > 20"), USER, "event_type").select("event_id", "user_id", "first_seen")


@query("SELECT event_id, coalesce(value < lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id), false) AS dropped FROM events")
def w13_drops(spark, sf_dir):
    return sequence.drops(_events(spark, sf_dir), ["user_id", "event_type"], TIME, "value").select("event_id", "dropped")


@query("""
SELECT conv_id, turn, CAST(stop - n AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM (
  SELECT conv_id, turn, length(text) AS n, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM conversations)
""")
def w14_step_ranges(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("n"))
    return sequence.step_ranges(rows, ["conv_id"], ["turn"], "n").select("conv_id", "turn", "start", F.col("end").alias("stop"))


@query("SELECT conv_id, arg_max(turn, turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations WHERE role <> 'system' GROUP BY conv_id")
def w17_latest(spark, sf_dir):
    return sequence.latest(table(spark, sf_dir, "conversations").where("role <> 'system'"), ["conv_id"], ["turn"], ["turn", "role", "text"])


@query("SELECT user_id, CASE WHEN count(DISTINCT c) = 1 THEN min(c) END AS claim, count(DISTINCT c) > 1 AS conflict FROM (SELECT user_id, CASE WHEN value > 95 THEN event_type END AS c FROM events) GROUP BY user_id")
def w18_settled(spark, sf_dir):
    """One claim per user where all large events agree."""
    rows = _events(spark, sf_dir).withColumn("claim", F.when(F.col("value") > 95, F.col("event_type")))
    return sequence.settled(rows, USER, "claim").select("user_id", "claim", "conflict")


@query(f"""
WITH marked AS (SELECT *, event_type <> 'view' AS tool FROM events),
fresh AS (SELECT *, CASE WHEN lag(tool) OVER ({_W}) = tool THEN 0 ELSE 1 END AS f FROM marked),
runs AS (SELECT *, sum(f) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM fresh),
ends AS (SELECT *, max(event_id) OVER (PARTITION BY user_id, island) AS last FROM (SELECT *, row_number() OVER ({_W}) AS pos FROM runs))
SELECT event_id, user_id FROM (SELECT *, max(pos) OVER (PARTITION BY user_id, island) AS final FROM ends) WHERE NOT tool OR value > 30 OR pos = final
""")
def w20_fold_failures(spark, sf_dir):
    """Events without failed tool calls that another attempt follows."""
    rows = _events(spark, sf_dir).withColumn("at", F.row_number().over(sequence.ordered(USER, TIME)))
    return sequence.fold_failures(rows, USER, ["at"], F.col("event_type") != "view", F.col("value") > 30).select("event_id", "user_id")


@query(f"""{_ISLANDS} SELECT event_id FROM (SELECT *, max(place) OVER (PARTITION BY user_id, island) AS last FROM placed) WHERE event_type <> 'click' OR place = last""")
def w21_fold_last(spark, sf_dir):
    return sequence.fold_runs(_events(spark, sf_dir), USER, TIME, F.col("event_type"), F.col("event_type") == "click", "last").select("event_id")


@query(f"{_ISLANDS} SELECT event_id FROM placed WHERE place = 0")
def w22_fold_first(spark, sf_dir):
    return sequence.fold_runs(_events(spark, sf_dir), USER, TIME, F.col("event_type"), F.lit(True), "first").select("event_id")


@query(f"""
SELECT user_id, coalesce(min(CASE WHEN value > 80 THEN n END) - 1, count(*)) AS failures_first FROM (SELECT *, row_number() OVER ({_W}) AS n FROM events) GROUP BY user_id
""")
def w23_health_prefix(spark, sf_dir):
    return sequence.health_prefix(_events(spark, sf_dir).withColumn("at", F.struct("ts", "event_id")), USER, "at", F.col("value") > 80)


@query("""
WITH said AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
turns AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM said)
SELECT conv_id, CAST(island AS BIGINT) AS island, count(*) AS n, string_agg(role, '>' ORDER BY turn) AS roles FROM turns GROUP BY conv_id, island
""")
def w24_replay(spark, sf_dir):
    """Messages folded into exchanges: each user turn begins one."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    flushed = F.sum((F.col("role") == "user").cast("long")).over(sequence.ordered(["conv_id"], ["turn"]).rowsBetween(W.unboundedPreceding, 0))
    exchanges = rows.withColumn("island", flushed).groupBy("conv_id", "island")
    roles = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ">")
    return exchanges.agg(F.count("*").alias("n"), roles.alias("roles"))


@query("""
SELECT conv_id, count(*) FILTER (role = 'assistant') = 0 OR count(*) FILTER (trim(text) <> '') = 0 OR (count(*) = 1 AND max(role) = 'assistant') AS unusable FROM conversations GROUP BY conv_id
""")
def p38_unusable(spark, sf_dir):
    none = F.count(F.when(F.col("role") == "assistant", 1)) == 0
    empty = F.count(F.when(F.trim("text") != "", 1)) == 0
    lone = (F.count("*") == 1) & (F.max("role") == "assistant")
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg((none | empty | lone).alias("unusable"))


@query("""
SELECT conv_id, count(*) AS n, 'call_' || string_agg(CAST(seq AS VARCHAR), ',call_' ORDER BY turn) AS calls FROM (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS seq FROM conversations WHERE role = 'assistant') GROUP BY conv_id
""")
def h10_dense_calls(spark, sf_dir):
    """Dense ids for the calls of each session."""
    rows = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    rows = rows.withColumn("seq", F.row_number().over(sequence.ordered(["conv_id"], ["turn"])))
    calls = F.array_join(F.transform(F.array_sort(F.collect_list("seq")), lambda s: F.concat(F.lit("call_"), s.cast("string"))), ",")
    return rows.groupBy("conv_id").agg(F.count("*").alias("n"), calls.alias("calls"))
