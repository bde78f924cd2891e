"""Queries over draws: customers are personas, parts the skeletons of tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import drawing
from wayline.plans.catalog import query
from wayline.session import table

SEED = "s1"


def _number(what, n):
    return f"CAST(('0x' || left(md5('{SEED}|{what}|' || slot || '|' || attempt), 8)) AS BIGINT) % {n}"


_DRAWN = f"""
p AS (SELECT c_custkey AS persona, c_mktsegment AS genre, c_nationkey AS nation, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer),
k AS (SELECT p_partkey AS skeleton, p_type AS mode, p_size AS size, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part),
slots AS (SELECT unnest(range((SELECT count(*) FROM customer))) AS slot),
tries AS (SELECT slot, attempt, {_number("persona", "(SELECT count(*) FROM p)")} AS pi, {_number("skeleton", "(SELECT count(*) FROM k)")} AS ki FROM slots, (SELECT unnest(range(4)) AS attempt)),
met AS (SELECT slot, attempt, persona, genre, nation, skeleton, mode, size, row_number() OVER (PARTITION BY slot ORDER BY attempt) AS nth FROM tries JOIN p ON p.i = pi JOIN k ON k.i = ki WHERE nation * 2 < size),
drawn AS (SELECT s.slot, coalesce(attempt, 4) AS attempt, persona, genre, nation, skeleton, mode, size FROM slots s LEFT JOIN met ON met.slot = s.slot AND nth = 1)"""


def _drawn(spark, sf_dir):
    personas = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("persona"), F.col("c_mktsegment").alias("genre"), F.col("c_nationkey").alias("nation"))
    skeletons = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("skeleton"), F.col("p_type").alias("mode"), F.col("p_size").alias("size"))
    return drawing.drawn_pairs(personas, skeletons, personas.count(), SEED, F.col("nation") * 2 < F.col("size"), attempts=4)


@query(f"WITH {_DRAWN} SELECT slot, attempt, persona, genre, nation, skeleton, mode, size FROM drawn")
def x6_drawn_tasks(spark, sf_dir):
    """As many tasks as there are customers, each a persona and a skeleton that fit; four attempts a task."""
    return _drawn(spark, sf_dir)


@query(f"""WITH {_DRAWN}
SELECT genre, mode, count(*) AS requested, count(persona) AS produced, CAST(sum(attempt) AS BIGINT) AS refused, count(DISTINCT persona) AS personas, count(DISTINCT skeleton) AS skeletons FROM drawn GROUP BY genre, mode
""")
def x6_report(spark, sf_dir):
    return drawing.drawing_report(_drawn(spark, sf_dir), ["genre", "mode"])


@query(f"SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY md5('{SEED}|' || c_custkey), c_custkey) AS turn FROM customer")
def x5_round_robin(spark, sf_dir):
    """Customers in turns of their segments and nations."""
    rows = table(spark, sf_dir, "customer")
    return drawing.round_robin(rows, ["c_mktsegment", "c_nationkey"], SEED, "c_custkey").select("c_custkey", "c_mktsegment", "turn")
