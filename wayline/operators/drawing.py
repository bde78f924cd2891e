"""Pairs drawn with retries: the same ones however the tables are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.session import settled


def numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """rows with `name`, their number from 0 in order of key; keys are different ones. No task sees more than a range of them."""
    dealt = rows.repartitionByRange(key).sortWithinPartitions(key)
    placed = settled(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()))
    parts = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))  # one row a partition
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shifts = parts.select("_part", (before - F.col("_first")).alias("_shift"))
    return placed.join(shifts, "_part").withColumn(name, F.col("_place") + F.col("_shift")).drop("_part", "_place", "_shift")


def drawn_number(seed: str, what: str, slot: Column, attempt: Column, n: Column) -> Column:
    """A number below n that depends on nothing else than seed, slot and attempt."""
    text = F.concat_ws("|", F.lit(seed), F.lit(what), slot.cast("string"), attempt.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % n


def drawn_pairs(personas: DataFrame, skeletons: DataFrame, n: int, seed: str, compatible: Column, attempts: int = 20) -> DataFrame:
    """(slot, attempt, *personas, *skeletons): for each of n slots the first compatible pair of its attempts, each drawn on its own.

    personas(persona, ...), skeletons(skeleton, ...) without common names; `compatible` is a condition on both. A slot without a
    compatible pair in all its attempts has nulls and the attempt `attempts`; drawing_report() counts them. attempt counts the pairs that
    were refused before. Empty tables leave every slot without a pair.
    """
    spark = personas.sparkSession
    if n < 0 or attempts < 1:
        raise ValueError("slots and attempts cannot be negative")
    slots = spark.range(n).select(F.col("id").alias("slot"))
    tries = slots.select("slot", F.explode(F.sequence(F.lit(0), F.lit(attempts - 1))).alias("attempt"))
    sides = []
    for frame, what in ((personas, "persona"), (skeletons, "skeleton")):
        rows = numbered(frame, what, f"_{what}")
        size = rows.agg(F.count("*").alias("n")).first()["n"]
        tries = tries.withColumn(f"_{what}", drawn_number(seed, what, F.col("slot"), F.col("attempt"), F.lit(max(size, 1))))
        sides.append(rows)
    met = tries.join(sides[0], "_persona").join(sides[1], "_skeleton").where(compatible)
    names = [*personas.columns, *skeletons.columns]
    first = met.groupBy("slot").agg(F.min_by(F.struct("attempt", *names), "attempt").alias("pair"))
    return slots.join(first, "slot", "left").select("slot", F.coalesce("pair.attempt", F.lit(attempts)).alias("attempt"), *[F.col(f"pair.{name}").alias(name) for name in names])


def drawing_report(drawn: DataFrame, strata: Sequence[str]) -> DataFrame:
    """(*strata, requested, produced, refused, personas, skeletons) of the slots of each stratum; slots without a pair are the stratum of nulls."""
    return drawn.groupBy(*strata).agg(
        F.count("*").alias("requested"),
        F.count("persona").alias("produced"),
        F.sum("attempt").alias("refused"),
        F.count_distinct("persona").alias("personas"),
        F.count_distinct("skeleton").alias("skeletons"),
    )


def round_robin(rows: DataFrame, strata: Sequence[str], seed: str, key: str) -> DataFrame:
    """rows with `turn`: the strata take turns, each in the order of a hash of its keys; a stratum that is used up is passed over."""
    order = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))
    return rows.withColumn("turn", F.row_number().over(W.partitionBy(*strata).orderBy(order, key)))
