"""Mixing sources to target weights by entropy balancing.

Every document gets a rate of at most MOST copies. Rates are exponentially tilted by the document's size,
r = min(MOST, exp(lambda * size / scale)), with one lambda for each source: the rates nearest to 1 in
relative entropy that take the source's target of words. Newton steps on the convex dual find the lambdas; each
step is one distributed sum over the sizes that occur in each source, kept between the bounds that earlier steps
have proved. Rates are then rounded into whole copies for all documents of a size at once, and what rounding
leaves is made good, largest fitting size first. The documents that get one copy more are those of the smallest
hashes, so reruns agree.

All of it is DataFrame functions; what is the same for a size or a source is worked out once for it.

Cases: null and empty texts have size 0 and are never taken; a null source is a source of its own, the last;
repeated rows are documents like any others, as are rows with a null doc_id; a source without words has the target 0; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.llm.common import WORD, unused, written

WEIGHTS = (1, 2, 3)
MOST = 3
STEPS = 60
CLOSE = 1e-9
#: Bounds of lambda before the first step.
FAR = 1e9
#: Parts of the documents of one size that are ranked apart.
PARTS = 1024


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(key, source_size, target) of every source of sizes(key, source, words).

    Sources in order take the weights in turn and share all words by them. A source reaches its limit where even
    the level of those that reach theirs later is above it, so the sources that do are the first in order of
    limit over weight, and the rest share what is left.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    listed = F.array(*map(F.lit, weights))
    rows = sizes.withColumn("weight", F.element_at(listed, (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    rows = rows.withColumn("limit", F.col("words") * most)
    by_limit = W.orderBy(F.col("limit") / F.col("weight"), "key")
    total = F.sum("words").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    rows = rows.withColumn("left", total - F.coalesce(F.sum("limit").over(by_limit.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("sharing", F.sum("weight").over(by_limit.rowsBetween(W.currentRow, W.unboundedFollowing)))
    # in decimals: the products pass the range of a long
    wide = lambda name: F.col(name).cast("decimal(28,0)").cast("double")
    rows = rows.withColumn("full", wide("limit") * F.col("sharing") <= wide("left") * F.col("weight"))
    level = F.min(F.when(~F.col("full"), F.struct((F.col("limit") / F.col("weight")).alias("order"), (F.col("left") / F.col("sharing")).alias("level"))))
    level = level.over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).getField("level")
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("weight") * level)
    return rows.select("key", F.col("words").alias("source_size"), target.alias("target"))


def rate(most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("size") / F.col("scale")))


def tilts(sizes: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """(key, tilt, scale) of the sources whose target lies between nothing and their limit."""
    scale = sizes.groupBy("key").agg((F.sum(F.col("n") * F.col("size") * F.col("size").cast("double")) / F.sum(F.col("n") * F.col("size"))).alias("scale"))
    state = sources.where((F.col("target") > 0) & (F.col("target") < most * F.col("source_size"))).join(scale, "key")
    state = written(state.select("key", "target", "scale", F.log(F.col("target") / F.col("source_size")).alias("tilt"), F.lit(-FAR).alias("low"), F.lit(FAR).alias("high"), F.lit(FAR).alias("off")))
    for _ in range(STEPS):
        words = F.col("n") * F.col("size") * rate(most)
        slope = F.when(rate(most) < most, words * F.col("size") / F.col("scale")).otherwise(0.0)
        same = [F.first(name).alias(name) for name in ("target", "scale", "tilt", "low", "high")]
        now = sizes.join(state.drop("off"), "key").groupBy("key").agg(*same, F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        above = F.col("words") > F.col("target")
        now = now.withColumn("low", F.when(above, F.col("low")).otherwise(F.greatest("low", "tilt"))).withColumn("high", F.when(above, F.least("high", "tilt")).otherwise(F.col("high")))
        # Newton on the logarithm of the sum, which is nearly straight; halfway between the bounds where that leaves them
        newton = F.col("tilt") - (F.log("words") - F.log("target")) * F.col("words") / F.col("slope")
        inside = (F.col("slope") > 0) & (F.col("words") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        off = F.abs(F.col("words") / F.col("target") - 1)
        tilt = F.when(off < CLOSE, F.col("tilt")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        state = written(now.select("key", "target", "scale", tilt.alias("tilt"), "low", "high", off.alias("off")))
        if not state.where(F.col("off") >= CLOSE).take(1):
            break
    return state.select("key", "tilt", "scale")


def copies(sizes: DataFrame, sources: DataFrame, found: DataFrame, most: int) -> DataFrame:
    """(key, size, n, copies): how many copies all n documents of a size get together."""
    n, size = F.col("n"), F.col("size")
    # without a tilt the source is taken whole, as often as may be, or not at all
    exact = F.when(F.col("tilt").isNotNull(), rate(most)).when(F.col("target") > 0, F.lit(float(most))).otherwise(0.0)
    classes = sizes.join(sources, "key").join(found, "key", "left").select("key", "size", "n", "target", F.round(n * exact).cast("long").alias("copies"))
    classes = written(classes)
    while True:
        rest = classes.groupBy("key").agg((F.first("target") - F.sum(F.col("copies") * size)).alias("rest"))
        room = F.when(F.col("rest") > 0, n * most - F.col("copies")).otherwise(F.col("copies"))
        gap = F.abs("rest")
        option = F.struct("size", room.alias("room"))
        # the largest size that fits, else the smallest that overshoots by less than is missing
        largest, smallest = F.max(F.when((room > 0) & (size <= gap), option)), F.min(F.when((room > 0) & (size < 2 * gap), option))
        chosen = classes.join(rest, "key").groupBy("key").agg(F.first("rest").alias("rest"), F.coalesce(largest, smallest).alias("pick"))
        chosen = written(chosen.where("pick is not null").select("key", F.col("pick.size").alias("size"), "rest", F.col("pick.room").alias("room")))
        if not chosen.take(1):
            return classes.select("key", "size", "n", "copies")
        change = F.signum("rest") * F.least(F.col("room"), F.greatest(F.lit(1), F.floor(F.abs("rest") / size)))
        change = chosen.select("key", "size", change.cast("long").alias("change"))
        classes = written(classes.join(change, ["key", "size"], "left").select("key", "size", "n", "target", (F.col("copies") + F.coalesce("change", F.lit(0))).alias("copies")))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, hash, size, source_size, target, copies) of every row of docs(doc_id, source, text)."""
    rows = docs.select(
        "doc_id",
        F.xxhash64(F.col("source").isNull(), "source", "text").alias("hash"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    rows = written(rows)
    sizes = written(rows.groupBy("key", "size").agg(F.count("*").alias("n")))
    words = rows.groupBy("key", "source").agg(F.sum("size").alias("words"))
    sources = written(targets(words, weights, most))
    some = written(sizes.where("size > 0"))
    dealt = copies(some, sources, tilts(some, sources, most), most)
    order = F.xxhash64("doc_id", "hash")
    rows = rows.withColumn("order", order).withColumn("part", F.pmod("order", F.lit(PARTS)).cast("int"))
    counts = rows.groupBy("key", "size", "part").agg(F.count("*").alias("here"))
    before = F.sum("here").over(W.partitionBy("key", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select("key", "size", "part", F.coalesce(before, F.lit(0)).alias("before")).join(dealt, ["key", "size"], "left").join(sources, "key")
    rank = F.row_number().over(W.partitionBy("key", "size", "part").orderBy("order", "doc_id"))
    each = F.floor(F.col("copies") / F.col("n")).cast("long")
    got = each + (F.col("before") + F.col("rank") <= F.col("copies") - each * F.col("n")).cast("long")
    ranked = rows.withColumn("rank", rank).join(counts, ["key", "size", "part"])
    return ranked.select("doc_id", "hash", "size", "source_size", "target", F.coalesce(got, F.lit(0)).alias("copies"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of the mix: each row of docs as often as it is taken."""
    doc, hashed, key, copies_of, copy = unused(docs, "_doc", "_hash", "_key", "_copies", "_copy")
    taken = mixture(docs, weights, most).where("copies > 0").select(F.col("doc_id").alias(doc), F.col("hash").alias(hashed), F.col("copies").alias(copies_of))
    # equal rows are taken together
    taken = taken.groupBy(doc, hashed).agg(F.sum(copies_of).alias(copies_of))
    once = docs.withColumn(key, F.xxhash64(F.col("source").isNull(), "source", "text")).dropDuplicates(["doc_id", key])
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(hashed))
    return once.join(taken, same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies_of).cast("int")))).select(*docs.columns)
