"""The trie of all rebuilt conversations: which beginnings they share, and what sharing them saves.

A conversation c is rebuilt from the first h turns of the base of its family (c less c mod `FAMILY`) and its own
turns after its first h. Families come first: the turns of a family are cogrouped by base id, rebuilt, and merged into the
family's small trie, whose nodes hold the conversations that pass. Only these nodes are shuffled by path, where
equal nodes of different families become one.

Sums over subtrees need no recursion. A node belongs to its smallest conversation, and along the path of a conversation
the nodes that belong to it are the last ones. So the sum of a node's subtree is, over the conversations through
it, the sum of what belongs to each at this depth and below: one running sum along each conversation, then one
aggregate by path.

A conversation may hold a third of all turns. Ranks of turns come from a range sort of all turns, and families are
cut into bands of `SEGMENT` turns, each a group of its own: a path is told by two exclusive-or sums of hashes
of (depth, turn), which add up over bands in any order. A path through which a third of all conversations go is one row
a family in an aggregate, and a skewed side of a join with one row on the other side. The ids that end at a node
are packed in sorted runs before they meet in the task that hashes them.

Cases: rows with a null conv_id belong to no conversation and are left out; null roles and texts are empty; null turns come first; turns of
one number are ordered by role, then by a hash of role and text, and repeated rows are repeated turns; mod is never negative; a
conversation that is left without turns is a member of the root, as is every other; other columns are not read; an
empty table has no root and gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.llm.common import written

FAMILY = 5
#: A base gives fewer than so many turns.
HEADS = 9
#: Own turns of a conversation that one group may hold.
SEGMENT = 256

NODES = "base long, band long, a long, b long, depth long, parent_a long, parent_b long, bytes long, more boolean, convs array<long>, ends array<long>"


def lanes(depth: Column | str, said: Column | str) -> list[Column]:
    """Two hashes of a turn at a depth."""
    return [F.xxhash64(depth, said), F.xxhash64(said, F.lit(1), depth)]


def ranked(conversations: DataFrame) -> DataFrame:
    """(conv_id, rank, said, bytes, n): each turn, its rank in its conversation from 1, and the conversation's turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), said.alias("said"), F.octet_length(text).cast("long").alias("bytes"))
    rows = written(rows.withColumn("read", F.monotonically_increasing_id()))  # `read` only divides equal rows
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("said").asc(), F.col("read").asc()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(dealt.select("conv_id", "said", "bytes", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    parts = placed.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    conv = W.partitionBy("conv_id")  # one row a conversation and partition
    before = F.coalesce(F.sum("n").over(conv.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shifts = parts.select("conv_id", "part", (before - F.col("first") + 1).alias("shift"), F.sum("n").over(conv).alias("n"))
    return placed.join(shifts, ["conv_id", "part"]).select("conv_id", (F.col("place") + F.col("shift")).alias("rank"), "said", "bytes", "n")


def family(key: tuple, sides: tuple) -> Iterator[tuple]:
    """The nodes, as in `NODES`, of one band of a family's trie; the root is in band 0."""
    base, band = key
    turns, convs = sides
    own: dict[int, list] = {}
    for conv, *turn in turns:
        own.setdefault(conv, []).append(turn)
    nodes: dict[tuple, list] = {}

    def visit(path: tuple, depth: int, parent: tuple, size: int, total: int, conv: int) -> None:
        node = nodes.setdefault((*path, depth), [parent, size, False, [], []])
        node[3].append(conv)
        if depth < total:
            node[2] = True
        else:
            node[4].append(conv)

    for conv, total, a, b, head in sorted(convs):
        if band == 0:
            visit((a, b), 0, (0, 0), 0, total, conv)
        for depth, x, y, size in [*head, *sorted(own.get(conv, []))]:
            parent = a, b
            a, b = a ^ x, b ^ y
            visit((a, b), depth, parent, size, total, conv)
    for (a, b, depth), (parent, size, more, through, ends) in nodes.items():
        yield base, band, a, b, depth, *parent, size, more, through, ends


def family_nodes(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The nodes of the tries of all families, as in `NODES`."""
    if segment < HEADS:
        raise ValueError(f"a band holds {HEADS} turns at least")
    turns = written(ranked(conversations))
    conv = F.col("conv_id")
    base_of = conv - F.pmod(conv, F.lit(FAMILY))
    heads = turns.where((F.col("rank") < HEADS) & (F.pmod(conv, F.lit(FAMILY)) == 0)).groupBy(conv.alias("base")).agg(F.array_sort(F.collect_list(F.struct("rank", "said", "bytes"))).alias("heads"))
    known = turns.where("rank = 1").select("conv_id", "n", base_of.alias("base"), (F.crc32(conv.cast("string")) % HEADS).alias("h")).join(heads, "base", "left")
    known = known.withColumn("given", F.least("h", F.size(F.coalesce("heads", F.array())).cast("long")))
    lane = lambda i: lambda x: lanes(x["rank"], x["said"])[i]
    head = F.transform(F.slice(F.coalesce("heads", F.expr("cast(array() as array<struct<rank:bigint,said:binary,bytes:bigint>>)")), 1, F.col("given").cast("int")), lambda x: F.struct(x["rank"].alias("depth"), lane(0)(x).alias("x"), lane(1)(x).alias("y"), x["bytes"].alias("bytes")))
    total = F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    known = known.select("conv_id", "base", "h", "given", total.alias("total"), head.alias("head"), F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / segment))).alias("band"))
    known = written(known)  # a row for each band of a conversation
    placed = turns.withColumn("band", F.floor((F.col("rank") - 1) / segment)).join(known.select("conv_id", "base", "band", "h", "given"), ["conv_id", "band"])
    depth = F.col("rank") - F.col("h") + F.col("given")
    x, y = lanes("depth", "said")
    own = placed.where("rank > h").withColumn("depth", depth).select("base", "band", "conv_id", "depth", x.alias("x"), y.alias("y"), "bytes")
    own = written(own)
    sums = own.groupBy("conv_id", "band").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = W.partitionBy("conv_id").orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    given = lambda name: F.aggregate("head", F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(t[name]))
    start = lambda name: F.when(F.col("band") == 0, 0).otherwise(given(name).bitwiseXOR(F.coalesce(F.bit_xor(name).over(earlier), F.lit(0).cast("long"))))
    shown = F.when(F.col("band") == 0, F.col("head")).otherwise(F.slice("head", 1, 0))
    starts = known.join(sums, ["conv_id", "band"], "left").select("base", "band", "conv_id", "total", start("x").alias("x"), start("y").alias("y"), shown.alias("head"))
    keyed = lambda frame: frame.rdd.map(lambda r: ((r[0], r[1]), tuple(r)[2:]))
    spark = conversations.sparkSession
    grouped = keyed(own).cogroup(keyed(starts), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return written(spark.createDataFrame(grouped.flatMap(lambda kv: family(kv[0], kv[1])), NODES, verifySchema=False))


def hashed_runs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, depth, ends_sha256) of (a, b, depth, first, run) sorted by path and first: the runs of a path, comma-joined, hashed."""
    path, state = None, None
    for batch in rows:
        out = []
        for a, b, depth, _, run in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (a, b, depth) == path:
                state.update(b"," + run.encode())
            else:
                if path is not None:
                    out.append((*path, state.hexdigest()))
                path, state = (a, b, depth), hashlib.sha256(run.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out, strict=True)], names=["a", "b", "depth", "ends_sha256"])
    if path is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*path, state.hexdigest())], names=["a", "b", "depth", "ends_sha256"])


def ends(nodes: DataFrame) -> DataFrame:
    """(a, b, depth, ends_sha256) of the nodes at which conversations end."""
    rows = nodes.where(F.size("ends") > 0).select("a", "b", "depth", F.explode("ends").alias("conv_id"))
    order = ["a", "b", "depth", "conv_id"]
    dealt = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    # of each path a partition has one run of ids, larger than those of the partitions before
    runs = dealt.groupBy("a", "b", "depth", "part").agg(F.min("conv_id").alias("first"), F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("run"))
    runs = runs.select("a", "b", "depth", "first", "run").repartition("a", "b", "depth").sortWithinPartitions("a", "b", "depth", "first")
    return runs.mapInArrow(hashed_runs, "a long, b long, depth long, ends_sha256 string")


def subtree_sums(nodes: DataFrame, merged: DataFrame) -> DataFrame:
    """(a, b, depth, leaves, saved) of what each conversation adds to the subtrees along its path, without the root's."""
    path = ["a", "b", "depth"]
    met = nodes.where("depth > 0").join(merged.select(*path, "conv_id", "n_convs", F.col("more").alias("more_"), F.col("bytes").alias("bytes_")), path)
    rows = met.select("base", "band", *path, F.explode("convs").alias("conv"), "conv_id", "n_convs", "more_", "bytes_")
    mine = F.col("conv") == F.col("conv_id")
    leaf = F.when(mine & ~F.col("more_"), 1).otherwise(0).cast("long")
    saved = F.when(mine, (F.col("n_convs") - 1) * F.col("bytes_")).otherwise(0)
    rows = written(rows.select("band", *path, "conv", leaf.alias("leaf"), saved.alias("saved")))
    below = W.partitionBy("conv", "band").orderBy(F.col("depth").desc()).rowsBetween(W.unboundedPreceding, 0)
    later = W.partitionBy("conv").orderBy(F.col("band").desc()).rowsBetween(W.unboundedPreceding, -1)
    bands = rows.groupBy("conv", "band").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    after = lambda name: F.coalesce(F.sum(name).over(later), F.lit(0)).alias(f"later_{name}")
    bands = bands.select("conv", "band", after("leaf"), after("saved")).where("later_leaf <> 0 OR later_saved <> 0")
    inside = rows.select("conv", "band", *path, F.sum("leaf").over(below).alias("leaf"), F.sum("saved").over(below).alias("saved"))
    full = inside.join(bands, ["conv", "band"], "left")
    add = lambda name: (F.col(name) + F.coalesce(f"later_{name}", F.lit(0)))
    return full.groupBy(*path).agg(F.sum(add("leaf")).alias("leaves"), F.sum(add("saved")).alias("saved"))


EMPTY = hashlib.sha256(b"").hexdigest()


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    path = ["a", "b", "depth"]
    nodes = family_nodes(conversations, segment)
    merged = nodes.groupBy(*path).agg(
        F.min(F.col("convs")[0]).alias("conv_id"),
        F.sum(F.size("convs")).alias("n_convs"),
        F.max("more").alias("more"),
        F.max("bytes").alias("bytes"),
        F.max("parent_a").alias("parent_a"),
        F.max("parent_b").alias("parent_b"),
    )
    merged = written(merged)
    none, zero = F.lit(None), F.lit(0).cast("long")
    layout = ["conv_id", "n_convs", "parent_a", "parent_b", "child", "leaves", "saved", "ends_sha256"]

    def part(frame: DataFrame, **columns: Column) -> DataFrame:
        return frame.select(*path, *[columns.get(name, zero if name in ("child", "leaves", "saved") else none.cast("string" if name == "ends_sha256" else "long")).alias(name) for name in layout])

    # every node, what its children, its conversations and its ends say of it, in one aggregate
    saved = (F.col("n_convs") - 1) * F.col("bytes")
    root = merged.agg(F.sum(F.when(~F.col("more"), 1).otherwise(0)).alias("leaves"), F.sum(saved).alias("saved")).where("leaves IS NOT NULL")
    said = [
        part(merged, conv_id=F.col("conv_id"), n_convs=F.col("n_convs"), parent_a=F.col("parent_a"), parent_b=F.col("parent_b")),
        part(merged.where("depth > 0").select(F.col("parent_a").alias("a"), F.col("parent_b").alias("b"), (F.col("depth") - 1).alias("depth")), child=F.lit(1).cast("long")),
        part(subtree_sums(nodes, merged), leaves=F.col("leaves"), saved=F.col("saved")),
        part(root.select(zero.alias("a"), zero.alias("b"), zero.alias("depth"), "leaves", "saved"), leaves=F.col("leaves"), saved=F.col("saved")),
        part(ends(nodes), ends_sha256=F.col("ends_sha256")),
    ]
    union = said[0]
    for other in said[1:]:
        union = union.unionByName(other)
    pick = {"child": F.sum, "leaves": F.sum, "saved": F.sum}
    found = written(union.groupBy(*path).agg(*[pick.get(name, F.max)(name).alias(name) for name in layout]))
    parents = found.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    return found.join(parents, ["parent_a", "parent_b", "depth"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("child").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
