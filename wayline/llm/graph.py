"""Connected components by contraction, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges(a, b): root is the smallest node of its component.

    Each round maps every node to its smallest neighbour (or itself), follows that map once more, and contracts
    the edges by it; rounds grow with the logarithm of a component's width. Edges with a null end and loops are
    left out, repeated ones count once.
    """
    left = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found = None
    while left.take(1):
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root"))
        near = written(near)
        hop = near.select(F.col("node").alias("root"), F.col("root").alias("next"))
        near = written(near.join(hop, "root").select("node", F.col("next").alias("root")))
        if found is None:
            found = near
        else:
            step = near.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = written(found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        of = lambda name: near.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
        ends = left.join(of("a"), "a").join(of("b"), "b").where("a_root <> b_root")
        left = written(ends.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct())
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
