"""Exact top-k search by the three-phase uniform threshold.

Components are turned into integers, and a score is the sum of the partial scores of SLICES slices of a vector.
Vectors are dealt out in blocks, and every query goes to every block; a block's rows are held once and queries
stream by.

1. For each query a block lists the k best rows of every slice among one in SHARE of its rows, by partial scores
   alone. The scores of the listed rows are added up, and the k-th best of all gathered is a cutoff no result can
   be under: any k rows give one.
2. The cutoff goes back to the blocks. A row whose whole score reaches it has a slice that reaches a SLICES-th of
   it, so the rows with such a slice are sufficient.
3. Only their slices are added up, and the k best of each block that reach the cutoff merge into the result.

Scores are exact: doubles hold the sums below 2^53; beyond that they are added up as integers of any size.

Cases: vectors that are null, empty or hold null or non-finite components take no part; zero ones do; shorter
vectors end in zeros; a null vec_id takes no part; the query's own id is no candidate; repeated rows are
candidates each for themselves; a query id that is repeated is asked once, by its greatest vector; ties go to the
smaller vec_id; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import written
from wayline.llm.vectors import is_query, matrix, usable

SLICES = 4
ROWS = 4096
#: One in so many rows of a block is listed for the cutoff.
SHARE = 16
#: Parts in which the lists of a query are merged first.
PARTS = 64
SCALE = 256


def sliced(rows: np.ndarray, queries: np.ndarray) -> list[np.ndarray]:
    """The partial scores of all queries (down) and rows (across), slice by slice."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * rows.shape[1]
    if most >= 2**53:
        rows, queries = (np.array([[int(v) for v in r] for r in x], dtype=object).reshape(x.shape) for x in (rows, queries))
    edges = np.linspace(0, rows.shape[1], min(SLICES, rows.shape[1]) + 1).astype(int)
    return [queries[:, a:b] @ rows[:, a:b].T for a, b in zip(edges[:-1], edges[1:], strict=True)]


def listed(ids: np.ndarray, scores: np.ndarray, k: int) -> list[dict]:
    """The k best rows: greatest score first, ties to the smaller id."""
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    return [{"neg": -int(scores[i]), "vec_id": int(ids[i])} for i in order]


def local_lists(ids: np.ndarray, parts: list[np.ndarray], queries: list[tuple], k: int) -> list[list[dict]]:
    """Phase 1 in one block: for every query the k best rows of each slice, with their scores."""
    out = []
    for i, (query, _) in enumerate(queries):
        other = np.flatnonzero(ids != query)
        best = [other[np.argpartition(-part[i][other], min(k, len(other)) - 1)[:k]] for part in parts] if len(other) else []
        few = np.unique(np.concatenate(best)) if best else other
        out.append(listed(ids[few], sum(part[i][few] for part in parts), k))
    return out


def above_cutoff(ids: np.ndarray, parts: list[np.ndarray], queries: list[tuple], k: int) -> list[list[dict]]:
    """Phases 2 and 3 in one block."""
    out = []
    for i, (query, cutoff) in enumerate(queries):
        enough = ids != query
        if cutoff is not None:
            least = -(-cutoff // len(parts))  # scores are integers, so a slice reaches the share rounded up
            reached = np.zeros(len(ids), dtype=bool)
            for part in parts:
                reached |= (part[i] >= least).astype(bool)
            enough &= reached
        few = np.flatnonzero(enough)
        whole = sum(part[i][few] for part in parts)
        if cutoff is not None:
            keep = (whole >= cutoff).astype(bool)
            few, whole = few[keep], whole[keep]
        out.append(listed(ids[few], whole, k))
    return out


def streamed(score, width: int, k: int, share: int):
    """For mapInArrow: (block, asks, vec_id, embedding, cutoff), sorted -> lists of the queries; a block's rows come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, ids = None, None, None
        for batch in batches:
            blocks, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            edges = [0, *(1 + np.flatnonzero((blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1]))), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if blocks[a] != now:
                    now, rows, ids = blocks[a], np.empty((0, width)), np.empty(0, dtype=np.int64)
                numbers, vectors = part.column(2).to_numpy(), matrix(part.column(3), width)
                if not asks[a]:
                    rows, ids = np.concatenate([rows, vectors]), np.concatenate([ids, numbers])
                    continue
                some = slice(0, -(-len(ids) // share))
                queries = list(zip(numbers.tolist(), part.column(4).to_pylist(), strict=True))
                for at in range(0, len(queries), 256):
                    few = queries[at : at + 256]
                    hits = score(ids[some], sliced(rows[some], vectors[at : at + 256]), few, k)
                    kind = pa.list_(pa.struct([("neg", pa.int64()), ("vec_id", pa.int64())]))
                    yield pa.RecordBatch.from_arrays([pa.array([q for q, _ in few], pa.int64()), pa.array([int(now)] * len(few), pa.int32()), pa.array(hits, kind)], ["query_id", "block", "hits"])

    return run


def top_scores(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose vec_id is divisible by `every` its k highest scores."""
    rows = usable(vectors, zero=True).where("vec_id is not null")
    # whole numbers kept as doubles: floor() would cut off what is out of a long's range
    floored = F.transform("embedding", lambda x: F.rint(x * SCALE) - (F.rint(x * SCALE) > x * SCALE).cast("int"))
    rows = written(rows.select("vec_id", floored.alias("embedding")))
    size = rows.agg(F.max(F.size("embedding")).alias("width"), F.count("*").alias("n")).first()
    width, blocks = size.width or 1, max(1, -(-size.n // ROWS))
    block = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int")
    nothing = F.lit(None).cast("long").alias("cutoff")
    held = rows.select(block.alias("block"), F.lit(False).alias("asks"), "vec_id", "embedding", nothing)
    asked = rows.where(is_query(every)).groupBy("vec_id").agg(F.max("embedding").alias("embedding"))

    def meet(queries: DataFrame, score, share: int) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        spread = queries.select(each, F.lit(True).alias("asks"), "vec_id", "embedding", "cutoff")
        met = held.unionByName(spread).repartition("block").sortWithinPartitions("block", "asks")
        lists = met.mapInArrow(streamed(score, width, k, share), "query_id long, block int, hits array<struct<neg long, vec_id long>>")
        best = F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k).alias("hits")
        return lists.groupBy("query_id", F.pmod("block", F.lit(PARTS)).alias("part")).agg(best).groupBy("query_id").agg(best)

    first = meet(asked.withColumn("cutoff", nothing), local_lists, SHARE)
    cutoffs = first.select(F.col("query_id").alias("vec_id"), F.when(F.size("hits") == k, -F.element_at("hits", -1).getField("neg")).alias("cutoff"))
    flat = meet(asked.join(cutoffs, "vec_id", "left"), above_cutoff, 1).select("query_id", F.posexplode("hits").alias("at", "hit"))
    return flat.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.neg")).alias("score"))
