"""Approximate nearest neighbours by shifted space-filling curves.

Every vector gets a key on each of CURVES Hilbert curves: it is projected on a few random directions, each
coordinate is made uniform by the normal distribution's function, shifted by a random amount (around the edge)
and cut into cells, and the key is the cell's place on the curve. Spark partitions every curve by ranges of keys
into blocks of about BLOCK rows (parts of blocks, beyond RANGES blocks). A query is sent to the blocks around its
own key; each gives its best, by exact inner products in double precision, and the lists of all curves and blocks
merge into one.

How many blocks around is measured: for SAMPLE queries the true neighbours are found among all rows, and the least
reach is taken within which the share FOUND of them lies on some curve. Clustered vectors need a block or two. On
vectors without structure (the test tables hold random directions in 64 dimensions) no projection tells near from
far, windows come out wide, and about as many pairs are scored as there are.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part; shorter vectors end
in zeros; a null vec_id takes no part; repeated rows are candidates like any others, the query's own row is not
one; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.llm.common import written
from wayline.llm.vectors import is_query, matrix, stacked, usable

CURVES = 4
DIRECTIONS = 3
BITS = 12
BLOCK = 2048
#: Ranges of keys per curve at most: their bounds are broadcast. Longer blocks are dealt out in parts.
RANGES = 512
#: Queries whose true neighbours set the windows, and the share of these to be found.
SAMPLE = 128
FOUND = 0.93
#: Parts in which the lists of a query are merged first.
PARTS = 64
SEED = 20_240_503


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of cells: coordinates below 2^bits."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(n):
            high = (x[:, i] & q) > 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(high, q - 1, 0) ^ swap
            x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), dtype=np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(x[:, n - 1] & q, q - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> bit) & 1)
    return key


def keyed(width: int, curves: int):
    """For mapInArrow: (vec_id, embedding) -> the same with the keys on all curves."""
    draw = np.random.default_rng(SEED)
    directions = min(DIRECTIONS, width)
    bases = [np.linalg.qr(draw.standard_normal((width, directions)))[0] for _ in range(curves)]
    shifts = [draw.random(directions) for _ in range(curves)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width)
            unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
            keys = []
            for basis, shift in zip(bases, shifts, strict=True):
                y = unit @ basis * np.sqrt(width)
                even = 0.5 * (1 + np.tanh(0.7978845608 * (y + 0.044715 * y**3)))  # close to the normal distribution's function
                cells = np.minimum(((even + shift) % 1.0 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
                keys.append(hilbert_keys(cells, BITS))
            lists = np.stack(keys, axis=1) if len(x) else np.empty((0, curves), dtype=np.int64)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * curves
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists.ravel()))], ["vec_id", "embedding", "keys"])

    return run


def best_of(block: pd.DataFrame, queries: pd.DataFrame, width: int, k: int) -> pd.DataFrame:
    """For every query its k best rows of a block, as one list."""
    out = []
    if len(block) and len(queries):
        ids, numbers, rows = block["vec_id"].to_numpy(), block["row"].to_numpy(), stacked(block["embedding"], width)
        for query, q in zip(queries["vec_id"], stacked(queries["embedding"], width), strict=True):
            rough = rows @ q
            rough[ids == query] = -np.inf
            # rounding may part equal scores: all within it of the k-th are scored again, in one fixed order of sums
            few = np.flatnonzero(rough >= np.partition(rough, -min(k, len(rough)))[-min(k, len(rough))] - 1e-9 * (1 + np.abs(rough[np.isfinite(rough)]).max(initial=0)))
            few = few[ids[few] != query]
            exact = (rows[few] * q).sum(axis=1)
            order = np.lexsort((ids[few], -exact))[:k]
            out.append((query, [{"neg": -float(exact[i]), "vec_id": int(ids[few][i]), "row": int(numbers[few][i])} for i in order]))
    return pd.DataFrame(out, columns=["query_id", "hits"])


def distances(queries, cuts: np.ndarray, width: int, k: int):
    """For mapInArrow: (vec_id, embedding, keys) -> the k best rows of a partition for each of the queries, and how many
    blocks they are away from it on the curve on which they are nearest. queries: ids, vectors, keys."""

    def blocks_of(keys: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(cut, keys[:, c], side="left") for c, cut in enumerate(cuts)], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, keys = queries.value
        own, count = blocks_of(keys), cuts.shape[1] + 1
        best: list[list[tuple]] = [[] for _ in ids]
        for batch in batches:
            rows, numbers = matrix(batch.column(1), width), batch.column(0).to_numpy()
            here = blocks_of(batch.column(2).flatten().to_numpy().reshape(len(numbers), -1))
            scores = vectors @ rows.T
            for i, query in enumerate(ids):
                few = np.flatnonzero(numbers != query)
                few = few[np.argsort(-scores[i][few], kind="stable")[:k]]
                away = np.abs(here[few] - own[i])
                away = np.minimum(away, count - away).min(axis=1)
                best[i] = sorted([*best[i], *zip((-scores[i][few]).tolist(), numbers[few].tolist(), away.tolist(), strict=True)])[:k]
        flat = [(int(query), neg, away) for query, found in zip(ids, best, strict=True) for neg, _, away in found]
        kinds = (pa.int64(), pa.float64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in flat], kind) for c, kind in enumerate(kinds)], ["query_id", "neg", "away"])

    return run


def measured_reach(seen: DataFrame, cuts: np.ndarray, width: int, every: int, k: int, found: float) -> int:
    """The least number of blocks to either side that hold the share `found` of the true neighbours of SAMPLE queries."""
    some = seen.where(is_query(every)).orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(SAMPLE).collect()  # SAMPLE rows at most
    if not some:
        return 0
    vectors = np.zeros((len(some), width))
    for i, r in enumerate(some):
        vectors[i, : len(r.embedding)] = r.embedding
    queries = seen.sparkSession.sparkContext.broadcast((np.array([r.vec_id for r in some]), vectors, np.array([r["keys"] for r in some])))
    near = seen.select("vec_id", "embedding", "keys").mapInArrow(distances(queries, cuts, width, k), "query_id long, neg double, away int")
    place = F.row_number().over(W.partitionBy("query_id").orderBy("neg", "away"))
    counts = near.withColumn("place", place).where(F.col("place") <= k).groupBy("away").agg(F.count("*").alias("n")).orderBy("away").collect()  # at most RANGES rows
    total, so_far = sum(r.n for r in counts), 0
    for r in counts:
        so_far += r.n
        if so_far >= found * total:
            return r.away
    return 0


def neighbours(vectors: DataFrame, every: int = 20, k: int = 20, curves: int = CURVES, found: float = FOUND, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose vec_id is divisible by `every` its k nearest found."""
    rows = usable(vectors, zero=False).where("vec_id is not null")
    size = rows.agg(F.max(F.size("embedding")).alias("width"), F.count("*").alias("n")).first()
    width, blocks = size.width or 1, min(RANGES, max(1, -(-size.n // block)))
    seen = rows.mapInArrow(keyed(width, curves), "vec_id long, embedding array<double>, keys array<long>")
    seen = written(seen.withColumn("row", F.monotonically_increasing_id()))  # written, so a row keeps its number
    posted = seen.select("vec_id", "row", "embedding", F.posexplode("keys").alias("curve", "key"))
    # where the blocks of each curve begin: `blocks` numbers for each of a fixed number of curves
    marks = [i / blocks for i in range(1, blocks)]
    reach = 0
    if marks:
        cuts = posted.groupBy("curve").agg(F.percentile_approx("key", marks, 10_000).alias("cuts"))
        bounds = {r.curve: r.cuts for r in cuts.collect()}  # RANGES numbers for each curve
        lists = np.array([bounds[c] for c in range(curves)], dtype=np.int64) if bounds else np.zeros((curves, 0), dtype=np.int64)
        reach = min(measured_reach(seen, lists, width, every, k, found), (blocks - 1) // 2 + 1)
        posted = posted.join(F.broadcast(cuts), "curve").withColumn("block", F.size(F.filter("cuts", lambda cut: cut < F.col("key")))).drop("cuts")
    else:
        posted = posted.withColumn("block", F.lit(0))
    # equal keys make blocks uneven: a block is dealt out further, its queries go to every part
    parts = posted.groupBy("curve", "block").agg(F.ceil(F.count("*") / (2 * block)).cast("int").alias("parts"))
    placed = posted.join(parts, ["curve", "block"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    left = placed.select("curve", "block", "part", "vec_id", "row", "embedding")
    steps = sorted({step % blocks for step in range(-reach, reach + 1)})
    asked = posted.where(is_query(every)).select("curve", "block", "vec_id", "embedding").dropDuplicates(["curve", "vec_id"])
    asked = asked.withColumn("step", F.explode(F.array(*map(F.lit, steps)))).withColumn("block", F.pmod(F.col("block") + F.col("step"), F.lit(blocks)).cast("int"))
    asked = asked.join(parts, ["curve", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asked = asked.select("curve", "block", "part", "vec_id", "embedding")
    asked = asked.toDF(*(f"_{name}" for name in asked.columns)).toDF(*asked.columns)  # both sides come from one table
    keys = ["curve", "block", "part"]
    score = lambda block, queries: best_of(block, queries, width, k)
    lists = left.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(score, "query_id long, hits array<struct<neg double, vec_id long, row long>>")
    best = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))), 1, k).alias("hits")
    merged = lists.groupBy("query_id", F.pmod(F.xxhash64("hits"), F.lit(PARTS)).alias("part")).agg(best).groupBy("query_id").agg(best)
    flat = merged.select("query_id", F.posexplode("hits").alias("at", "hit"))
    return flat.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.neg")).alias("score"))
