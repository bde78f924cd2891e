"""Near-duplicates: an inverted join of MinHash coordinates, confirmed on full shingle sets.

Equal shingle sets are one node. A node is posted under its (coordinate, value) pairs; pairs that one node
alone holds are left out, and with them every node that has fewer than MATCHES left. The rest are ordered from
rare to frequent: two nodes that agree in MATCHES coordinates share a pair among the first (held - MATCHES + 1)
of either, so only those prefixes are merged and the long lists at the end are skipped.

1. Of every prefix list the node whose pairs are the most frequent ones is the head: in a group of near copies,
   the text the others come from. Collisions of every node with the heads of its lists are counted, those above
   the threshold are confirmed on full sets, and the links contracted. That takes as many rows as there are postings.
2. Nodes of lists that still hold several components are posted once more, now under their shingles themselves
   and by the same rule: rare to frequent, the prefix beyond which the similarity asked for cannot be reached. What
   documents have in common without being near copies (passages, lines) is at the skipped end. In every list the
   nodes outside its largest component are compared with those of other components, in blocks of BLOCK nodes.
   Pairs above the collision threshold, and for which enough shingles follow in both, are confirmed as before.

MATCHES is the largest count of COORDINATES that pairs at the similarity asked for fall short of with a
probability below MISSED; no other step misses a link.

Cases: null, empty and blank texts have an empty set and are linked with nothing; with fewer words than a
shingle the whole sequence is the one shingle; repeated rows are copies of each other and each is returned;
rows with a null doc_id are linked like any others, but a null never names a component unless it is the only one there; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import row_key, whole_text, written
from wayline.llm.graph import components

COORDINATES = 40
MISSED = 1e-8
#: Nodes of a list, or partners of a head, that are compared at a time.
BLOCK = 64
#: Distinct words whose hashes a worker remembers; beyond it the memory starts anew.
REMEMBERED = 100_000

_draw = np.random.Generator(np.random.PCG64(20_240_501))
_FACTORS = _draw.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _draw.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def matches(percent: int) -> int:
    """The largest t that a binomial of COORDINATES trials falls short of with a probability below MISSED."""
    p, below = percent / 100, 0.0
    for t in range(COORDINATES):
        below += comb(COORDINATES, t) * p**t * (1 - p) ** (COORDINATES - t)
        if below >= MISSED:
            return t
    return COORDINATES


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingles:
    """Sets of hashed shingles of `width` words, A-Z in lower case, words ended by ASCII white space."""

    def __init__(self, width: int):
        self.width, self.known = width, WordHashes()
        self.places = mixed(np.arange(1, width + 1, dtype=np.uint64) * _PLACES[0])

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        each = np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(self.width, len(words))
        total = np.full(len(words) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            total += mixed(each[k : len(each) - width + 1 + k] ^ self.places[k])
        return np.unique(mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """For every coordinate the least image of the set, and the coordinate itself in the six highest bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 1024):
        part = shingles[None, start : start + 1024] * _FACTORS[:, None] + _OFFSETS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return ((least >> np.uint64(6)) | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(58))).view(np.int64)


def set_key(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def signed(width: int):
    """For mapInArrow: (doc_id, row, text as bytes) -> size and key of the set, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingles(width)
        for batch in batches:
            sizes, keys, tokens = [], [], []
            for text in batch.column(2).to_pylist():
                found = shingle(text)
                sizes.append(len(found))
                keys.append(set_key(found))
                tokens.append(signature(found) if len(found) else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "row", "n_shingles", "node", "tokens"])

    return run


def prefixes(posted: DataFrame, need: DataFrame) -> DataFrame:
    """(token, at, node, weight, held) of the prefixes of posted(node, token): of the tokens that other nodes hold too, the
    rarest, as many as leave need - 1 of need(node, need). at is a token's place among the held ones of its node, weight
    tells how frequent these are."""
    held = posted.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    held = posted.join(held, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("held"), F.sum(F.log2("n")).alias("weight"))
    held = held.join(need, "node").where(F.size("held") >= F.col("need"))
    first = F.slice("held.token", F.lit(1), F.size("held") - F.col("need") + 1)
    return held.select("node", "weight", F.size("held").alias("held"), F.posexplode(first).alias("at", "token"))


def same_block(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Batches of sorted rows cut where one of the first `keys` columns changes, and whether a new block begins."""
    last = None
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns[:keys]), strict=True))
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[start]:
                yield rows[start] != last, batch.slice(start, i - start)
                last, start = rows[start], i


def pairs_of(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["a", "b"])


def crossing(least: int, percent: int):
    """For mapInArrow: (token, block, asks, node, root, size, rest, tokens), sorted -> pairs of an asking node and one of the
    block that have different roots and agree in `least` coordinates. rest is how many shingles of a node follow in the
    order from rare to frequent: if the token is the first that a similar pair shares, enough must follow in both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, roots, numbers, known, found = [], [], [], [], []
        for new, part in same_block(batches, 2):
            if new:
                nodes, roots, numbers, known = [], [], [], []
            signatures = part.column(7).flatten().to_numpy().reshape(-1, COORDINATES)
            for asks, node, root, size, rest, mine in zip(*(part.column(k).to_pylist() for k in range(2, 7)), signatures, strict=True):
                if not asks:
                    nodes.append(node)
                    roots.append(root)
                    numbers.append((size, rest))
                    known.append(mine)
                    continue
                if isinstance(known, list):
                    known = np.array(known, dtype=np.int64).reshape(-1, COORDINATES)
                    sizes, rests = np.array(numbers, dtype=np.int64).reshape(-1, 2).T
                enough = (1 + np.minimum(rests, rest)) * (100 + percent) >= percent * (sizes + size)
                near = np.flatnonzero(enough & ((known == mine).sum(axis=1) >= least))
                found += [(node, nodes[i]) for i in near if roots[i] != root]
            if len(found) > 10_000:
                yield pairs_of(found)
                found = []
        yield pairs_of(found)

    return run


def confirming(width: int, percent: int):
    """For mapInArrow: (b, part, partner, node, text), sorted -> pairs (partner, b) that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, head = Shingles(width), None
        for new, part in same_block(batches, 2):
            head, found = None if new else head, []
            for b, partner, node, text in zip(*(part.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True):
                mine = shingle(text)
                if set_key(mine) != node:  # another row may have the same key and another text
                    continue
                if not partner:
                    head = mine
                    continue
                shared = len(np.intersect1d(head, mine, assume_unique=True)) if head is not None else 0
                if 100 * shared >= percent * (len(head) + len(mine) - shared if shared else 1):
                    found.append((node, b))
            yield pairs_of(found)

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs(a, b) whose texts(node, text) are similar enough; partners of one node are dealt out in parts."""
    many = pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    dealt = written(pairs.join(many, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part")))
    heads = dealt.select("b", "part").distinct().select("b", "part", F.lit(False).alias("partner"), F.col("b").alias("node"))
    rows = dealt.select("b", "part", F.lit(True).alias("partner"), F.col("a").alias("node")).unionByName(heads)
    rows = rows.join(texts, "node").select("b", "part", "partner", "node", F.col("text").cast("binary").alias("text"))
    rows = rows.repartition("b", "part").sortWithinPartitions("b", "part", "partner")
    return rows.mapInArrow(confirming(width, percent), "a binary, b binary")


def colliding(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """The pairs(a, b) whose signatures in nodes(node, tokens) agree in `least` coordinates."""
    of = lambda name: nodes.select(F.col("node").alias(name), F.col("tokens").alias(f"{name}_tokens"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return both.where(F.size(F.array_intersect("a_tokens", "b_tokens")) >= least).select("a", "b")


def with_roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes(node, ...) with the root of each under links(a, b)."""
    return nodes.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))


def shingled(width: int, percent: int):
    """For mapInArrow: (node, text as bytes) -> its shingles, and how many of them a similar node shares at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingles(width)
        for batch in batches:
            for node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = shingle(text)
                if set_key(found) == node:
                    columns = [pa.array([node], pa.binary()), pa.array([-(-percent * len(found) // 100)], pa.int32()), pa.array([found.view(np.int64)], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, ["node", "need", "shingles"])

    return run


def links(nodes: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that connect what is similar among nodes(node, tokens, row), whose texts are in rows(row, text)."""
    least = matches(percent)
    posted = nodes.select("node", F.explode("tokens").alias("token"))
    prefix = written(prefixes(posted, nodes.select("node", F.lit(least).alias("need"))))
    heads = prefix.groupBy("token").agg(F.max(F.struct("weight", "node")).getField("node").alias("b"), F.count("*").alias("n")).where("n > 1")
    lists = written(prefix.join(heads, "token").select("token", "node", "b"))
    active = lists.select("node").distinct().join(nodes, "node")
    # equal rows have one key, so only one text of them goes on
    texts = written(active.select("node", "row").join(rows, "row").dropDuplicates(["row", "node", "text"]).select("node", "text"))
    active = written(active.select("node", "tokens"))
    stars = lists.where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    first = written(confirmed(colliding(stars, active, least), texts, width, percent))
    state = written(with_roots(active, first))
    roots = state.select("node", "root")
    open_lists = lists.join(roots, "node").groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token")
    open_nodes = written(lists.join(open_lists, "token").select("node").distinct())
    sets = texts.join(open_nodes, "node").select("node", F.col("text").cast("binary")).mapInArrow(shingled(width, percent), "node binary, need int, shingles array<long>")
    sets = written(sets)
    prefix = written(prefixes(sets.select("node", F.explode("shingles").alias("token")), sets.select("node", "need")))
    placed = prefix.join(sets.select("node", F.size("shingles").alias("size")), "node").join(roots, "node")
    placed = placed.select("token", "node", "root", "size", (F.col("held") - F.col("at") - 1).alias("rest"))
    counts = placed.groupBy("token", "root").agg(F.count("*").alias("n")).groupBy("token").agg(F.max(F.struct("n", "root")).getField("root").alias("main"), F.sum("n").alias("n"), F.count("*").alias("kinds"))
    counts = counts.where("kinds > 1").select("token", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = written(placed.join(counts, "token"))
    own = placed.select("token", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), F.lit(False).alias("asks"), "node", "root", "size", "rest")
    asking = placed.where("root <> main").select("token", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asks"), "node", "root", "size", "rest")
    met = own.unionByName(asking).join(active, "node").select("token", "block", "asks", "node", "root", "size", "rest", "tokens")
    met = met.repartition("token", "block").sortWithinPartitions("token", "block", "asks").mapInArrow(crossing(least, percent), "a binary, b binary")
    met = written(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return first.unionByName(written(confirmed(met, texts, width, percent)))


def classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, row, n_shingles, component_id, root) of every row of docs(doc_id, text): row is its row_key, root tells
    its component whatever ids are in it, null for an empty set."""
    rows = docs.select("doc_id", row_key().alias("row"), whole_text().alias("text"))
    signatures = rows.select("doc_id", "row", F.col("text").cast("binary")).mapInArrow(signed(width), "doc_id long, row long, n_shingles long, node binary, tokens array<long>")
    found = written(signatures)
    nodes = found.where("node is not null").groupBy("node")
    nodes = written(nodes.agg(F.first("tokens").alias("tokens"), F.min("doc_id").alias("doc_id"), F.min("row").alias("row")))
    roots = components(links(nodes.select("node", "tokens", "row"), rows.select("row", "text"), width, percent))
    named = nodes.select("node", "doc_id").join(roots, "node")
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = named.join(names, "root").select("node", "root", "component_id")
    own = nodes.select("node", "doc_id").join(linked, "node", "left")
    own = own.select("node", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("root", "node").alias("root"))
    out = found.select("doc_id", "row", "n_shingles", "node").join(own, "node", "left")
    return out.select("doc_id", "row", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "root")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs(doc_id, text).

    Rows are linked where 100 * |intersection| >= percent * |union| of their distinct shingles of `width` words;
    component_id is the smallest doc_id that links reach.
    """
    out = classes(docs, width, percent).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def representatives(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, row, n) of one row of each class of near copies: of the smallest doc_id, a null after all others, and
    of the smallest row_key; n rows of docs are equal to it. Of rows with an empty set equal ones are a class."""
    alone = F.col("root").isNull()
    each = classes(docs, width, percent).select("root", F.when(alone, F.col("row")).alias("single"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    each = each.groupBy(*each.columns).agg(F.count("*").alias("n"))
    least = F.min(F.struct("unnamed", "doc_id", "row", "n")).alias("x")
    return each.groupBy("root", "single").agg(least).select("x.doc_id", "x.row", "x.n")
