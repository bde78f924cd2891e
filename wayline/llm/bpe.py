"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks that overlap. Every chunk is pre-tokenised on its
own; a chunk that starts inside a pre-token reports boundaries only from its
first step from ink to white space, which is a boundary whatever came before.
Two neighbouring chunks are stitched at the first boundary both report in their
overlap. Where they share none (one pre-token runs through the overlap) they
stay together. The pieces between stitches are encoded in parallel and their
ids concatenated in order; decoding concatenates the bytes of the ids.

Cases: null and empty texts give no ids; a text of one chunk needs no stitch;
repeated rows give repeated results; rows with a null doc_id are encoded like
any others; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import whole_text

CHUNK = 1 << 15
OVERLAP = 1 << 10
#: Bytes of pre-tokens and their ids that a worker remembers; beyond it the memory starts anew.
REMEMBERED = 32 << 20
#: What an entry of that memory takes besides.
ENTRY = 200
#: Pre-tokens of more bytes are merged one by one.
SHORT = 64
#: Texts, in number and in bytes, that are worked on at a time.
ROWS, BYTES = 256, 1 << 20

Ranks = dict[bytes, int]


def parse_ranks(text: bytes) -> Ranks:
    """The ranks of a vocabulary file: lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in text.splitlines() if line)}


def read_ranks(path: str) -> Ranks:
    with open(path, "rb") as file:
        return parse_ranks(file.read())


def merge(piece: bytes, ranks: Ranks) -> list[int]:
    """The ids of one pre-token: the pair of lowest rank merges first, the leftmost of equals."""
    if piece in ranks:
        return [ranks[piece]]
    size = len(piece)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    ends = list(range(1, size + 1))
    heap = [(rank, i) for i in range(size - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * size
    while heap:
        rank, i = heapq.heappop(heap)
        if not alive[i] or (j := after[i]) >= size or ranks.get(piece[i : ends[j]]) != rank:
            continue
        alive[j], ends[i], after[i] = False, ends[j], after[j]
        if after[j] < size:
            before[after[j]] = i
            if (right := ranks.get(piece[i : ends[after[j]]])) is not None:
                heapq.heappush(heap, (right, i))
        if (h := before[i]) >= 0 and (left := ranks.get(piece[h : ends[i]])) is not None:
            heapq.heappush(heap, (left, h))
    out, i = [], 0
    while i < size:
        out.append(ranks[piece[i : ends[i]]])
        i = after[i]
    return out


class Pairs:
    """Two neighbouring ids -> the rank of their joined bytes; merges many pre-tokens at a time."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, ranks: Ranks):
        self.single = np.array([ranks.get(bytes([a]), -1) for a in range(256)], dtype=np.int32)
        joined = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                if (a := ranks.get(token[:cut])) is not None and (b := ranks.get(token[cut:])) is not None:
                    joined[a << 32 | b] = rank
        self.keys = np.array(sorted(joined), dtype=np.int64)
        self.joined = np.array([joined[key] for key in self.keys.tolist()], dtype=np.int32)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where it does not merge."""
        if not len(self.keys):
            return np.full(len(left), self.NONE)
        pairs = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.joined[at], self.NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """What `merge` gives for each of these pre-tokens, packed; none is empty or a token, and each byte has a rank.

        All lie one after the other. In each round every one merges its pair of lowest rank, and those without any leave.
        """
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), [len(piece) for piece in pieces])
        ids = self.single[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        pair = np.full(len(ids), self.NONE)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pair[inner] = self.of(ids[inner], ids[inner + 1])
        words, done = [], []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(starts, len(ids)))
            least = np.minimum.reduceat(pair, starts)
            if (least == self.NONE).any():
                leave = np.repeat(least == self.NONE, sizes)
                words.append(word[leave])
                done.append(ids[leave])
                ids, word, pair = ids[~leave], word[~leave], pair[~leave]
                sizes, least = sizes[least != self.NONE], least[least != self.NONE]
            at = np.flatnonzero(pair == np.repeat(least, sizes))
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])] if len(at) else at  # the leftmost of equals
            ids[at] = least
            stay = np.ones(len(ids), dtype=bool)
            stay[at + 1] = False
            ids, word, pair = ids[stay], word[stay], pair[stay]
            at = at - np.arange(len(at))
            pair[at] = self.NONE
            for left in (at[at > 0] - 1, at[at < len(ids) - 1]):
                left = left[word[left] == word[left + 1]]
                pair[left] = self.of(ids[left], ids[left + 1])
        if not words:
            return []
        words, done = np.concatenate(words), np.concatenate(done)
        packed = done[np.argsort(words, kind="stable")].tobytes()
        ends = (4 * np.cumsum(np.bincount(words, minlength=len(pieces)))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Encoded(dict):
    """Pre-token -> its ids as packed int32."""

    def __init__(self, ranks: Ranks, pairs: Pairs):
        super().__init__()
        self.ranks, self.pairs, self.size = ranks, pairs, 0
        self.bytes = {bytes([a]) for a in range(256)} <= ranks.keys()

    def learn(self, pieces: set[str]) -> None:
        """Holds the ids of all these pre-tokens; the memory starts anew before, where it is full."""
        if self.size >= REMEMBERED:
            self.clear()
            self.size = 0
        short = []
        for piece in pieces - self.keys():
            letters = piece.encode("utf-8", "surrogatepass")
            if letters in self.ranks or len(letters) > SHORT or not self.bytes:
                self._hold(piece, np.array(merge(letters, self.ranks), dtype=np.int32).tobytes())
            else:
                short.append((piece, letters))
        for (piece, _), ids in zip(short, self.pairs.merge([letters for _, letters in short]), strict=True):
            self._hold(piece, ids)

    def _hold(self, piece: str, ids: bytes) -> None:
        self[piece] = ids
        self.size += ENTRY + 4 * len(piece) + len(ids)


def id_lists(packed: list[bytes]) -> pa.ListArray:
    """An Arrow array of int lists from packed ids."""
    ends = np.cumsum([0, *(len(x) // 4 for x in packed)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))


class Letters:
    """Ids -> the bytes they stand for."""

    def __init__(self, ranks: Ranks):
        tokens = {rank: token for token, rank in ranks.items()}
        self.lengths = np.zeros(max(tokens, default=0) + 1, dtype=np.int64)
        for rank, token in tokens.items():
            self.lengths[rank] = len(token)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.letters = np.frombuffer(b"".join(tokens.get(rank, b"") for rank in range(len(self.lengths))), dtype=np.uint8)

    def of(self, lists: pa.ListArray) -> pa.Array:
        """A binary array of the bytes of each list of ids."""
        counts = np.array([x or 0 for x in pa.compute.list_value_length(lists).to_pylist()], dtype=np.int64)
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        size = self.lengths[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) + np.repeat(self.starts[ids] - (ends - size), size)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        data = pa.py_buffer(self.letters[source].tobytes())
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), data])


def portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to ROWS rows and, but for single ones, BYTES bytes."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= ROWS or total + size > BYTES):
            yield start, i
            start, total = i, 0
        total += size
    if sizes:
        yield start, len(sizes)


def encoder(pattern: str, shared, decoded: bool):
    """For mapInArrow: replaces the last column, a text, by its ids, and if `decoded` by the bytes these decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, pairs = shared.value
        find, known = regex.compile(pattern).findall, Encoded(ranks, pairs)
        letters = Letters(ranks) if decoded else None
        for batch in batches:
            texts = batch.columns[-1]
            for start, end in portions(pa.compute.binary_length(texts).to_pylist()):
                found = list(map(find, texts.slice(start, end - start).to_pylist()))
                known.learn(set().union(*found))
                ids = id_lists([b"".join(map(known.__getitem__, pieces)) for pieces in found])
                columns = [c.slice(start, end - start) for c in batch.columns[:-1]]
                more = [letters.of(ids)] if decoded else []
                yield pa.RecordBatch.from_arrays([*columns, ids, *more], [*batch.schema.names[:-1], "ids", *["bytes"] * decoded])

    return run


def boundaries(pattern: str, chunk: int, overlap: int):
    """For mapInArrow: (row, chunk number, chunk text, last chunk) -> boundaries in the overlaps with either neighbour."""
    anchor = regex.compile(r"(?<=\S)\s")

    def ends(text: str, first: bool, last: bool) -> list[int]:
        if first:
            found = [m.end() for m in regex.finditer(pattern, text)]
            if not last and found and found[-1] == len(text):
                found.pop()  # the pre-token may go on beyond the chunk
            return found
        if not (m := anchor.search(text)):
            return []
        cut = m.start()
        # pre-tokens from a true boundary on; where the chunk begins is none
        return [cut, *(cut + m.end() for m in regex.finditer(pattern, text[cut:]) if last or cut + m.end() < len(text))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"key": [], "seam": [], "side": [], "at": []}
            for row in batch.to_pylist():
                k, found = row["k"], ends(row["part"], row["k"] == 0, row["last"])
                head = [k * chunk + x for x in found if x <= overlap] if k else []
                tail = [k * chunk + x for x in found if x >= chunk] if not row["last"] else []
                for seam, side, at in ((k, 1, head), (k + 1, 0, tail)):
                    if at:
                        rows["key"].append(row["key"])
                        rows["seam"].append(seam)
                        rows["side"].append(side)
                        rows["at"].append(at)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("key", pa.binary()), ("seam", pa.int32()), ("side", pa.int32()), ("at", pa.list_(pa.int32()))]))

    return run


def encode(docs: DataFrame, ranks: Ranks, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of every row of docs(doc_id, text), and if `decoded` the bytes the ids decode to."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((ranks, Pairs(ranks)))  # a vocabulary file's fixed size
    rows = docs.select("doc_id", whole_text().alias("text"))
    encode_text, more = encoder(pattern, shared, decoded), ", bytes binary" * decoded
    short = rows.where(F.length("text") <= chunk + overlap)
    one_piece = short.mapInArrow(encode_text, f"doc_id long, ids array<int>{more}")
    # equal rows share their key and are counted, so each comes back as often as it came
    long = (
        rows.where(F.length("text") > chunk + overlap)
        .withColumn("key", F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(":"), "text"), 256)))
        .groupBy("key")
        .agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("n"))
    )
    size = F.length("text")
    last = F.floor((size - overlap - 1) / chunk).cast("int")  # the last chunk holds more than an overlap
    parts = long.select("key", F.posexplode(F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(F.col("text"), k * chunk + 1, F.lit(chunk + overlap)))).alias("k", "part"), last.alias("z"))
    parts = parts.select("key", "k", "part", (F.col("k") == F.col("z")).alias("last"))
    seen = parts.mapInArrow(boundaries(pattern, chunk, overlap), "key binary, seam int, side int, at array<int>")
    seams = (
        seen.groupBy("key", "seam")
        .agg(F.max(F.when(F.col("side") == 0, F.col("at"))).alias("tail"), F.max(F.when(F.col("side") == 1, F.col("at"))).alias("head"))
        .select("key", F.array_min(F.array_intersect("tail", "head")).alias("at"))
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("at")).alias("stitches"))
    )
    cuts = F.concat(F.array(F.lit(0)), F.coalesce("stitches", F.array().cast("array<int>")), F.array(size))
    pieces = (
        long.join(seams, "key", "left")
        .select("key", "doc_id", "n", "text", cuts.alias("cuts"))
        .select("key", "doc_id", "n", "text", "cuts", F.posexplode(F.slice("cuts", 1, F.size("cuts") - 1)).alias("piece", "start"))
        .select("key", "doc_id", "n", "piece", F.expr("substring(text, start + 1, cuts[piece + 1] - start)").alias("part"))
    )
    encoded = pieces.mapInArrow(encode_text, f"key binary, doc_id long, n long, piece int, ids array<int>{more}")
    names = ["ids", *["bytes"] * decoded]
    ordered = F.array_sort(F.collect_list(F.struct("piece", *names))).alias("pieces")
    whole = [F.flatten("pieces.ids").alias("ids"), *[F.unhex(F.array_join(F.transform("pieces.bytes", F.hex), "")).alias("bytes")] * decoded]
    joined = encoded.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), ordered)
    joined = joined.select("doc_id", *whole, F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
    return one_piece.unionByName(joined.select("doc_id", *names))


def decode(encoded: DataFrame, ranks: Ranks) -> DataFrame:
    """encoded with the bytes of its ids in a column named bytes; a null list has none."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters(shared.value)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            for start, end in portions([4 * (x or 0) for x in pa.compute.list_value_length(lists).to_pylist()]):
                rows = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*rows.columns, letters.of(lists.slice(start, end - start))], [*batch.schema.names, "bytes"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)
    return encoded.mapInArrow(run, f"{schema}, bytes binary")
