"""Token ids as binary shards of shuffled planes.

Documents are dealt out by ranges of doc_id, sorted, encoded, and each range becomes one file. Its ids are cut into
blocks of a fixed number; a block is transposed into byte planes (all lowest bytes, then all second ones ...) or bit
planes, and each plane is compressed with zstandard on its own, since high planes hardly vary. The file ends with an index
of its chunks and documents, so a reader can take some chunks without the others.

A shard, numbers little-endian:

    chunk *        the compressed planes of one block, lowest first
    index          zstandard of: per chunk its offset (u8), ids (u8), crc32 of the ids as u4 (u4), bytes of each plane (u4 each);
                   per document its doc_id (i8), ids (u8), whether it has a doc_id (u1); each column whole, in that order
    footer         FOOTER: bytes of the index, chunks, documents, ids, shard number, planes, block
    every part is followed by MARK

Spark's text writer writes the parts (MARK is its line separator) and its committer moves whole files, so a shard
lies wherever Spark can write, and a lost executor leaves no half of one. binaryFile reads shards.

Cases: null texts are empty, so a document of them holds its end id alone; null doc_ids come first; rows of one doc_id come in
order of their texts' hashes, equal rows in the order they are read; a text of any length runs across blocks; other columns are not
read; an empty table gives shards without documents, or none.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayline.llm.common import whole_text, written
from wayline.llm.pieces import encoder

MARK = b"WLP1"
FOOTER = struct.Struct("<QQQQIII")
BLOCK = 1 << 16
LEVEL = 3
#: Planes of an id by their kind.
PLANES = {"byte": 4, "bit": 32}
#: Bytes of texts that a task encodes at a time.
BYTES = 4 << 20


def split_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of ids (u4), lowest first; bit planes are packed, their last byte filled with zeros."""
    rows = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(plane).tobytes() for plane in rows.T]
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(plane, bitorder="little").tobytes() for plane in bits.T]


def join_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    """The n ids whose planes are given."""
    rows = np.empty((n, 4), dtype=np.uint8)
    if kind == "byte":
        for i, plane in enumerate(planes):
            rows[:, i] = np.frombuffer(plane, dtype=np.uint8)
    else:
        bits = [np.unpackbits(np.frombuffer(plane, dtype=np.uint8), count=n, bitorder="little") for plane in planes]
        rows[:] = np.packbits(np.stack(bits, axis=1), axis=1, bitorder="little")
    return rows.reshape(-1).view("<u4")


class Shard:
    """Parts of one shard, from documents in order."""

    def __init__(self, number: int, kind: str = "byte", block: int = BLOCK):
        self.number, self.kind, self.block = number, kind, block
        self.pending: list[np.ndarray] = []
        self.waiting = self.total = self.offset = 0
        self.chunks: list[tuple[int, int, int, list[int]]] = []
        self.docs, self.sizes, self.known = array("q"), array("Q"), bytearray()
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, docs: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
        """The chunks that these documents fill."""
        self.docs.extend(doc or 0 for doc in docs)
        self.known.extend(doc is not None for doc in docs)
        self.sizes.extend(map(int, sizes))
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            every = np.concatenate(self.pending)
            whole = len(every) // self.block * self.block
            for at in range(0, whole, self.block):
                yield self._chunk(every[at : at + self.block])
            self.pending, self.waiting = [every[whole:].copy()], len(every) - whole

    def _chunk(self, ids: np.ndarray) -> bytes:
        planes = [self.compressor.compress(plane) for plane in split_planes(ids, self.kind)]
        self.chunks.append((self.offset, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), list(map(len, planes))))
        data = b"".join(planes)
        self.offset += len(data) + len(MARK)
        self.total += len(ids)
        return data

    def close(self) -> Iterator[bytes]:
        """The last chunk, the index and the footer."""
        if self.waiting:
            yield self._chunk(np.concatenate(self.pending))
        offsets, counts, sums, lengths = ([c[i] for c in self.chunks] for i in range(4))
        columns = [np.array(offsets, "<u8"), np.array(counts, "<u8"), np.array(sums, "<u4"), np.array(lengths, "<u4")]
        columns += [np.array(self.docs, "<i8"), np.array(self.sizes, "<u8"), np.frombuffer(bytes(self.known), np.uint8)]
        index = self.compressor.compress(b"".join(c.tobytes() for c in columns))
        yield index
        yield FOOTER.pack(len(index), len(self.chunks), len(self.docs), self.total, self.number, PLANES[self.kind], self.block)


class Index(NamedTuple):
    """What the end of a shard tells."""

    number: int
    kind: str
    total: int
    offsets: np.ndarray
    counts: np.ndarray
    sums: np.ndarray
    lengths: np.ndarray
    docs: np.ndarray
    sizes: np.ndarray
    known: np.ndarray


def read_index(data: bytes) -> Index:
    end = len(data) - len(MARK)
    if end < FOOTER.size or data[end:] != MARK:
        raise ValueError("not a shard of ids")
    size, chunks, docs, total, number, planes, _ = FOOTER.unpack(data[end - FOOTER.size : end])
    last = end - FOOTER.size - len(MARK)
    raw, at, out = zstandard.ZstdDecompressor().decompress(data[last - size : last]), 0, []
    for kind, n in (("<u8", chunks), ("<u8", chunks), ("<u4", chunks), ("<u4", chunks * planes), ("<i8", docs), ("<u8", docs), ("<u1", docs)):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    out[3] = out[3].reshape(chunks, planes)
    return Index(number, {n: k for k, n in PLANES.items()}[planes], total, *out)


def read_chunk(data: bytes, index: Index, i: int) -> np.ndarray:
    """The ids of chunk i; an error where they are not those that were written."""
    planes, at, unpack = [], int(index.offsets[i]), zstandard.ZstdDecompressor()
    for length in map(int, index.lengths[i]):
        planes.append(unpack.decompress(data[at : at + length]))
        at += length
    ids = join_planes(planes, int(index.counts[i]), index.kind)
    if zlib.crc32(ids.tobytes()) != index.sums[i]:
        raise ValueError(f"chunk {i} of shard {index.number} is damaged")
    return ids


def ids_between(data: bytes, first: int, end: int) -> np.ndarray:
    """The ids from place `first` to before place `end` of a shard; only their chunks are unpacked."""
    index = read_index(data)
    stops = np.cumsum(index.counts.astype(np.int64))
    starts = stops - index.counts.astype(np.int64)
    wanted = np.flatnonzero((starts < end) & (stops > first))
    if not len(wanted):
        return np.empty(0, "<u4")
    every = np.concatenate([read_chunk(data, index, i) for i in wanted])
    return every[max(first - starts[wanted[0]], 0) : end - starts[wanted[0]]]


def documents(data: bytes) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """(shard, doc_id, place in the shard, ids) of each document; chunks are unpacked one at a time."""
    index = read_index(data)
    chunks = (read_chunk(data, index, i) for i in range(len(index.offsets)))
    held, place = np.empty(0, "<u4"), 0
    for doc, n, known in zip(index.docs.tolist(), index.sizes.tolist(), index.known.tolist(), strict=True):
        parts, missing = [held[:n]], n - min(n, len(held))
        held = held[n:]
        while missing:
            held = next(chunks)
            parts.append(held[:missing])
            held, missing = held[missing:], missing - len(parts[-1])
        yield index.number, doc if known else None, place, np.concatenate(parts) if len(parts) > 1 else parts[0]
        place += n


def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(doc_ids, texts) of about BYTES."""
    docs, texts, size = [], [], 0
    for batch in rows:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            docs.append(doc)
            texts.append(text)
            size += len(text)
            if size >= BYTES:
                yield docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int | None = 0, kind: str = "byte", block: int = BLOCK) -> None:
    """Writes the ids of docs(doc_id, text) to shards in a new folder, in ascending order of doc_id over shards in order of number.

    vocabulary is the JSON text of a byte-level BPE tokenizer; end_id, unless None, ends each document.
    """
    if kind not in PLANES:
        raise ValueError(f"planes are of {sorted(PLANES)}")
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a vocabulary has a fixed size

    def shard(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out = encoder(known.value).encode, Shard(TaskContext.get().partitionId(), kind, block)
        part = lambda data: pa.record_batch([pa.array([data], pa.binary())], names=["part"])
        for some, texts in batches(rows):
            ids, sizes = encode(texts)
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                sizes = sizes + 1
            yield from map(part, out.add(some, sizes, ids))
        yield from map(part, out.close())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # the hash and the place where a row is read only divide rows of one doc_id
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc(), F.col("read").asc()]
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("read", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    parts = dealt.mapInArrow(shard, "part binary").select(F.col("part").cast("string").alias("value"))
    parts.write.option("lineSep", MARK.decode()).option("compression", "none").text(folder)


def read_ids(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of the documents in a folder of shards.

    start counts the ids of all documents before it; ids is an array, left out unless asked for.
    """

    def unpack(files: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in files:
            for data in batch.column(0):
                rows, size = [], 0
                for row in documents(data.as_py()):
                    rows.append(row)
                    size += 64 + len(row[3])
                    if size > 1 << 20:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = {
            "shard": pa.array([r[0] for r in rows], pa.int32()),
            "doc_id": pa.array([r[1] for r in rows], pa.int64()),
            "place": pa.array([r[2] for r in rows], pa.int64()),
            "n_tokens": pa.array([len(r[3]) for r in rows], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(r[3].tobytes()) for r in rows], pa.int64()),
        }
        if ids:
            columns["ids"] = pa.array([r[3].tolist() for r in rows], pa.list_(pa.int64()))
        return pa.record_batch(list(columns.values()), names=list(columns))

    schema = "shard int, doc_id long, place long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    files = spark.read.format("binaryFile").load(folder).select("content")
    rows = written(files.mapInArrow(unpack, schema))  # files are unpacked once
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))  # one row a file
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    firsts = totals.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(firsts, "shard").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)
