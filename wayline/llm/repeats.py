"""Removal of long byte strings that occur more than once, by sorting suffixes group by group.

A window is a string of `length` bytes. Its anchor is the least hash of the short strings in it, so equal
windows have equal anchors at equal places, and neighbouring windows mostly share theirs: a stretch is a run of
windows with one anchor. Stretches meet by anchor. Those whose anchor occurs once hold no repeated window.
Equal stretches (by anchor and a 64-bit digest) repeat whole. Different stretches of one anchor are fetched, one
of each digest, cut down to the windows whose middles another one shares, and sorted into a suffix array by
Lyndon groups (suffixes.py), where equal windows are neighbours.
Groups of more than GROUP different stretches are divided further, by whole windows instead of their anchors.

Cases: null and empty texts and texts shorter than a window lose nothing; equal rows are occurrences of each
other, and each is returned; texts with a null doc_id are occurrences like any others; matches may overlap; texts
of one repeated letter work as any others; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import whole_text, written
from wayline.llm.suffixes import repeated_windows

GRAM = 32
GROUP = 48
#: Places of an anchor in a window that share a middle.
NEAR = 16
#: Bytes of texts hashed at a time.
BATCH = 1 << 19

_draw = np.random.Generator(np.random.PCG64(20_240_502))
_LETTERS = _draw.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _draw.integers(1, 1 << 63, 6, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from every position that has them."""
    h, width = _LETTERS[data], 1
    for step in _STEPS[: GRAM.bit_length() - 1]:
        h = h[:-width] * step + h[width:]
        width *= 2
    h ^= h >> np.uint64(33)
    h *= _STEPS[5]
    h ^= h >> np.uint64(29)
    return h


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def stretches(data: bytes, bounds: np.ndarray, length: int):
    """(anchor hash, anchor position, first and last window start) of every stretch of the texts in data.

    bounds: where the texts start, and where the last ends.
    """
    letters = np.frombuffer(data, dtype=np.uint8)
    valid = np.zeros(len(letters) + 1, dtype=np.int32)
    long = np.flatnonzero(np.diff(bounds) >= length)
    if not len(long):
        return None
    valid[bounds[long]] += 1
    valid[bounds[long + 1] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(valid[:-1]))
    hashes = gram_hashes(letters)
    packed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    at = (least_of(packed, length - GRAM + 1)[starts] & _PLACE).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(starts)) - 1
    return hashes[at[head]].view(np.int64), at[head], starts[head], starts[tail]


#: A stretch's place in its text, in one number: its first window's start, how many more follow, where the anchor is.
def packed(lo, more, ahead):
    return (lo << 16) | (more << 8) | ahead


def unpacked(place: int) -> tuple[int, int, int]:
    return place >> 16, place >> 8 & 255, place & 255


def anchored(length: int, most: int):
    """For mapInArrow: (doc, hash, text as bytes) -> stretches."""
    names = ["anchor", "same", "doc", "hash", "place"]

    def emit(ids: list, hashes: list, texts: list[bytes]):
        data, bounds = b"".join(texts), np.cumsum([0, *map(len, texts)])
        if (found := stretches(data, bounds, length)) is None:
            return
        anchor, at, lo, hi = found
        view = memoryview(data)
        same = [xxhash.xxh3_64_intdigest(view[a : b + length], c) for a, b, c in zip(lo.tolist(), hi.tolist(), (at - lo).tolist(), strict=True)]
        row = np.searchsorted(bounds, lo, side="right") - 1
        take = pa.array(row)
        columns = [pa.array(anchor), pa.array(np.array(same, dtype=np.uint64).view(np.int64)), pa.array(ids, pa.int64()).take(take), pa.array(hashes, pa.int32()).take(take)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(packed(lo - bounds[row], hi - lo, at - lo))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, texts, size = [], [], [], 0
            for doc, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # windows start in a text of up to 2^24 bytes together with its neighbours; a longer text goes in parts
                # that overlap by all but one byte of a window
                if size + len(text) > most and texts:
                    yield from emit(ids, hashes, texts)
                    ids, hashes, texts, size = [], [], [], 0
                if len(text) > 8 * most:
                    yield from pieces(doc, key, text)
                    continue
                ids.append(doc)
                hashes.append(key)
                texts.append(text)
                size += len(text)
            if texts:
                yield from emit(ids, hashes, texts)

    def pieces(doc, key, text: bytes):
        for start in range(0, len(text), most):
            for out in emit([doc], [key], [text[start : start + most + length - 1]]):
                yield pa.RecordBatch.from_arrays([*out.columns[:4], pa.compute.add(out.column(4), pa.scalar(start << 16, pa.int64()))], names)

    return run


STRETCH = "anchor long, same long, doc long, hash int, place long"


def fetched(length: int):
    """For mapInArrow: (doc, hash, text as bytes, stretches) -> the stretches with their bytes."""
    schema = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("hash", pa.int32()), ("place", pa.int64()), ("once", pa.bool_()), ("many", pa.bool_()), ("part", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, key, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                for x in found:
                    lo, more, _ = unpacked(x["place"])
                    rows.append({"doc": doc, "hash": key, **x, "part": text[lo : lo + more + length]})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def sorted_groups(length: int):
    """For mapInArrow: rows ordered by anchor -> spans of the windows of stretches seen once that another stretch has too."""

    def spans(group: list[tuple]) -> list[tuple]:
        rows = [(*unpacked(place), part) for _, _, place, _, part in group]
        # windows that have the anchor at places `a` to `b - 1` share all from the last's start to the first's end
        middles: dict[tuple, set] = defaultdict(set)
        for _, more, ahead, part in rows:
            for a in range(0, ahead + 1, NEAR):
                if a + NEAR > ahead - more:
                    middles[a, part[ahead - a : ahead - a - NEAR + 1 + length]].add((ahead, part))
        shared: dict[tuple, list[int]] = {}
        for (a, _), owners in middles.items():
            if len(owners) > 1:
                for owner in owners:
                    shared.setdefault(owner, []).append(a)
        cut = {}
        for _, more, ahead, part in rows:
            if places := shared.get((ahead, part)):
                first, last = max(0, ahead - max(places) - NEAR + 1), min(more, ahead - min(places))
                cut[ahead, part] = first, part[first : last + length]
        if len(cut) < 2:
            return []
        ranges = dict(zip(cut, repeated_windows([x for _, x in cut.values()], length), strict=True))
        out = []
        for (doc, key, _, once, _), (lo, _, ahead, part) in zip(group, rows, strict=True):
            if once and (ahead, part) in cut:
                base = lo + cut[ahead, part][0]
                out += [(doc, key, base + a, base + b - 1 + length) for a, b in ranges[ahead, part]]
        return out

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "hash", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []
        for batch in batches:
            done = []
            for anchor, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if anchor != now:
                    done += spans(group)
                    now, group = anchor, []
                group.append(tuple(row))
            yield out(done)
        yield out(spans(group))

    return run


def by_window(length: int):
    """For mapInArrow: stretches -> a digest of every window with its anchor's place in it."""
    names = ["window", "doc", "hash", "start", "once"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, key, place, once, part in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("doc", "hash", "place", "once", "part")), strict=True):
                lo, view = unpacked(place)[0], memoryview(part)
                rows += [(xxhash.xxh3_128_digest(view[i : i + length]), doc, key, lo + i, once) for i in range(len(part) - length + 1)]
            columns = list(zip(*rows, strict=True)) or [[], [], [], [], []]
            kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (doc_id, text as bytes, spans) -> merged spans and the bytes outside them."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        ids, merged, kept, sizes = batch.column(0), [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            runs: list[list[int]] = []
            for start, end in sorted((x["start"], x["end"]) for x in spans or ()):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([start, end])
            edges = [0, *(x for run in runs for x in run), len(text)]
            merged.append([{"start": a, "end": b} for a, b in runs])
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            sizes.append(len(text))
        yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(merged, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = 200, group: int = GROUP, batch: int = BATCH) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row of docs(doc_id, text): the runs of bytes that repeated windows
    cover, and the other bytes."""
    if not GRAM + NEAR <= length <= GRAM + 255:
        raise ValueError(f"length must be from {GRAM + NEAR} to {GRAM + 255}")
    rows = docs.select("doc_id", whole_text().alias("text"))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))  # never null: texts are told by it and their hash
    rows = rows.select("doc_id", doc.alias("doc"), F.hash("text").alias("hash"), F.col("text").cast("binary").alias("text"))
    long = rows.where(F.length("text") >= length).select("doc", "hash", "text")
    found = written(long.mapInArrow(anchored(length, batch), STRETCH))
    # what is joined is written first: Spark can then divide the many stretches of one anchor among tasks
    often = written(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    met = written(found.join(often, "anchor"))
    kinds = written(met.groupBy("anchor", "same").agg(F.count("*").alias("n"), F.min("doc").alias("doc")))
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max(F.col("n") == 1).alias("single"))
    mixed = written(mixed.where("kinds > 1 and single").select("anchor", (F.col("kinds") > group).alias("many")))
    lo, more = F.shiftright("place", 16).cast("int"), F.shiftright("place", 8).bitwiseAND(255).cast("int")
    copied = met.join(kinds.where("n > 1").select("anchor", "same"), ["anchor", "same"])
    whole = copied.select("doc", "hash", lo.alias("start"), (lo + more + length).alias("end"))
    wanted = kinds.join(mixed, "anchor").select("anchor", "same", "doc", (F.col("n") == 1).alias("once"), "many")
    wanted = met.join(wanted, ["anchor", "same", "doc"])
    per_text = wanted.groupBy("doc", "hash").agg(F.collect_set(F.struct("anchor", "place", "once", "many")).alias("found"))
    parts = rows.join(per_text, ["doc", "hash"]).select("doc", "hash", "text", "found")
    parts = written(parts.mapInArrow(fetched(length), "anchor long, doc long, hash int, place long, once boolean, many boolean, part binary"))
    few = parts.where("not many").select("anchor", "doc", "hash", "place", "once", "part")
    some = few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sorted_groups(length), "doc long, hash int, start int, end int")
    windows = written(parts.where("many").mapInArrow(by_window(length), "window binary, doc long, hash int, start int, once boolean"))
    twice = windows.groupBy("window").agg(F.count("*").alias("n"), F.max("once").alias("once")).where("n > 1 and once").select("window")
    rest = windows.where("once").join(written(twice), "window").select("doc", "hash", "start", (F.col("start") + length).alias("end"))
    spans = whole.unionByName(some).unionByName(rest).groupBy("doc", "hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    out = rows.join(spans, ["doc", "hash"], "left").select("doc_id", "text", "spans")
    return out.mapInArrow(without, "doc_id long, n_bytes long, spans array<struct<start int, end int>>, kept binary")
