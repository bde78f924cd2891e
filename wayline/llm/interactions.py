"""Filter interaction audit: what each filter removes at each place of each order of the filters.

Some filters look at one text alone; one, the duplicate filter, fails a document whose text a smaller doc_id has
too. Copies are found by fingerprint-routed RDDs: a partition first keeps, of each text it reads, the smallest
doc_id alone (later copies are decided on the spot and travel without their text); these are partitioned by
xxhash of the text and sorted by fingerprint and doc_id, so a task holds one collision chain at a time, full texts
with their smallest doc_id, and tells every other id as a later copy. Rows, now (doc_id, part, mask of failed
filters), meet their labels, and combineByKey merges one vector of counts per part, with a place for every mask.
All orders of the filters are read off that vector.

A text that a third of all rows hold is one record a partition in the shuffle. Texts beyond `HELD` bytes in one
partition are passed on early, which costs records, not results.

Cases: null texts are empty (and so copies of each other); a null doc_id is a copy of nothing and nothing is a copy of
it, and has no label; rows of one doc_id and one text are no copies of each other, and each counts; a document with
several labels is good or toxic if one of them says so; null parts are the empty string; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.llm.common import whole_text

#: Bytes of texts that a task keeps to find copies in its own partition.
HELD = 32 << 20
#: Bytes of texts that a task of the shuffle by fingerprint is meant to read.
ROUTED = 64 << 20
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"
#: The name of the filter that fails later copies.
COPY = "E"


class Facts(NamedTuple):
    """What the filters know of a text."""

    words: int
    distinct: int
    capitals: int
    chars: int
    symbols: int


Filters = dict[str, Callable[[Facts], bool]]

FILTERS: Filters = {
    "A": lambda x: x.words < 50,
    "B": lambda x: 100 * x.distinct < 65 * x.words,
    "C": lambda x: 100 * x.capitals > 5 * x.chars,
    "D": lambda x: x.symbols > 0,
}


def facts(text: str) -> Facts:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes are split at the six ASCII white-space characters
    return Facts(
        len(words),
        len(set(words)),
        len(data) - len(data.translate(None, CAPITALS)),
        len(text),
        len(data) - len(data.translate(None, SYMBOLS)),
    )


def fingerprint(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def first_copies(rows: Iterator[tuple], filters: Filters, copy: int) -> Iterator[tuple]:
    """((fingerprint, doc_id), (text, mask, {part: rows})) of the smallest doc_id of each text of a partition.

    Of rows that are decided already the text is None.
    """
    tests = [(1 << i, test) for i, test in enumerate(filters.values())]
    chains: dict[str, list] = {}
    decided: dict[tuple, int] = {}
    held = 0

    def decide(doc: int | None, part: str, mask: int, n: int) -> None:
        decided[doc, part, mask] = decided.get((doc, part, mask), 0) + n

    def passed_on() -> Iterator[tuple]:
        for text, (mask, doc, parts) in chains.items():
            yield (fingerprint(text), doc), (text, mask, parts)
        for (doc, part, mask), n in decided.items():
            yield (xxhash.xxh64_intdigest(f"{doc} {part}"), doc or 0), (None, mask, (doc, part, n))
        chains.clear()
        decided.clear()

    for doc, part, text in rows:
        found = chains.get(text)
        if found is None or doc is None:
            mask = found[0] if found else sum(bit for known in [facts(text)] for bit, test in tests if test(known))
            if doc is None:
                decide(None, part, mask, 1)
            else:
                chains[text] = [mask, doc, {part: 1}]
                held += len(text) + 200
        elif doc > found[1]:
            decide(doc, part, found[0] | copy, 1)
        elif doc == found[1]:
            found[2][part] = found[2].get(part, 0) + 1
        else:
            for other, n in found[2].items():
                decide(found[1], other, found[0] | copy, n)
            found[1:] = doc, {part: 1}
        if held + 200 * len(decided) > HELD:
            yield from passed_on()
            held = 0
    yield from passed_on()


def later_copies(rows: Iterator[tuple], copy: int) -> Iterator[tuple]:
    """(doc_id, part, mask, n) of records sorted by fingerprint and doc_id."""
    known, chain = None, {}
    for (mark, doc), (text, mask, parts) in rows:
        if text is None:
            yield parts[0], parts[1], mask, parts[2]
            continue
        if mark != known:
            known, chain = mark, {}  # the collision chain: full text to smallest doc_id
        if doc > chain.setdefault(text, doc):
            mask |= copy
        for part, n in parts.items():
            yield doc, part, mask, n


def masks(docs: DataFrame, filters: Filters = FILTERS, part: str = "source") -> DataFrame:
    """(doc_id, part, mask, n): n documents of a doc_id that fail the filters whose bits are set; the copy filter is last."""
    copy = 1 << len(filters)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(part).cast("string"), F.lit("")), whole_text()).rdd
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(whole_text()))).first()[0] or 0  # an RDD's partitions are not fitted to its size later
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // ROUTED + 1)
    first = rows.mapPartitions(lambda part: first_copies(part, filters, copy))
    routed = first.repartitionAndSortWithinPartitions(n, lambda key: key[0])
    found = routed.mapPartitions(lambda part: later_copies(part, copy))
    return spark.createDataFrame(found, "doc_id long, part string, mask int, n long", verifySchema=False)


def count_vectors(marked: DataFrame, labels: DataFrame, size: int):
    """An RDD of (part, counts): a row of documents, of good ones and of toxic ones, with a column for every mask."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.expr("int(quality = 1)")).alias("good"), F.max(F.expr("int(toxic = 1)")).alias("toxic"))
    joined = marked.join(known, "doc_id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(0)), F.coalesce("toxic", F.lit(0)))

    def add(counts, row):
        mask, n, good, toxic = row
        counts[:, mask] += (n, n * good, n * toxic)
        return counts

    def merge(counts, others):
        counts += others
        return counts

    return joined.rdd.map(lambda r: (r[0], tuple(r)[1:])).combineByKey(lambda row: add(np.zeros((3, size), dtype=np.int64), row), add, merge)


def all_orders(part: str, counts: np.ndarray, names: str) -> Iterator[tuple]:
    """The rows of audit() for one part."""
    bits = {name: 1 << i for i, name in enumerate(names)}
    every = np.arange(counts.shape[1])
    orders = list(permutations(sorted(names)))
    steps, shapley = [], dict.fromkeys(names, 0)
    for order in orders:
        earlier = 0
        for step, name in enumerate(order, 1):
            bit = bits[name]
            fails, passed = (every & bit) > 0, (every & earlier) == 0
            removed = counts[:, fails & passed].sum(axis=1)
            redundant = counts[0, fails & ~passed].sum()
            kept = counts[0, passed & ~fails].sum()
            shapley[name] += removed[0]
            steps.append(("".join(order), step, name, kept, removed[0], redundant, counts[0, bit], removed[1], removed[2]))
            earlier |= bit
    for order, step, name, *numbers in steps:
        yield part, order, step, *map(int, numbers), int(shapley[name])


RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit(docs: DataFrame, labels: DataFrame, filters: Filters = FILTERS, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, as in `RESULT`.

    `filters` maps one-letter names to conditions of failure; the copy filter comes besides, as `COPY`. A part's
    vector has 2 ** k places and its result k * k! rows, so k is at most seven.
    """
    names = "".join(filters) + COPY
    if len(set(names)) != len(filters) + 1 or len(names) > 7:
        raise ValueError("filters need different names of one letter, and are at most six besides the copy filter")
    spark: SparkSession = docs.sparkSession
    vectors = count_vectors(masks(docs, filters, part), labels, 1 << len(names))
    return spark.createDataFrame(vectors.flatMap(lambda x: all_orders(x[0], x[1], names)), RESULT, verifySchema=False)
