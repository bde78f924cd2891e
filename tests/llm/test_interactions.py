from itertools import permutations
from math import factorial

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayline.llm import interactions
from wayline.llm.interactions import FILTERS, audit, facts, first_copies, later_copies, masks

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def failed(rows):
    """The letters that each row fails, by the contract."""
    out = []
    for doc, text, _ in rows:
        text = text or ""
        known = facts(text)
        bad = {name for name, test in FILTERS.items() if test(known)}
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows):
            bad.add("E")
        out.append(bad)
    return out


def brute(rows, labels):
    bad, out = failed(rows), []
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    for part in sorted({s or "" for _, _, s in rows}):
        mine = [(d, b) for (d, _, s), b in zip(rows, bad, strict=True) if (s or "") == part]
        removed_in_all = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(mine)
            for f in order:
                removed_in_all[f] += sum(f in b for _, b in left)
                left = [x for x in left if f not in x[1]]
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, f in enumerate(order, 1):
                here = [x for x in left if f in x[1]]
                kept = [x for x in left if f not in x[1]]
                redundant = sum(f in b for _, b in mine) - len(here)
                unique = sum(b == {f} for _, b in mine)
                out.append(
                    (part, "".join(order), step, len(kept), len(here), redundant, unique, sum(d in good for d, _ in here), sum(d in toxic for d, _ in here), removed_in_all[f])
                )
                left = kept
    return sorted(out)


LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, LONG, "a"),
    (2, LONG, "a"),
    (2, LONG, "a"),
    (3, LONG + " $", "b"),
    (4, "", None),
    (5, None, ""),
    (None, None, "b"),
    (None, LONG, "a"),
    (6, "UP up up up", "a"),
    (0, "UP up up up", "b"),
    (7, "same " * 80, "a"),
    (-3, "same " * 80, "c"),
    (8, "   é É", "c"),
    (9, LONG.upper(), "a"),
    (9, "another text of 9", "b"),
    (10, LONG * 300, "a"),
]
KNOWN = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (6, 1, None), (None, 1, 1), (7, 0, 1)]


def test_every_order_of_every_part(spark):
    docs = spark.createDataFrame(ROWS, DOCS).withColumn("part", F.lit(1)).withColumn("n", F.lit("x")).repartition(3)
    got = audit(docs, spark.createDataFrame(KNOWN, LABELS).withColumn("part", F.lit(2)))
    found = sorted(map(tuple, got.collect()))
    assert found == brute(ROWS, KNOWN)
    assert len(found) == 4 * 5 * factorial(5)


def test_small_memory_changes_nothing(spark, monkeypatch):
    first = list(first_copies(((d, s or "", t or "") for d, t, s in ROWS), FILTERS, 16))
    monkeypatch.setattr(interactions, "HELD", 1)
    early = list(first_copies(((d, s or "", t or "") for d, t, s in ROWS), FILTERS, 16))
    assert len(early) > len(first)
    total = lambda rows: sum(n for *_, n in later_copies(sorted(rows, key=lambda r: r[0]), 16))
    assert total(first) == total(early) == len(ROWS)


def test_no_rows(spark):
    assert audit(spark.createDataFrame([], DOCS), spark.createDataFrame(KNOWN, LABELS)).count() == 0
    assert audit(spark.createDataFrame(ROWS, DOCS), spark.createDataFrame([], LABELS)).count() == 2400


def test_other_filters_and_parts(spark):
    docs = spark.createDataFrame([(1, "x y", "en"), (2, "x y", "en"), (3, "", "fr")], "doc_id long, text string, lang string")
    got = audit(docs, spark.createDataFrame([], LABELS), {"Z": lambda x: x.words == 0}, part="lang").collect()
    assert [(r.part, r.filter_order, r.step, r.removed) for r in sorted(got)] == [
        ("en", "EZ", 1, 1), ("en", "EZ", 2, 0), ("en", "ZE", 1, 0), ("en", "ZE", 2, 1), ("fr", "EZ", 1, 0), ("fr", "EZ", 2, 1), ("fr", "ZE", 1, 1), ("fr", "ZE", 2, 0),
    ]
    with pytest.raises(ValueError):
        audit(docs, docs, {"E": lambda x: True})


def test_fingerprints_that_collide_keep_texts_apart(spark, monkeypatch):
    rows = [((7, 1), ("a", 0, {"s": 1})), ((7, 2), ("b", 0, {"s": 1})), ((7, 3), ("a", 1, {"s": 2})), ((7, 3), ("b", 0, {"t": 1})), ((8, 4), ("a", 0, {"s": 1}))]
    assert list(later_copies(iter(rows), 16)) == [(1, "s", 0, 1), (2, "s", 0, 1), (3, "s", 17, 2), (3, "t", 16, 1), (4, "s", 0, 1)]


def test_a_hot_text_is_one_record_a_partition(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(LONG).alias("text"), F.lit("s").alias("source")).repartition(4)
    marked = masks(rows)
    assert {(r["mask"], r["n"]) for r in marked.groupBy("mask").agg(F.sum("n").alias("n")).collect()} == {(0, 1), (16, 4999)}


@given(st.text())
def test_words_are_split_at_ascii_white_space_only(text):
    import regex

    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    known = facts(text)
    assert (known.words, known.distinct) == (len(words), len(set(words)))
    assert known.capitals == len(regex.findall("[A-Z]", text)) and known.symbols == len(regex.findall(r"[#$%&*|]", text))
