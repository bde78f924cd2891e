import random
import re

import pytest

from wayline.llm import minhash
from wayline.llm.graph import components
from wayline.llm.minhash import near_duplicates


def brute(rows, width, percent):
    sets = []
    for _, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        n = min(width, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((doc, len(sets[i]), least[root(i)], doc == least[root(i)]) for i, (doc, _) in enumerate(rows))


def corpus():
    draw = random.Random(5)
    words = [f"W{i}é" for i in range(300)]
    rows, line = [], " ".join(draw.choice(words) for _ in range(30))
    for _ in range(25):
        base = [draw.choice(words) for _ in range(draw.randint(20, 200))]
        for _ in range(draw.randint(1, 6)):
            copy = list(base)
            for _ in range(draw.randint(0, 6)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append(" ".join(copy) + "\n" * draw.randint(0, 2) + line * draw.randint(0, 1))
    base = [draw.choice(words) for _ in range(150)]
    for _ in range(90):  # more than one group may hold
        copy = list(base)
        for _ in range(draw.randint(0, 9)):
            copy[draw.randrange(len(copy))] = draw.choice(words)
        rows.append(" ".join(copy))
    rows += [None, "", " \n", "one", "ONE", "one two", "One  two", "two one", rows[0], rows[0]]
    draw.shuffle(rows)
    return [(1000 - 3 * i, text) for i, text in enumerate(rows)]


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_same_classes_as_brute_force(spark, width, percent, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(*r, b"", 1) for r in rows], "doc_id long, text string, node binary, size int")
    got = near_duplicates(docs, width, percent).collect()
    assert sorted(map(tuple, got)) == brute(rows, width, percent)


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "A b c d"), (None, "a b c d"), (None, "z")], "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(docs, 3, 85).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, 1, False), (None, 1, None, True)], key=str)
    assert near_duplicates(docs.where("false")).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (100, 101), (7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {90: 90, 100: 90, 101: 90}


def test_collision_threshold():
    assert minhash.matches(100) == minhash.COORDINATES
    assert minhash.matches(80) < minhash.matches(85) < 40


def test_null_ids_are_linked_like_others(spark):
    words = [f"w{i}" for i in range(120)]
    text = lambda *changed: " ".join(f"x{i}" if i in changed else w for i, w in enumerate(words))
    other = " ".join(f"y{i}" for i in range(60))
    near = [(7, text()), (None, text(3))]
    bridge = [(5, other + " " + text(0)), (None, other + " " + text()), (9, other + " " + text(119)), (9, text(3) + " alone " * 80)]
    lone = [(None, " ".join(f"z{i}" for i in range(90))), (None, " ".join(f"z{i}" for i in range(91)))]
    chain = [(20, text(*range(0, 4)) + other[:30]), (None, text(*range(2, 4)) + other[:30]), (21, text() + other[:30])]
    for rows in (near, near + bridge, near + bridge + lone, chain):
        named = [(1000 + i if doc is None else doc, t) for i, (doc, t) in enumerate(rows)]
        want = {(n, c if c < 1000 else None) for _, n, c, _ in brute(named, 3, 85)}
        got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
        assert {(r.n_shingles, r.component_id) for r in got} == want
    assert {r.component_id for r in near_duplicates(spark.createDataFrame(near, "doc_id long, text string"), 3, 85).collect()} == {7}


def test_a_null_id_bridge(spark):
    """Two documents that are no near copies of each other, and one without an id that is of both."""
    words = [f"w{i}" for i in range(200)]
    text = lambda a, b: " ".join(words[a:b])
    docs = spark.createDataFrame([(5, text(0, 180)), (None, text(10, 190)), (9, text(20, 200))], "doc_id long, text string")
    assert sorted((r.component_id, r.kept) for r in near_duplicates(docs, 3, 85).collect()) == [(5, False), (5, False), (5, True)]
    assert len({r.component_id for r in near_duplicates(docs.where("doc_id is not null"), 3, 85).collect()}) == 2
