import random
from collections import defaultdict

import pytest

from wayline.llm.mixing import mixed, mixture


def shares(size, weights, most):
    """Targets by resharing the excess until none is above."""
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(size.values()), set()
    while True:
        open_ = [s for s in order if s not in full]
        left = total - sum(most * size[s] for s in full)
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weight[s] * level > most * size[s]}
        if not over:
            return {s: most * size[s] if s in full else weight[s] * level for s in order}
        full |= over


def corpus(seed):
    draw = random.Random(seed)
    rows = []
    for source, n in (("a", 300), ("b", 40), ("é", 25), ("zz", 60), (None, 30), ("B", 3), ("empty", 2)):
        for _ in range(n):
            words = 0 if source == "empty" else int(draw.lognormvariate(3, 1)) + 1
            rows.append((len(rows), source, " ".join(["w"] * words)))
    return [*rows, (9000, "a", None), (9001, "b", " \t "), rows[5], rows[5]]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_are_met(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, size int, key int")
    out = mixture(docs)
    got, again = sorted(map(tuple, out.collect()), key=str), sorted(map(tuple, out.collect()), key=str)
    assert got == again and len(got) == len(rows)
    size, of = defaultdict(int), {}
    for doc, source, text in rows:
        size[source] += len((text or "").split())
        of[doc] = source
    want, taken = shares(size, (1, 2, 3), 3), defaultdict(int)
    for doc, _, words, whole, target, copies in got:
        assert whole == size[of[doc]] and target == pytest.approx(want[of[doc]], rel=1e-9, abs=1e-9)
        assert 0 <= copies <= 3
        taken[of[doc]] += copies * words
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(2, 0.003 * target), source
    assert mixed(docs.drop("size", "key")).count() == sum(r[5] for r in got if r[2])


def test_rates_are_the_tilted_ones(spark):
    """Within rounding, documents of a size get exp(lambda * size) copies for one lambda found by bisection."""
    from math import exp

    rows = [(i, "x", " ".join(["w"] * (1 + i % 7))) for i in range(7000)] + [(10_000 + i, "y", "w w") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixture(docs).collect()
    target = next(r.target for r in got if r.doc_id == 0)
    low, high = -50.0, 50.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(1000 * s * min(3, exp(mid * s)) for s in range(1, 8)) < target else (low, mid)
    for s in range(1, 8):
        assert sum(r.copies for r in got if r.doc_id < 7000 and r.size == s) == pytest.approx(1000 * min(3, exp(low * s)), abs=2)


def test_no_rows_and_no_words(spark):
    docs = spark.createDataFrame([(1, "a", ""), (None, None, None)], "doc_id long, source string, text string")
    assert sorted((r["size"], r.target, r.copies) for r in mixture(docs).collect()) == [(0, 0.0, 0), (0, 0.0, 0)]
    assert mixture(docs.where("false")).count() == 0
