import random
from itertools import product

import numpy as np
import pytest

from wayline.llm.toxicity import LETTERS, Reader, beginnings, lattice, regression, toxicity


def corpus():
    draw = random.Random(4)
    calm = ["river", "stone", "window", "garden", "market", "winter", "letter", "bridge", "idea", "motor"]
    rows, labels = [], []
    for i in range(1200):
        words = [draw.choice(calm) + draw.choice(["", "s", "ed"]) for _ in range(draw.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            words.insert(draw.randrange(len(words)), draw.choice(["idiot", "moron", "scum", "vequ" + draw.choice("abcde")]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_hidden_words(spark):
    rows, labels = corpus()
    hidden = ["you 1d10t there", "what a m o r o n today", "such sccccum", "m.o.r.o.n you", "idiooooot again", "vequxyz"]
    plain = ["river 2nd stone", "a b c d", "", None, "10.0.0.1 ### ***", "gaaarden", "\U0001f600 漢字"]
    rows += [(5000 + i, t) for i, t in enumerate(hidden)] + [(6000 + i, t) for i, t in enumerate(plain)] + [(6002, "")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, evidence double")
    told = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    got = [(r.doc_id, r.score) for r in toxicity(docs, told).collect()]
    assert len(got) == len(rows)
    truth = dict(labels)
    assert all((score >= 0.5) == truth[doc] for doc, score in got if doc in truth)
    assert {doc for doc, score in got if 5000 <= doc < 6000 and score < 0.5} == set()
    assert all(0 <= score < 0.5 for doc, score in got if doc >= 6000)


def test_labels_of_one_kind_or_none_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, toxic int")
    assert {r.score for r in toxicity(docs, labels).collect()} == {1.0}
    assert {r.score for r in toxicity(docs, labels.where("false")).collect()} == {0.0}
    assert toxicity(docs.where("false"), labels).count() == 0


@pytest.mark.parametrize("token", ["1d10t", "m00rrr0n", "$cum!", "b44d", "s.t.u.p1d"])
def test_viterbi_finds_the_best_path(token):
    draw = np.random.default_rng(1)
    model = np.log(draw.dirichlet(np.ones(LETTERS), size=(LETTERS, LETTERS)))
    reader = Reader(model)

    def score(word):
        a = b = 0
        total = 0.0
        for c in word:
            z = ord(c) - 96
            total += model[a, b, z] + reader.mean
            a, b = b, z
        return total + model[a, b, 0]

    every = {"".join(choice) for choice in product(*lattice(token))}
    assert reader.restore(token) == max(every, key=score)


def test_beginnings_and_regression():
    assert beginnings("ab") == ("ab",) and beginnings("abcdefgh") == ("abcd", "abcde", "abcdef")
    slope, offset = regression([(0.0, 900, 20), (5.0, 5, 80)])
    assert slope > 0 > offset and slope * 5 + offset > 0


def test_a_long_spaced_out_run_keeps_beginnings_only():
    reader = Reader(np.full((27, 27, 27), -3.3))
    found = reader.words(" ".join("abcdefghij"[i % 10] for i in range(100_000)))
    assert {"abcdef", "jabcde"} <= found and sorted({len(w) for w in found})[-1] == 6 and sum(map(len, found)) < 1000
