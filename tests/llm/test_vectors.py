import math
import random

import numpy as np
import pytest

from wayline.llm import hilbert, topk
from wayline.llm.hilbert import hilbert_keys, neighbours
from wayline.llm.topk import top_scores

BAD = [(20, None), (40, [0.0, 0.0, 0.0]), (60, [1.0, None, 0.0]), (80, [math.nan, 1.0, 1.0]), (100, [math.inf, 1.0, 1.0]), (120, []), (None, [1.0, 1.0, 1.0])]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, part string, block int")


def vectors(n, width, seed, spread=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, width))
    x = centres[draw.integers(0, 12, n)] + spread * draw.standard_normal((n, width))
    return [(i, [float(v) for v in row]) for i, row in enumerate(x.astype(np.float32))]


def brute(rows, every, k, turn):
    good = [(i, [turn(v) for v in x]) for i, x in rows if i is not None and x and all(v is not None and math.isfinite(v) for v in x)]
    out = []
    for q, a in good:
        if q % every == 0:
            scores = [(-sum(u * v for u, v in zip(a, b)), i) for i, b in good if i != q]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_hilbert_curve_steps_from_cell_to_cell():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), axis=-1).reshape(-1, n)
        keys = hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_of_few_are_exact(spark):
    rows = [*vectors(300, 3, 1), *BAD, (7, [0.5, 0.5]), (301, [0.1, 0.1, 0.1]), (301, [0.1, 0.1, 0.1])]
    rows = [r for r in rows if not (r[0] in {b[0] for b in BAD} and r[1] and r not in BAD)]
    got = sorted(map(tuple, neighbours(frame(spark, rows)).collect()))
    good = [(i, tuple(x)) for i, x in rows if x and any(x)]
    want = brute(good, 20, 20, float)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


@pytest.mark.parametrize("spread,width,most", [(0.3, 16, 0.8), (5.0, 64, 2.0)])
def test_recall_where_windows_leave_blocks_out(spark, spread, width, most, monkeypatch):
    """90 blocks a curve. Clustered vectors need few pairs; of the others a third is nearly one vector."""
    rows = vectors(9000, width, 3, spread)
    draw = np.random.default_rng(5)
    if spread > 1:
        rows[6000:] = [(i, [float(np.float32(v + 0.01 * e)) for v, e in zip(rows[0][1], draw.standard_normal(width))]) for i in range(6000, 9000)]
    reaches, measure = [], hilbert.measured_reach
    monkeypatch.setattr(hilbert, "measured_reach", lambda *args: reaches.append(measure(*args)) or reaches[-1])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    found = {}
    for r in neighbours(frame(spark, rows), block=100).collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(range(0, 9000, 20))
    hits = 0
    for q, list_ in found.items():
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len({r.vec_id for r in list_} & set(np.argsort(-scores)[:20].tolist()))
        assert len(list_) == 20
    scored = hilbert.CURVES * (2 * reaches[0] + 1) / 90
    print(f"recall {hits / (20 * len(found)):.3f}, pairs scored {scored:.2f} of a scan")
    assert hits / (20 * len(found)) >= 0.9
    assert scored < most


def test_whole_scores_are_added_up_for_listed_rows_only():
    draw = np.random.default_rng(1)
    rows, queries = draw.integers(-99, 99, (400, 8)).astype(float), draw.integers(-99, 99, (3, 8)).astype(float)
    parts, ids, asked = topk.sliced(rows, queries), np.arange(400), [(5, None), (6, None), (7, None)]
    first = topk.local_lists(ids, parts, asked, 5)
    assert all(len(hits) == 5 for hits in first)
    cutoffs = [(q, -hits[-1]["neg"]) for (q, _), hits in zip(asked, first, strict=True)]
    last = topk.above_cutoff(ids, parts, cutoffs, 5)
    for i, (q, _) in enumerate(asked):
        whole = rows @ queries[i]
        want = sorted((-int(s), j) for j, s in enumerate(whole) if j != q)[:5]
        assert [(h["neg"], h["vec_id"]) for h in last[i]] == want


def test_top_scores_are_exact(spark):
    draw = random.Random(2)
    rows = [*vectors(700, 5, 2), *BAD, (50, [0.0, 0.0, 0.0]), (900, [3e38, 1.0, -3e38]), (901, [3e38, 2.0, 1e38]), (902, [-1e-20, 0.25, -0.25])]
    rows = [r for r in rows if r[0] != 50 or r[1] == [0.0, 0.0, 0.0]]
    rows = [r for r in rows if not (r[0] in {b[0] for b in BAD} and r not in BAD)]
    draw.shuffle(rows)
    rows = [r for r in rows if r[0] not in (900, 901)]  # their scores pass a long
    got = sorted(map(tuple, top_scores(frame(spark, rows)).collect()))
    assert got == brute([(i, [float(np.float32(v)) if v is not None else v for v in x] if x else x) for i, x in rows], 50, 5, lambda v: math.floor(256 * v))


def test_few_or_no_rows(spark):
    few = frame(spark, [(0, [1.0, 0.0]), (3, [0.5, 0.5]), (2, [0.5, 0.5])])
    assert sorted(map(tuple, top_scores(few).collect())) == [(0, 1, 2, 256 * 128), (0, 2, 3, 256 * 128)]
    assert sorted(map(tuple, neighbours(few).collect())) == [(0, 1, 2, 0.5), (0, 2, 3, 0.5)]
    assert top_scores(few.where("false")).count() == 0 and neighbours(few.where("false")).count() == 0
