import math
import random

import numpy as np
import pytest

from flightlake.llm import topk


def brute(rows, k, step):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in ok), default=0)
    ok = [(i, v + [0] * (dim - len(v))) for i, v in ok]
    out = []
    for a, (i, v) in enumerate(ok):
        if i is None or i % step:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), math.inf if j is None else j) for b, (j, w) in enumerate(ok) if a != b]
        out += [(i, r + 1, None if j == math.inf else j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("k,ring", [(5, 16), (20, 4096), (3, 7)])
def test_against_all_rows(spark, monkeypatch, k, ring):
    monkeypatch.setattr(topk, "RING_ROWS", ring)
    random.seed(k)
    rows = [(i, [random.gauss(random.choice([0, 2]), 1) for _ in range(8)]) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 520)]
    rows += [(600, None), (620, []), (640, [1.0, None] + [0.0] * 6), (660, [float("nan")] * 8), (680, [float("inf")] * 8), (None, [9.0] * 8), (700, [2.0] * 3)]
    rows += [(720, [-1e6] * 8), (740, [0.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((tuple(r) for r in topk.top_k(frame, k, 20).collect()), key=str)
    assert got == brute(rows, k, 20)


def test_few_rows_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0], 1), (5, [0.3, -0.3], 2)], "vec_id long, embedding array<float>, score int")
    assert [tuple(r) for r in topk.top_k(frame).collect()] == [(0, 1, 5, 64 * 19 + 128 * -20)]
    assert topk.top_k(frame.limit(0)).count() == 0


def test_rings_are_pruned():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(size=(50, 4)) + 40, rng.normal(size=(50, 4)) - 40])
    pivots = topk.fit_pivots(points, 2)
    assert len(pivots) == 2 and topk._distances(points, pivots).min(1).max() < 10
