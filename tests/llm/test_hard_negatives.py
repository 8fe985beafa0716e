import math
import random

import numpy as np
import pytest

from flightlake.llm import hard_negatives as N


def brute(rows, k, step):
    ok = [(i, l, v) for i, l, v in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)]
    dim = max((len(v) for _, _, v in ok), default=0)
    ok = [(i, (l + 1) % 10 if i is not None and i % 7 == 0 else l, [math.floor(256 * x) for x in v] + [0] * (dim - len(v))) for i, l, v in ok]
    most = 2**63 - 1
    out = []
    for a, (anchor, label, v) in enumerate(ok):
        if anchor is None or anchor % step:
            continue
        scored = sorted(
            (-max(-most - 1, min(most, sum(x * y for x, y in zip(v, w)))), math.inf if i is None else i, l == label)
            for b, (i, l, w) in enumerate(ok) if a != b
        )
        for p, positive, _ in [s for s in scored if s[2]][:k]:
            fit = [(s, i) for s, i, same in scored if not same and 80 * -p <= 100 * -s <= 100 * -p]
            out += [(anchor, None if positive == math.inf else positive, r + 1, None if i == math.inf else i, -p, -s) for r, (s, i) in enumerate(fit[:k])]
    return sorted(out, key=str)


SCHEMA = "vec_id long, label int, embedding array<double>, score int"


def mined(spark, rows, k=5, step=100):
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in N.mine(frame, N.shifted_label(), k, step).collect()), key=str)


@pytest.mark.parametrize("k,leaf,ways,spread", [(5, 16, 3, 0.3), (2, 1024, 16, 1.0), (5, 8, 4, 2.0)])
def test_against_all_rows(spark, monkeypatch, k, leaf, ways, spread):
    monkeypatch.setattr(N, "LEAF_ROWS", leaf)
    monkeypatch.setattr(N, "WAYS", ways)
    monkeypatch.setattr(N, "SAMPLE_ROWS", 60 if leaf < 100 else 8192)
    monkeypatch.setattr(N, "ASKS_AT_ONCE", 7)
    random.seed(k)
    rows = []
    for i in range(500):
        centre = random.choice([0, 1, -1, 3])
        rows.append((i * 5, random.randint(0, 3), [random.gauss(centre, spread) for _ in range(6)]))
    rows += [(3000 + i, i % 2, [1.5] * 6) for i in range(160)]  # one vector, very often
    rows += [(100, 1, [2.0] * 6), (100, 1, [2.0] * 6), (200, 0, [0.0] * 6), (300, 1, [-1.0] * 6)]
    rows += [(400, None, [1.0] * 6), (500, 1, None), (600, 1, [1.0, None]), (700, 1, [float("nan")] * 6), (800, 2, [float("inf")] * 6), (900, 1, [1e308] * 6)]
    rows += [(None, 1, [1.9] * 6), (None, 0, [1.9] * 6), (1100, 1, []), (1200, 3, [4.0])]
    assert mined(spark, rows, k, 20) == brute(rows, k, 20)


def test_large_numbers_are_exact(spark):
    random.seed(1)
    rows = [(i, i % 3, [random.choice([1e17, -3e12, 5e5, 1e9]) + random.randint(0, 9) for _ in range(4)]) for i in range(60)]
    assert mined(spark, rows, 3, 10) == brute(rows, 3, 10)


def test_few_rows_and_none(spark):
    assert mined(spark, [(0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.9]), (2, 2, [0.8, 1.0])]) == brute([(0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.9]), (2, 2, [0.8, 1.0])], 5, 100)
    assert mined(spark, []) == [] and mined(spark, [(0, 1, [1.0])]) == []


def test_ranges_eliminate_subtrees():
    """Every row of an annulus is in a visited leaf, and far fewer leaves are visited than there are."""
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(size=(200, 3)) + c for c in ([0, 0, 0], [30, 0, 0], [0, 30, 0], [30, 30, 30])])
    tree = N.Tree(points, 4, 2)
    leaf, _ = tree.place(points)
    rows = {}
    for number in np.unique(leaf):
        for node, child in tree.path(int(number)):
            far = N.distances(points[leaf == number], tree.nodes[node].splits)
            for split in range(far.shape[1]):
                low, high = rows.get((node, child, split), (np.inf, -np.inf))
                rows[node, child, split] = min(low, far[:, split].min()), max(high, far[:, split].max())
    tree.set_ranges([{"node": n, "child": c, "split": s, "low": a, "high": b} for (n, c, s), (a, b) in rows.items()])
    queries = points[::40]
    near, far = np.full(len(queries), 1.0), np.full(len(queries), 2.5)
    visited = {}
    for number, which, _ in tree.visit(queries, near, far):
        for q in which:
            visited.setdefault(int(q), set()).add(number)
    d = N.distances(queries, points)
    for q in range(len(queries)):
        inside = set(leaf[(d[q] >= 1.0) & (d[q] <= 2.5)].tolist())
        assert inside <= visited.get(q, set())
    assert sum(map(len, visited.values())) < 0.5 * tree.leaves * len(queries)
