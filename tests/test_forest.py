"""The forest that is grown from counts per piece, beside Spark's own trees."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flightlake.operators import forest, model
from flightlake.session import materialize
from tests.conftest import rows

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(7)
    a, b, c = draw.integers(0, 12, 3000), draw.integers(0, 30, 3000), draw.integers(0, 5, 3000)
    noise = draw.random(3000) < 0.2
    label = np.where(noise, draw.integers(0, 3, 3000), (a > 5).astype(int) + (b > c * 5))
    data = [tuple(map(float, r)) for r in zip(a, b, c, label)]
    return materialize(spark.createDataFrame(data, "a double, b double, c double, label double"), "rows")


def _pieces(df, edges, number=4):
    return forest.deal(df, COLUMNS, "label", edges, number)


def _grow(df, bins=32, **params):
    edges = forest.thresholds(df, COLUMNS, bins)
    grown = forest.RandomForestClassifier(edges, 3, featuresCol="v", labelCol="label", maxBins=bins, seed=1, **params)
    return grown.fit(_pieces(df, edges))


def test_one_tree_over_all_features_is_sparks_tree(table):
    vectors = VectorAssembler(inputCols=COLUMNS, outputCol="v").transform(table)
    want = DecisionTreeClassifier(featuresCol="v", labelCol="label", maxDepth=6).fit(vectors)
    got = _grow(table, numTrees=1, maxDepth=6)
    splits = [[x.strip() for x in m.toDebugString.split("\n") if "(feature" in x or "Predict" in x] for m in (got, want)]
    assert splits[0] == splits[1]
    assert got.trees[0].numNodes == want.numNodes > 20
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray())
    shares = F.transform(vector_to_array("probability"), lambda p: F.round(p, 9))
    scored = [m.transform(vectors).select("a", "b", "c", "prediction", shares) for m in (got, want)]
    assert rows(scored[0]) == rows(scored[1])


def test_trees_differ_and_see_each_row_about_once(table):
    got = _grow(table, numTrees=8, maxDepth=5)
    assert got.getNumTrees == 8 and max(t.depth for t in got.trees) == 5 and got.numFeatures == 3 and got.numClasses == 3
    assert len({t.toDebugString.split("\n", 1)[1] for t in got.trees}) == 8
    drawn = [sum(t._call_java("rootNode").impurityStats().stats()) for t in got.trees]
    assert len(set(drawn)) > 1 and all(abs(n - 3000) < 300 for n in drawn)


def test_rows_are_drawn_by_poisson():
    share = np.bincount(forest._POISSON, minlength=9) / 65536
    want = [np.exp(-1) / np.prod(range(1, k + 1)) for k in range(9)]
    assert len(forest._POISSON) == 65536 and np.allclose(share, want, atol=3e-5)


def test_pieces_depend_on_the_rows_alone(spark, table):
    edges = forest.thresholds(table, COLUMNS, 32)
    first, second = (rows(_pieces(table.repartition(n), edges)) for n in (2, 7))
    assert first == second and sum(len(blob) for _, blob in first) == 3000 * 4
    twice = rows(_pieces(table.unionByName(table), edges))
    assert sum(len(blob) for _, blob in twice) == 2 * 3000 * 4


def test_counts_and_splits_by_hand():
    draw = np.random.default_rng(3)
    table = draw.integers(0, 4, (500, 3)).astype(np.uint8)
    table[:, 2] %= 2
    # the root is split by the first column at 1; both children are open, each with its own drawn feature
    steps = np.array([1 << 16 | 1 << 8 | 0, 1 << 16 | 255 << 8, 2 << 16 | 255 << 8])
    tree = forest.Growing(0, 1, steps, np.array([-1, 0, 1]), np.array([[1], [0]]))
    counts = forest.count_rows(table, 0, tree, 4, 2, 5, False).reshape(2, 1, 4, 2)
    for node, column in ((0, 1), (1, 0)):
        part = table[(table[:, 0] > 1) == bool(node)]
        assert [[int(((part[:, column] == b) & (part[:, 2] == c)).sum()) for c in (0, 1)] for b in range(4)] == counts[node, 0].tolist()
    best = forest.best_splits(counts, 1)

    def gini(stats):
        return 1 - ((stats / max(1, stats.sum())) ** 2).sum()

    for node in (0, 1):
        gains = []
        for b in range(3):
            left, right = counts[node, 0, : b + 1].sum(0), counts[node, 0, b + 1 :].sum(0)
            n = left.sum() + right.sum()
            gain = gini(left + right) - left.sum() / n * gini(left) - right.sum() / n * gini(right)
            gains.append(gain if left.sum() and right.sum() else -1)
        assert best[node, 1] == np.argmax(gains) and np.isclose(best[node, 2], max(gains))
        assert best[node, 5:].tolist() == counts[node, 0].sum(0).tolist()


def test_thresholds_lie_between_values_or_at_quantiles(spark):
    few = spark.createDataFrame([(float(v), float("nan") if v else None, 1.0) for v in (0, 0, 1, 3)], "a double, b double, c double")
    assert [e.tolist() for e in forest.thresholds(few, COLUMNS, 32)] == [[0.5, 2.0], [], []]
    many = spark.range(10_000).select(F.sqrt("id").alias("a"), (F.col("id") % 100 * (F.col("id") % 2)).cast("double").alias("b"), F.lit(0.0).alias("c"))
    a, b, c = forest.thresholds(many, COLUMNS, 32)
    assert len(a) == 31 and np.allclose(a**2, np.arange(1, 32) * 10_000 / 32, atol=40)
    # half of all rows hold the least value
    assert 10 <= len(b) <= 31 and b[0] < 2 and (np.diff(b) > 0).all() and len(c) == 0


def test_a_pass_serves_many_trees_of_many_rows():
    """Over 28 million rows all trees are grown in few groups, each of which passes over the rows once a level."""
    assert -(-model.TREES // max(model.GROUP_TREES, model.GROUP_CELLS // 28_000_000)) <= 4


def test_no_training_rows(spark):
    empty = spark.createDataFrame([], "Carrier string, Origin string, Dest string, Route string, DepDelay double, Distance double, DayOfMonth int, DayOfWeek int, DayOfYear int, ArrDelayBucket int")
    with pytest.raises(ValueError, match="no training rows"):
        model.train(empty)
