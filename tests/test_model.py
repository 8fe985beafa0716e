"""Training and scoring."""

import os

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.operators import model, training
from flightlake.plans import views
from flightlake.plans.queries_model import TRAINING_INPUT, fitted
from flightlake.session import materialize
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    return fitted(spark, SF)


def test_scores_are_classes(trained):
    scored = trained[0].transform(trained[1])
    assert {r[0] for r in scored.select("Prediction").distinct().collect()} <= {0, 1, 2, 3}
    assert scored.schema["Prediction"].dataType.simpleString() == "int"
    assert not set(scored.columns) & {"Features_vec", "probability", "rawPrediction", "Carrier_code"}


def test_better_than_the_majority_class(trained):
    scored = trained[0].transform(trained[1])
    counts = trained[1].groupBy("ArrDelayBucket").count().agg(F.max("count") / F.sum("count")).first()[0]
    assert model.accuracy(scored).first().accuracy > counts


def test_saved_model_scores_alike(spark, trained, tmp_path):
    trained[0].save(str(tmp_path / "m"))
    loaded = model.DelayModel.load(spark, str(tmp_path / "m"))
    assert rows(loaded.transform(trained[1])) == rows(trained[0].transform(trained[1]))


def test_same_seed_same_model(spark):
    data = materialize(training.training_set(views.flights(spark, SF, *TRAINING_INPUT)), "training")
    first, second = (model.train(data, trees=3, depth=4) for _ in range(2))
    # the first line holds a random name
    trees = [m.forest.stages[-1].toDebugString.split("\n", 1)[1] for m in (first, second)]
    assert trees[0] == trees[1]


def test_unseen_category_is_scored(spark, trained):
    row = trained[1].limit(1).withColumn("Carrier", F.lit("ZZ")).withColumn("Route", F.lit("ZZ-ZZ"))
    assert trained[0].transform(row).count() == 1


def test_confusion_and_accuracy(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (2, 2)], "ArrDelayBucket int, Prediction int")
    assert model.accuracy(df).first().accuracy == 0.75
    assert rows(model.confusion_counts(df)) == [(0, 0, 1), (1, 0, 1), (1, 1, 1), (2, 2, 1)]


def test_default_size():
    assert (model.TREES, model.DEPTH, model.SEED) == (100, 12, 42)
    assert schemas.FEATURES == ["Carrier", "Origin", "Dest", "Route", "DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "DayOfYear"]


def test_trees_are_grown_in_groups_and_vote_together(spark, tmp_path, monkeypatch):
    """What a row holds and a group's shuffles must not grow with the number of trees."""
    grown = []
    plain = model.RandomForestClassifier.fit

    def fit(self, dataset, *args):
        grown.append((self.getNumTrees(), self.getSeed(), self.getCacheNodeIds()))
        return plain(self, dataset, *args)

    monkeypatch.setattr(model.RandomForestClassifier, "fit", fit)
    monkeypatch.setattr(model, "GROUP_CELLS", 0)
    data = materialize(training.training_set(views.flights(spark, SF, *TRAINING_INPUT)), "training")
    fitted_model = model.train(data, trees=12, depth=4)
    assert [n for n, _, _ in grown] == [5, 5, 2]
    assert len({seed for _, seed, _ in grown}) == 3 and not any(ids for _, _, ids in grown)

    votes = model.apply_codes(data, fitted_model.codes)
    for stage in fitted_model.forest.stages[:-1]:
        votes = stage.transform(votes)
    together, expected = 0, {}
    names = [f.getRawPredictionCol() for f in fitted_model.forests]
    for r in votes.select(*schemas.FEATURES, *names).collect():
        sums = [sum(v) for v in zip(*[r[n] for n in names])]
        expected[tuple(r[c] for c in schemas.FEATURES)] = sums
    for r in fitted_model.transform(data).collect():
        sums = expected[tuple(r[c] for c in schemas.FEATURES)]
        together += sums.index(max(sums)) == r["Prediction"]
    assert together == data.count()

    fitted_model.save(str(tmp_path / "m"))
    loaded = model.DelayModel.load(spark, str(tmp_path / "m"))
    assert [f.getNumTrees for f in loaded.forests] == [5, 5, 2]
    assert rows(loaded.transform(data)) == rows(fitted_model.transform(data))


def test_equal_votes_name_the_smaller_class(spark):
    pair = spark.createDataFrame([(1, Vectors.dense(1, 2, 0), Vectors.dense(1, 0, 2)), (2, Vectors.dense(0, 1, 3), Vectors.dense(0, 1, 0))], ["id", "a", "b"])
    assert rows(model.Votes(inputCols=["a", "b"]).transform(pair)) == [(1, 0.0), (2, 2.0)]


def _shuffle_files(spark):
    """Files that the executors hold for shuffles, in the folders of a local master."""
    folders = [str(f) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    held = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()
    written = materialize(held, "counts")
    assert not _shuffle_files(spark) - before
    assert rows(written) == rows(held)


def test_a_model_keeps_no_training_rows(spark):
    data = materialize(training.training_set(views.flights(spark, SF, *TRAINING_INPUT)), "training")
    trained_model = model.train(data, trees=2, depth=3)
    assert not any(f.hasSummary for f in trained_model.forests)


def test_narrow_line_items_meet_the_orders_first(spark):
    """The joins that add names come after the one that shuffles all line items."""
    plan = views.flights(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    depth = {t: next(len(l) - len(l.lstrip(" :+-")) for l in plan.splitlines() if f"{t}#" in l and "Relation" in l) for t in ("o_orderkey", "p_partkey", "s_suppkey")}
    assert depth["o_orderkey"] > max(depth["p_partkey"], depth["s_suppkey"])
