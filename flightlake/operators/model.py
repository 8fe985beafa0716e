"""Training, scoring and judging the delay classifier."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.encode import apply_codes, assembler, fit_codes, small_columns
from flightlake.operators.forest import RandomForestClassifier, deal, thresholds
from flightlake.schemas import CATEGORICAL, LABEL, NUMERIC
from flightlake.session import drop_unused_shuffles, materialize

# Size and seed of the forest.
TREES = 100
DEPTH = 12
SEED = 42

# Bins per feature, as Spark's default.
BINS = 32

# Rows in a piece of the training set.  Bagging draws per piece, so pieces must
# depend on the rows alone, not on the cores.  A piece shuffles counts of every
# node and bin that its rows reach.
PIECE_ROWS = 500_000

# Trees grown at a time: at least the first, more while rows times trees stay below
# the second.  While a level grows, the counts of all its nodes are on disk.
GROUP_TREES = 5
GROUP_CELLS = 800_000_000
_SEED_STEP = 1_000_003

VECTOR = "Features_vec"
SCORING_COLUMNS = [VECTOR, "rawPrediction", "probability", "indices", "values"]


class Votes(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The class with the most votes of several forests together, the smaller one of equals.

    The votes are dropped.
    """

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str | None = None):
        super().__init__()
        self._setDefault(outputCol="prediction")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        votes = [vector_to_array(c) for c in self.getInputCols()]
        together = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), votes)
        best = F.array_max(F.transform(together, lambda v, i: F.struct(v.alias("votes"), (-i).alias("place"))))
        return dataset.withColumn(self.getOutputCol(), (-best["place"]).cast("double")).drop(*self.getInputCols())


class DelayModel:
    """A vocabulary table plus a fitted forest.

    Codes are continuous inputs (no nominal metadata on the vector), so the
    number of routes does not limit the tree bins.
    """

    def __init__(self, codes: DataFrame, forest: PipelineModel):
        self.codes, self.forest = codes, forest
        # Measured once, not per micro-batch.
        self._small = small_columns(codes)

    @property
    def forests(self) -> list[RandomForestClassificationModel]:
        """The parts of the forest, which vote together."""
        return [s for s in self.forest.stages if isinstance(s, RandomForestClassificationModel)]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add integer ``Prediction``; works on batch and streaming frames."""
        scored = self.forest.transform(apply_codes(df, self.codes, CATEGORICAL, self._small))
        # drop ignores names that are absent
        return scored.withColumn("Prediction", F.col("prediction").cast("int")).drop(
            *[f"{c}_code" for c in CATEGORICAL], *SCORING_COLUMNS
        )

    def save(self, path: str) -> None:
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        self.forest.write().overwrite().save(f"{path}/forest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DelayModel:
        codes = spark.read.schema("column string, value string, code int").parquet(f"{path}/codes")
        return cls(codes, PipelineModel.load(f"{path}/forest"))


def forest(edges: list[np.ndarray], classes: int, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(edges, classes, featuresCol=VECTOR, labelCol=LABEL, numTrees=trees, maxDepth=depth, maxBins=BINS, seed=seed)


def train(df: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> DelayModel:
    """Fit codes and forest on a training set; all passes run on the executors.

    ``df`` is read several times: give it a table.  Trees do not depend on each
    other, so they are grown in groups, which bounds what a group's shuffles take;
    the groups vote as one forest.
    """
    spark = df.sparkSession
    codes = fit_codes(df)
    n, top = df.agg(F.count(F.lit(1)), F.max(LABEL)).first()
    if not n:
        raise ValueError("no training rows")
    number = max(8, -(-n // PIECE_ROWS))
    size = max(GROUP_TREES, GROUP_CELLS // n)
    columns = [*NUMERIC, *[f"{c}_code" for c in CATEGORICAL]]
    coded = apply_codes(df, codes).select(*columns, LABEL)
    edges = thresholds(coded, columns, BINS)
    dealt = materialize(deal(coded, columns, LABEL, edges, number), "pieces")
    # Every level of every group passes over the rows, a piece in a task.
    pieces = dealt.repartitionByRange(number, "piece").persist(StorageLevel.MEMORY_AND_DISK)
    firsts = range(0, trees, size)
    fitted: list[RandomForestClassificationModel] = []
    try:
        for i, first in enumerate(firsts):
            # Bagging counts its trees on from the seed.
            group = forest(edges, max(2, int(top) + 1), min(size, trees - first), depth, seed + i * _SEED_STEP)
            if len(firsts) > 1:
                # As for the whole forest; by itself a group of one tree would take all features.
                group.setFeatureSubsetStrategy("sqrt")
                group.setRawPredictionCol(f"votes_{i}").setProbabilityCol("").setPredictionCol("")
            fitted.append(group.fit(pieces).copy())
            drop_unused_shuffles(spark)
    finally:
        pieces.unpersist()
    votes = [Votes(inputCols=[f.getRawPredictionCol() for f in fitted])] if len(fitted) > 1 else []
    return DelayModel(codes, PipelineModel([assembler(), *fitted, *votes]))


def accuracy(scored: DataFrame, label: str = LABEL, prediction: str = "Prediction") -> DataFrame:
    """Share of rows whose prediction equals the label."""
    return scored.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion_counts(scored: DataFrame, label: str = LABEL, prediction: str = "Prediction") -> DataFrame:
    """Row counts per (label, prediction)."""
    return scored.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
