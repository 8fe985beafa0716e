"""The model registry as ordinary tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.sizing import broadcast_if_small
from flightlake.schemas import FEATURES, MODEL_REF, RUN
from flightlake.session import materialize

# Stage names, in the order a version passes through them.
STAGES = ["None", "Staging", "Production", "Archived"]
OPEN_STAGES = ["None", "Staging"]
RUNS_READ = 10
RUNS_SHOWN = 5
RUN_ID_CHARS = 8


def run_row(spark: SparkSession, run_id: str, accuracy: float, params: dict[str, str]) -> DataFrame:
    """One training run as a row to append to the runs table."""
    return spark.createDataFrame([(run_id, params, FEATURES, float(accuracy))], RUN)


def model_ref_row(spark: SparkSession, name: str, path: str, accuracy: float, run_id: str) -> DataFrame:
    """Reference to a saved model, stamped now."""
    trained_at = datetime.now(timezone.utc).isoformat()
    return spark.createDataFrame([(name, path, trained_at, float(accuracy), run_id)], MODEL_REF)


def promote(versions: DataFrame) -> DataFrame:
    """Newest open version of each model goes to Production, the previous ones to Archived.

    A model without an open version is left alone.  The per-model maximum is
    combined on the map side before it is joined back.
    """
    newest = (
        versions.filter(F.col("stage").isin(OPEN_STAGES))
        .groupBy("name")
        .agg(F.max("version").alias("_chosen"))
    )
    # One row per model, written and measured, so the versions are not shuffled.
    newest = broadcast_if_small(materialize(newest, "newest"))
    joined = versions.join(newest, "name", "left")
    stage = (
        F.when(F.col("version") == F.col("_chosen"), F.lit("Production"))
        .when(
            (F.col("stage") == "Production") & F.col("_chosen").isNotNull(), F.lit("Archived")
        )
        .otherwise(F.col("stage"))
    )
    return joined.withColumn("stage", stage).select(*versions.columns)


def production(versions: DataFrame) -> DataFrame:
    """Newest Production version of each model."""
    rest = [c for c in versions.columns if c != "name"]
    return (
        versions.filter(F.col("stage") == "Production")
        .groupBy("name")
        .agg(F.max_by(F.struct(*rest), "version").alias("_row"))
        .select("name", "_row.*")
        .select(*versions.columns)
    )


def production_of(versions: DataFrame, name: str) -> DataFrame:
    """The Production version of one model; an error when there is none."""
    found = production(versions.filter(F.col("name") == name))
    if found.isEmpty():
        raise LookupError(f"no Production version of {name}")
    return found


def runs_report(runs: DataFrame) -> DataFrame:
    """The newest runs, few of them shown, ids shortened."""
    return (
        runs.orderBy(F.col("trained_at").desc(), "run_id")
        .limit(RUNS_READ)
        .orderBy(F.col("trained_at").desc(), "run_id")
        .limit(RUNS_SHOWN)
        .select(F.substring("run_id", 1, RUN_ID_CHARS).alias("run"), "accuracy")
    )


def latest_ref(refs: DataFrame, name: str) -> DataFrame:
    """Newest reference of a model name (top-1, nothing is sorted whole)."""
    return (
        refs.filter(F.col("model_name") == name)
        .orderBy(F.col("trained_at").desc(), F.col("run_id").desc())
        .limit(1)
    )


def require_latest_ref(refs: DataFrame, name: str):
    """The row of :func:`latest_ref`; an error when the model was never trained."""
    row = latest_ref(refs, name).first()
    if row is None:
        raise LookupError(f"no trained model called {name}")
    return row
