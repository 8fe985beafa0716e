"""The batch jobs end to end, for spark-submit or a scheduler to call."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.functions import messages
from flightlake.operators import aggregates, latest, model, registry, tables, training
from flightlake.session import configure, get_session, materialize
from flightlake.sources import readers, writers
from flightlake.streaming import jobs

# Names under which models are kept.
MODEL_NAME = "delay_forest"
REGISTERED_NAME = "delay_model"


def load_flights(spark: SparkSession, source: str, table: str) -> int:
    """Feature lines to the flight table; the rows are counted as they are written."""
    counted = Observation("flights")
    rows = readers.read_jsonl(spark, source).observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(table)
    return counted.get["rows"]


def load_distances(spark: SparkSession, source: str, table: str) -> DataFrame:
    """Route lines to the keyed distance table; the last line of a route counts."""
    lines = tables.numbered_lines(spark, source)
    paths = {"Origin": "$.Origin", "Dest": "$.Dest", "Distance": "$.Distance"}
    found = lines.select(
        "line_no", *[F.get_json_object("value", path).alias(name) for name, path in paths.items()]
    ).na.drop("any")
    typed = found.withColumn("Distance", F.col("Distance").try_cast("double")).na.drop("any")
    routes = latest.latest_per_key(typed, ["Origin", "Dest"], ["line_no"]).drop("line_no")
    return writers.write_indexed(routes, ["Origin", "Dest"], table)


def train_and_register(
    spark: SparkSession, flights: DataFrame, root: str, trees: int = model.TREES, depth: int = model.DEPTH
) -> dict[str, object]:
    """Train on 80 % of the flights, judge on the rest, save, log and promote.

    Tables under ``root``: runs, models (references) and versions.
    """
    rows = materialize(training.training_set(flights), "training")
    train, test = training.split_by_key(rows, [*schemas.FEATURES, schemas.LABEL])
    fitted = model.train(train, trees, depth)
    accuracy = model.accuracy(fitted.transform(test)).first().accuracy
    run_id = uuid.uuid4().hex
    path = f"{root}/saved/{run_id}"
    fitted.save(path)

    params = {"n_estimators": str(trees), "max_depth": str(depth)}
    writers.append_rows(registry.run_row(spark, run_id, accuracy, params), f"{root}/runs")
    writers.append_rows(registry.model_ref_row(spark, MODEL_NAME, path, accuracy, run_id), f"{root}/models")
    version = register_version(spark, f"{root}/versions", REGISTERED_NAME, run_id)
    return {"run_id": run_id, "accuracy": accuracy, "path": path, "version": version}


def register_version(spark: SparkSession, table: str, name: str, run_id: str) -> int:
    """Add the next version of a model and make it the Production one."""
    versions = tables.existing(spark, table)
    last = versions.filter(F.col("name") == name).agg(F.max("version")).first()[0] if versions else None
    number = (last or 0) + 1
    added = spark.createDataFrame([(name, number, "None", run_id)], schemas.VERSION)
    every = versions.unionByName(added) if versions else added
    # Written elsewhere first: the table being replaced is also the one read.
    writers.replace_table(materialize(registry.promote(every), "versions"), table)
    return number


def load_model(spark: SparkSession, root: str) -> model.DelayModel:
    """The newest trained model; an error when there is none."""
    refs = tables.existing(spark, f"{root}/models")
    if refs is None:
        raise LookupError("no model was trained yet")
    return model.DelayModel.load(spark, registry.require_latest_ref(refs, MODEL_NAME).model_path)


def build_reports(flights: DataFrame, airplanes: DataFrame, root: str) -> None:
    """The report tables the serving queries read."""
    reports = {
        "flights_by_month": aggregates.flights_by_month(flights),
        "manufacturer_totals": aggregates.manufacturer_totals(airplanes),
        "airplanes_per_carrier": aggregates.airplanes_per_carrier(flights),
        "flights_per_airplane": aggregates.flights_per_airplane(flights),
    }
    for name, report in reports.items():
        report.write.mode("overwrite").parquet(f"{root}/{name}")


def score_topic(spark: SparkSession, requests: str, answers: str, root: str, checkpoint: str, trigger: jobs.Trigger = jobs.DRAIN):
    """Answer a request topic with the newest model."""
    answered = jobs.score_lines(readers.read_topic(spark, requests), load_model(spark, root))
    return jobs.start_files(answered, answers, checkpoint, trigger=trigger)


def score_batch(requests: DataFrame, fitted: model.DelayModel) -> DataFrame:
    """Request lines of a batch, answered the same way."""
    return jobs.score_lines(messages.value_to_string(requests), fitted)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)
    for step, arguments in {
        "load": ["source", "table"],
        "distances": ["source", "table"],
        "train": ["table", "root"],
        "score": ["requests", "answers", "root", "checkpoint"],
    }.items():
        sub = steps.add_parser(step)
        for argument in arguments:
            sub.add_argument(argument)
    given = parser.parse_args()
    spark = configure(get_session(f"flightlake {given.step}"))
    if given.step == "load":
        print(load_flights(spark, given.source, given.table), "rows")
    elif given.step == "distances":
        print(load_distances(spark, given.source, given.table).count(), "routes")
    elif given.step == "train":
        print(train_and_register(spark, spark.read.schema(schemas.TRAINING).parquet(given.table), given.root))
    else:
        jobs.drain(score_topic(spark, given.requests, given.answers, given.root, given.checkpoint))


if __name__ == "__main__":
    main()
