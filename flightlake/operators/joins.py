"""Equi-joins of the serving and scoring paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.operators.latest import latest_per_key
from flightlake.operators.sizing import broadcast_if_small

ROUTE = ["Origin", "Dest"]


def distance_lookup(rows: DataFrame, distances: DataFrame) -> DataFrame:
    """Add the route's ``Distance``; null when the route is unknown."""
    return rows.join(broadcast_if_small(distances), ROUTE, "left")


def distance_missing(rows: DataFrame, distances: DataFrame) -> DataFrame:
    """Rows whose route has no distance: the report of failed lookups."""
    return rows.join(broadcast_if_small(distances.select(*ROUTE)), ROUTE, "left_anti")


def distance_strict(rows: DataFrame, distances: DataFrame) -> DataFrame:
    """Like :func:`distance_lookup`, but an unknown route fails the job."""
    found = distance_lookup(rows, distances)
    message = F.concat(F.lit("no distance for route "), F.concat_ws("-", *ROUTE))
    return found.withColumn(
        "Distance", F.coalesce(F.col("Distance"), F.raise_error(message).cast("double"))
    )


def airline_profile(airlines: DataFrame, fleets: DataFrame) -> DataFrame:
    """Airline summary beside its fleet; airlines without a fleet stay."""
    return airlines.join(
        fleets.withColumnRenamed("Carrier", "CarrierCode"), "CarrierCode", "left"
    )


def engine_match(first: DataFrame, second: DataFrame, order: list[str]) -> DataFrame:
    """Predictions of two engines side by side, last write per id on each side."""
    a = latest_per_key(first, ["UUID"], order).select("UUID", F.col("Prediction").alias("first_prediction"))
    b = latest_per_key(second, ["UUID"], order).select("UUID", F.col("Prediction").alias("second_prediction"))
    return a.join(b, "UUID", "full_outer")


def request_status(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """``OK`` with the stored prediction, or ``WAIT``."""
    rows = stored.select(F.col("uuid").alias("id"), F.col("prediction"))
    return (
        requests.select(F.col("UUID").alias("id"))
        .join(rows, "id", "left")
        .withColumn("status", F.when(F.col("prediction").isNull(), "WAIT").otherwise("OK"))
    )
