"""Counts, totals and lists behind the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.features import histogram_bin
from flightlake.operators.groups import LIST_ROWS, bounded_lists
from flightlake.operators.sizing import broadcast_if_small
from flightlake.session import materialize

FLIGHT_FIELDS = ["Carrier", "FlightDate", "FlightNum", "Origin", "Dest"]


def count_rows(df: DataFrame, name: str = "total") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def readiness(df: DataFrame) -> DataFrame:
    """Row count and whether there is any row."""
    return count_rows(df, "rows").withColumn("ready", F.col("rows") > 0)


def is_ready(df: DataFrame) -> bool:
    """Whether there is any row; reads until the first one."""
    return not df.isEmpty()


def flights_by_month(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("Year", "Month")
        .agg(F.count(F.lit(1)).alias("total_flights"))
        .orderBy("Year", "Month")
    )


def manufacturer_totals(airplanes: DataFrame) -> DataFrame:
    return airplanes.groupBy("Manufacturer").agg(F.count(F.lit(1)).alias("Total"))


def manufacturer_series(airplanes: DataFrame, max_rows: int = LIST_ROWS) -> DataFrame:
    """The totals in the nested form a chart reads, in bounded parts."""
    totals = manufacturer_totals(airplanes).withColumn("series", F.lit("Manufacturer"))
    return bounded_lists(totals, ["series"], ["Manufacturer", "Total"], "data", max_rows=max_rows, unique=True)


def flights_per_airplane(flights: DataFrame, max_rows: int = LIST_ROWS) -> DataFrame:
    """Flights of each tail number as bounded nested lists."""
    order = ["FlightDate", "FlightNum", "Carrier", "Origin", "Dest"]
    return bounded_lists(flights, ["TailNum"], FLIGHT_FIELDS, "Flights", order, max_rows)


def airplanes_per_carrier(flights: DataFrame, max_rows: int = LIST_ROWS) -> DataFrame:
    """Distinct tails of each carrier as bounded lists, with the whole fleet's size.

    Distinct pairs come first (combined on the map side) and are written, so the
    lists and the counts work on fleets, not on flights.
    """
    tails = materialize(
        flights.select("Carrier", "TailNum").filter("Carrier is not null and TailNum is not null").distinct(),
        "tails",
    )
    lists = bounded_lists(tails, ["Carrier"], ["TailNum"], "TailNumbers", max_rows=max_rows, unique=True)
    sizes = materialize(tails.groupBy("Carrier").agg(F.count(F.lit(1)).alias("FleetCount")), "fleets")
    return lists.join(broadcast_if_small(sizes), "Carrier")


def fleet_counts(flights: DataFrame) -> DataFrame:
    """Fleet size per carrier, without the lists."""
    return (
        flights.select("Carrier", "TailNum").distinct()
        .groupBy("Carrier").agg(F.count("TailNum").alias("FleetCount"))
    )


def carrier_list(flights: DataFrame) -> DataFrame:
    return flights.select("Carrier").distinct().orderBy("Carrier")


def delay_histogram(flights: DataFrame, value: str = "ArrDelay", width: float = 15.0) -> DataFrame:
    """Flights per fixed-width delay bin; unknown delays are left out."""
    return (
        flights.filter(F.col(value).isNotNull())
        .groupBy(histogram_bin(value, width).alias("label"))
        .agg(F.count(F.lit(1)).alias("value"))
    )


def chart_scale(series: DataFrame, value: str, into: str = "share") -> DataFrame:
    """Each value as a share of the series' largest, through a scalar subquery."""
    top = series.agg(F.max(value)).scalar()
    return series.withColumn(into, F.col(value) / top)


def sort_multi(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Ascending by several keys, nulls last."""
    order = [F.col(k).asc_nulls_last() if isinstance(k, str) else k for k in keys]
    return df.orderBy(*order)


def union_topics(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of two differently shaped inputs; absent fields are null."""
    return first.unionByName(second, allowMissingColumns=True)
