"""Queries of the joins, aggregates and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightlake.functions import features
from flightlake.functions.messages import emit_json
from flightlake.operators import aggregates, joins, training
from flightlake.operators.latest import store_predictions
from flightlake.plans import views
from flightlake.plans.catalog import query
from flightlake.session import materialize, scratch_dir
from flightlake.sources import writers
from flightlake.streaming.jobs import MESSAGE_COLUMNS

ROUTE_BUCKETS = 16
ROUTE_COLUMNS = ("FlightNum", "TailNum", "FlightDate", "Origin", "Dest")


def known_distances(spark, sf, where: str | None = None):
    """Route table as the ingest leaves it: written once, then read."""
    routes = views.distances(spark, sf)
    return materialize(routes.filter(where) if where else routes, "distances")


@query(
    "distance_lookup",
    """SELECT f."FlightNum", f."TailNum", f."FlightDate", f."Origin", f."Dest", d."Distance"
       FROM flights f LEFT JOIN distances d ON f."Origin" = d."Origin" AND f."Dest" = d."Dest" """,
    "flights", "distances",
)
def _(spark, sf):
    return joins.distance_lookup(views.flights(spark, sf, *ROUTE_COLUMNS), known_distances(spark, sf))


@query(
    "distance_lookup_bucketed",
    """SELECT f."FlightNum", f."TailNum", f."FlightDate", f."Origin", f."Dest", d."Distance"
       FROM flights f LEFT JOIN distances d ON f."Origin" = d."Origin" AND f."Dest" = d."Dest" """,
    "flights", "distances",
)
def _(spark, sf):
    """Both sides stored in buckets of the route: joined without a shuffle, whatever their sizes."""
    sides = []
    for name, rows in (("flights", views.flights(spark, sf, *ROUTE_COLUMNS)), ("routes", views.distances(spark, sf))):
        path = scratch_dir(spark, name)
        sides.append(writers.write_bucketed(rows, joins.ROUTE, ROUTE_BUCKETS, f"{name}_{path[-32:]}", path))
    return sides[0].join(sides[1], joins.ROUTE, "left").select(*ROUTE_COLUMNS, "Distance")


# Routes between names of equal length are unknown in the next two.
_PARTIAL = "length(Origin) <> length(Dest)"


@query(
    "distance_missing",
    """SELECT "Origin", "Dest", CAST(count(*) AS BIGINT) AS n FROM flights
       WHERE "Dest" IS NULL OR length("Origin") = length("Dest") GROUP BY "Origin", "Dest" """,
    "flights",
)
def _(spark, sf):
    rows = views.flights(spark, sf, "Origin", "Dest")
    missing = joins.distance_missing(rows, known_distances(spark, sf, _PARTIAL))
    return missing.groupBy("Origin", "Dest").agg(F.count(F.lit(1)).alias("n"))


@query(
    "distance_strict",
    """SELECT "Origin", "Dest", "Distance", CAST(count(*) AS BIGINT) AS n FROM flights
       WHERE "Dest" IS NOT NULL GROUP BY "Origin", "Dest", "Distance" """,
    "flights",
)
def _(spark, sf):
    rows = views.flights(spark, sf, "Origin", "Dest").filter("Dest is not null")
    found = joins.distance_strict(rows, known_distances(spark, sf))
    return found.groupBy("Origin", "Dest", "Distance").agg(F.count(F.lit(1)).alias("n"))


@query(
    "airline_profile",
    """SELECT a."CarrierCode", a."Name", a."url", a."domain", a."logo_url", a."summary", f."FleetCount"
       FROM airlines a LEFT JOIN (SELECT "Carrier", CAST(count(DISTINCT "TailNum") AS BIGINT) AS "FleetCount"
       FROM flights GROUP BY "Carrier") f ON a."CarrierCode" = f."Carrier" """,
    "flights", "airlines",
)
def _(spark, sf):
    fleets = aggregates.fleet_counts(views.flights(spark, sf, "Carrier", "TailNum"))
    return joins.airline_profile(views.airlines(spark, sf), fleets)


_LATEST = """SELECT "UUID", max_by("Prediction", "Offset") AS {name} FROM {view} GROUP BY "UUID" """


@query(
    "dual_engine_match",
    f"""SELECT coalesce(a."UUID", b."UUID") AS "UUID", a.first_prediction, b.second_prediction
        FROM ({_LATEST.format(name="first_prediction", view="predictions_a")}) a
        FULL JOIN ({_LATEST.format(name="second_prediction", view="predictions_b")}) b ON a."UUID" = b."UUID" """,
    "predictions_a", "predictions_b",
)
def dual_engine_match(spark, sf):
    return joins.engine_match(
        views.predictions_a(spark, sf), views.predictions_b(spark, sf), ["Offset"]
    )


@query(
    "request_status",
    f"""SELECT a."UUID" AS id, CASE WHEN b.second IS NULL THEN NULL ELSE CAST(CAST(b.second AS BIGINT) AS VARCHAR) || '.0' END AS prediction,
        CASE WHEN b.second IS NULL THEN 'WAIT' ELSE 'OK' END AS status
        FROM (SELECT DISTINCT "UUID" FROM predictions_a) a
        LEFT JOIN ({_LATEST.format(name="second", view="predictions_b")}) b ON a."UUID" = b."UUID" """,
    "predictions_a", "predictions_b",
)
def _(spark, sf):
    stored = store_predictions(emit_json(views.predictions_b(spark, sf), MESSAGE_COLUMNS, "Offset"), ["Offset"])
    asked = views.predictions_a(spark, sf).select("UUID").distinct()
    return joins.request_status(asked, stored)


@query("count_rows", "SELECT CAST(count(*) AS BIGINT) AS total FROM training", "training")
def _(spark, sf):
    columns = ["Carrier", "Origin", "Dest", "DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "DayOfYear", "ArrDelay"]
    return aggregates.count_rows(training.training_set(views.flights(spark, sf, *columns)))


@query(
    "readiness_gate",
    """SELECT CAST(count(*) AS BIGINT) AS "rows", count(*) > 0 AS ready FROM distances""",
    "distances",
)
def _(spark, sf):
    return aggregates.readiness(views.distances(spark, sf))


@query(
    "flights_by_month",
    """SELECT "Year", "Month", CAST(count(*) AS BIGINT) AS total_flights FROM flights GROUP BY "Year", "Month" """,
    "flights",
)
def flights_by_month(spark, sf):
    return aggregates.flights_by_month(views.flights(spark, sf, "Year", "Month"))


@query(
    "delay_classes_by_month",
    """SELECT "Year", "Month", CASE WHEN "ArrDelay" < -15 THEN 0 WHEN "ArrDelay" < 0 THEN 1 WHEN "ArrDelay" < 30 THEN 2 ELSE 3 END
         AS "ArrDelayBucket", CAST(count(*) AS BIGINT) AS total_flights, sum("Distance") AS miles
       FROM flights WHERE "Dest" IS NOT NULL GROUP BY ALL""",
    "flights",
)
def delay_classes_by_month(spark, sf):
    """Flights and miles per month and delay class; distances from the route table."""
    rows = views.flights(spark, sf, "Year", "Month", "Origin", "Dest", "ArrDelay")
    routed = joins.distance_lookup(rows.filter("Dest is not null"), known_distances(spark, sf))
    return (
        routed.withColumn("ArrDelayBucket", features.delay_class())
        .groupBy("Year", "Month", "ArrDelayBucket")
        .agg(F.count(F.lit(1)).alias("total_flights"), F.sum("Distance").alias("miles"))
    )


@query(
    "manufacturer_totals",
    """SELECT "Manufacturer", CAST(count(*) AS BIGINT) AS "Total" FROM airplanes GROUP BY "Manufacturer" """,
    "airplanes",
)
def _(spark, sf):
    return aggregates.manufacturer_totals(views.airplanes(spark, sf))


@query(
    "manufacturer_series",
    """WITH t AS (SELECT "Manufacturer", CAST(count(*) AS BIGINT) AS "Total" FROM airplanes GROUP BY "Manufacturer"),
       r AS (SELECT *, row_number() OVER (ORDER BY "Manufacturer") - 1 AS k, count(*) OVER () AS n FROM t)
       SELECT 'Manufacturer' AS series, CAST(k // 10000 AS BIGINT) AS "Part", CAST(k % 10000 AS INTEGER) AS at,
         CAST(least(n - k // 10000 * 10000, 10000) AS INTEGER) AS n, "Manufacturer", "Total" FROM r""",
    "airplanes",
)
def _(spark, sf):
    nested = aggregates.manufacturer_series(views.airplanes(spark, sf))
    items = nested.select("series", "Part", F.size("data").alias("n"), F.posexplode("data").alias("at", "d"))
    return items.select("series", "Part", "at", "n", "d.*")


# Parts hold at most 10,000 flights of their own tail number, counted from its first.
_PER_AIRPLANE = """WITH r AS (SELECT "TailNum", "Carrier", "FlightDate", "FlightNum", "Origin", "Dest",
    row_number() OVER (PARTITION BY "TailNum" ORDER BY "FlightDate", "FlightNum", "Carrier", "Origin", "Dest" NULLS LAST) - 1 AS k,
    count(*) OVER (PARTITION BY "TailNum") AS n FROM flights)
  SELECT "TailNum", CAST(k // 10000 AS BIGINT) AS "Part", CAST(k % 10000 AS INTEGER) AS at,
    CAST(least(n - k // 10000 * 10000, 10000) AS INTEGER) AS n, "Carrier", "FlightDate", "FlightNum", "Origin", "Dest" FROM r"""


@query("flights_per_airplane", _PER_AIRPLANE, "flights")
def flights_per_airplane(spark, sf):
    rows = views.flights(spark, sf, "TailNum", *aggregates.FLIGHT_FIELDS)
    nested = aggregates.flights_per_airplane(rows)
    items = nested.select("TailNum", "Part", F.size("Flights").alias("n"), F.posexplode("Flights").alias("at", "f"))
    return items.select("TailNum", "Part", "at", "n", "f.*")


@query(
    "airplanes_per_carrier",
    """SELECT "Carrier", "TailNum", CAST(k // 10000 AS BIGINT) AS "Part", CAST(k % 10000 AS INTEGER) AS at,
         CAST(least(n - k // 10000 * 10000, 10000) AS INTEGER) AS n, n AS "FleetCount" FROM
         (SELECT *, row_number() OVER (PARTITION BY "Carrier" ORDER BY "TailNum") - 1 AS k, count(*) OVER (PARTITION BY "Carrier") AS n
          FROM (SELECT DISTINCT "Carrier", "TailNum" FROM flights))""",
    "flights",
)
def _(spark, sf):
    nested = aggregates.airplanes_per_carrier(views.flights(spark, sf, "Carrier", "TailNum"))
    items = F.posexplode("TailNumbers").alias("at", "TailNum")
    return nested.select("Carrier", "Part", F.size("TailNumbers").alias("n"), items, "FleetCount")


@query("carrier_list", """SELECT DISTINCT "Carrier" FROM flights""", "flights")
def _(spark, sf):
    return aggregates.carrier_list(views.flights(spark, sf, "Carrier"))


@query(
    "delay_histogram",
    """SELECT floor("ArrDelay" / 15) * 15 AS label, CAST(count(*) AS BIGINT) AS "value" FROM flights
       WHERE "ArrDelay" IS NOT NULL GROUP BY 1""",
    "flights",
)
def _(spark, sf):
    return aggregates.delay_histogram(views.flights(spark, sf, "ArrDelay"))


@query(
    "chart_scale",
    """WITH m AS (SELECT "Year", "Month", CAST(count(*) AS BIGINT) AS total_flights FROM flights GROUP BY "Year", "Month")
       SELECT "Year", "Month", total_flights, total_flights / (SELECT max(total_flights) FROM m) AS share FROM m""",
    "flights",
)
def _(spark, sf):
    return aggregates.chart_scale(
        aggregates.flights_by_month(views.flights(spark, sf, "Year", "Month")), "total_flights"
    )


@query(
    "sort_multi",
    """SELECT "FlightDate", "DepTime", "Carrier", "FlightNum" FROM flights
       ORDER BY "FlightDate", "DepTime", "Carrier", "FlightNum" """,
    "flights",
)
def _(spark, sf):
    keys = ["FlightDate", "DepTime", "Carrier", "FlightNum"]
    return aggregates.sort_multi(views.flights(spark, sf, *keys), *keys)


@query(
    "union_topics",
    """SELECT "UUID", "Carrier", "DepDelay", "Distance", CAST(NULL AS DOUBLE) AS "Prediction" FROM requests
       UNION ALL SELECT "UUID", "Carrier", "DepDelay", NULL, "Prediction" FROM predictions_a""",
    "requests", "predictions_a",
)
def _(spark, sf):
    asked = views.requests(spark, sf).select("UUID", "Carrier", "DepDelay", "Distance")
    answered = views.predictions_a(spark, sf).select("UUID", "Carrier", "DepDelay", "Prediction")
    return aggregates.union_topics(asked, answered)
