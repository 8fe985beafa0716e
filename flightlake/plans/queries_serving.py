"""Queries of the serving operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightlake.operators import serving
from flightlake.operators.order_index import OrderIndex
from flightlake.plans import views
from flightlake.plans.catalog import query
from flightlake.session import materialize, scratch_dir

FLIGHT = ("FlightNum", "Carrier", "TailNum", "Origin", "Dest", "FlightDate", "DepTime", "ArrTime", "AirTime", "Distance")
_FLIGHT = ", ".join(f'"{c}"' for c in FLIGHT)
_REST = ", ".join(
    f'"{c}" NULLS LAST' for c in ("TailNum", "Origin", "Dest", "ArrTime", "AirTime", "Distance")
)


@query(
    "flight_lookup",
    f"""SELECT {_FLIGHT} FROM flights WHERE ("FlightDate", "Carrier", "FlightNum") =
          (SELECT ("FlightDate", "Carrier", "FlightNum") FROM flights ORDER BY "FlightDate" DESC, "Carrier", "FlightNum" LIMIT 1)
        ORDER BY {_FLIGHT} LIMIT 1""",
    "flights",
)
def _(spark, sf):
    # The key looked up is that of the newest flight in the tables.
    keys = views.flights(spark, sf, "FlightDate", "Carrier", "FlightNum")
    date, carrier, number = keys.orderBy(F.col("FlightDate").desc(), "Carrier", "FlightNum").first()
    return serving.flight_lookup(views.flights(spark, sf, *FLIGHT), carrier, date, number)


@query(
    "list_flights",
    f"""SELECT {_FLIGHT}, CAST(count(*) OVER () AS BIGINT) AS flight_count FROM flights
        WHERE "Origin" = 'NATION_11' AND "Dest" = 'NATION_13' AND "FlightDate" = '1995-02-16' ORDER BY "DepTime", "ArrTime" """,
    "flights",
)
def _(spark, sf):
    return serving.list_flights(views.flights(spark, sf, *FLIGHT), "NATION_11", "NATION_13", "1995-02-16")


_SEARCH = {"Carrier": "brand#4", "Origin": "nation_11", "Dest": "", "FlightNum": None}
_SEARCH_WHERE = """lower("Carrier") = 'brand#4' AND lower("Origin") = 'nation_11'"""


@query(
    "flight_search",
    f"""SELECT {_FLIGHT} FROM flights WHERE {_SEARCH_WHERE}
        ORDER BY "FlightDate", "DepTime", "Carrier", "FlightNum", {_REST} LIMIT 15 OFFSET 15""",
    "flights",
)
def flight_search(spark, sf):
    return serving.flight_search(views.flights(spark, sf, *FLIGHT), _SEARCH, start=15)


@query(
    "flight_search_deep",
    f"""SELECT {_FLIGHT} FROM flights ORDER BY "FlightDate", "DepTime", "Carrier", "FlightNum", {_REST} LIMIT 15 OFFSET 30000""",
    "flights",
)
def _(spark, sf):
    # a page reads the flights several times: a table, not the joins behind the view
    return serving.flight_search(materialize(views.flights(spark, sf, *FLIGHT), "flights"), {}, start=30_000)


_BY_TIME = f"""ORDER BY "FlightDate", "DepTime", "Carrier", "FlightNum", {_REST}"""


@query(
    "flight_search_indexed",
    f"""SELECT 'all' AS asked, CAST((SELECT count(*) FROM flights) AS BIGINT) AS total, * FROM (SELECT {_FLIGHT} FROM flights {_BY_TIME} LIMIT 15 OFFSET 5000)
        UNION ALL SELECT 'some', CAST((SELECT count(*) FROM flights WHERE "Origin" = 'NATION_11') AS BIGINT), * FROM
          (SELECT {_FLIGHT} FROM flights WHERE lower("Origin") = 'nation_11' {_BY_TIME} LIMIT 15 OFFSET 150)""",
    "flights",
)
def _(spark, sf):
    """A deep page and a page of matches from a stored order."""
    index = OrderIndex.build(views.flights(spark, sf, *FLIGHT), serving.FLIGHT_ORDER, scratch_dir(spark, "flight_index"))
    some, total = index.search(serving.matching(index.rows, {"Origin": "nation_11"}, serving.FLIGHT_SEARCH_FIELDS), 150, serving.FLIGHTS_PER_PAGE)
    pages = [("all", index.total, index.page(5000, serving.FLIGHTS_PER_PAGE)), ("some", total, some)]
    shown = [page.select(F.lit(asked).alias("asked"), F.lit(n).cast("long").alias("total"), *FLIGHT) for asked, n, page in pages]
    return shown[0].unionByName(shown[1])


@query(
    "airplane_search",
    """SELECT * FROM airplanes WHERE lower("OwnerState") = 'asia' ORDER BY "Owner" LIMIT 5 OFFSET 5""",
    "airplanes",
)
def _(spark, sf):
    return serving.airplane_search(views.airplanes(spark, sf), {"OwnerState": "Asia"}, start=5)


@query(
    "search_total",
    f"""WITH m AS (SELECT * FROM flights WHERE {_SEARCH_WHERE}), n AS (SELECT count(*) AS c FROM m)
        SELECT 15 AS "start", CAST(least(greatest(c - 15, 0), 15) AS BIGINT) AS records,
          CAST(CASE WHEN c > 15 THEN c ELSE 0 END AS BIGINT) AS total FROM n
        UNION ALL SELECT 9000, CAST(least(greatest(c - 9000, 0), 15) AS BIGINT),
          CAST(CASE WHEN c > 9000 THEN c ELSE 0 END AS BIGINT) FROM n""",
    "flights",
)
def _(spark, sf):
    flights = views.flights(spark, sf, *FLIGHT)
    matches = serving.matching(flights, _SEARCH, serving.FLIGHT_SEARCH_FIELDS)

    def totals(start):
        found = serving.search_total(matches, start, serving.FLIGHTS_PER_PAGE)
        return found.select(F.lit(start).alias("start"), "records", "total")

    return totals(15).unionByName(totals(9000))


@query(
    "nav_offsets",
    """SELECT *, next_bottom >= 0 AND next_top > 0 AND total > next_bottom AS next_shown,
         prev_bottom >= 0 AND prev_top > 0 AND total > prev_bottom AS prev_shown
       FROM (SELECT "Carrier", total, "start", "end", "start" + 15 AS next_bottom, "end" + 15 AS next_top,
         greatest("start" - 15, 0) AS prev_bottom, greatest("end" - 15, 0) AS prev_top
         FROM (SELECT "Carrier", CAST(count(*) AS BIGINT) AS total, CAST(count(DISTINCT "TailNum") AS BIGINT) AS "start",
           CAST(count(DISTINCT "TailNum") + 15 AS BIGINT) AS "end" FROM flights GROUP BY "Carrier"))""",
    "flights",
)
def _(spark, sf):
    # Every carrier's result list, opened as many rows in as it has airplanes.
    rows = views.flights(spark, sf, "Carrier", "TailNum")
    pairs = rows.groupBy("Carrier", "TailNum").agg(F.count(F.lit(1)).alias("n"))
    pages = pairs.groupBy("Carrier").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("start")
    ).withColumn("end", F.col("start") + 15)
    return serving.nav_offsets(pages, serving.FLIGHTS_PER_PAGE)


@query(
    "predictions_on_day",
    """SELECT "UUID", "Timestamp", CASE "Prediction" WHEN 0 THEN 'On Time (0-15 Minute Delay)'
         WHEN 1 THEN 'Slightly Late (15-60 Minute Delay)' WHEN 2 THEN 'Very Late (60+ Minute Delay)' ELSE '' END AS label
       FROM predictions_a WHERE "Timestamp" >= '2024-01-15' AND "Timestamp" <= '2024-01-16'""",
    "predictions_a",
)
def _(spark, sf):
    return serving.predictions_on_day(views.predictions_a(spark, sf), "2024-01-15").select(
        "UUID", "Timestamp", "label"
    )
