"""Flight-domain views over the given star-schema tables.

Each view exists twice: as a DataFrame and as SQL text (``SQL``) for the
independent check.  The remainders below only shape values (which rows carry a
null or a broken message); no view leaves rows out by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions.clocks import iso_text
from flightlake.operators.sizing import spread
from flightlake.schemas import REQUEST


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _flight_columns() -> dict[str, Column]:
    ship = F.col("l_shipdate")
    dep = (F.col("l_partkey") % 24) * 100 + F.col("l_suppkey") % 60
    arr_minutes = F.expr("(l_partkey % 24) * 60 + l_suppkey % 60 + 90")
    distance = F.lit(100.0) + F.lit(50.0) * F.abs(F.col("sn_key") - F.col("cn_key"))
    return {
        "FlightNum": F.col("l_orderkey").cast("string"),
        "Carrier": F.col("p_brand"),
        "TailNum": F.concat(F.lit("N"), F.col("l_suppkey").cast("string")),
        "Origin": F.col("sn_name"),
        "Dest": F.when(F.col("l_partkey") % 40 != 0, F.col("cn_name")),
        "FlightDate": F.date_format(ship, "yyyy-MM-dd"),
        "Year": F.year(ship),
        "Month": F.month(ship),
        "DayOfMonth": F.dayofmonth(ship),
        "DayOfYear": F.dayofyear(ship),
        "DayOfWeek": F.weekday(ship),
        "DepTime": dep.cast("int"),
        "ArrTime": (F.floor(arr_minutes / 60) % 24 * 100 + arr_minutes % 60).cast("int"),
        "DepDelay": F.col("l_quantity") - 25,
        "ArrDelay": F.when(
            F.col("l_partkey") % 50 != 0, F.col("l_quantity") - 25 + 2 * F.col("l_linenumber")
        ),
        "Distance": distance,
        "AirTime": distance / 8,
    }


def flights(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """One row per line item.  Only the joins the wanted columns need are made:
    every foreign key resolves, so an unused inner join changes nothing."""
    expressions = _flight_columns()
    wanted = columns or tuple(expressions)
    rows = table(spark, sf, "lineitem")
    nation = table(spark, sf, "nation")
    if {"Dest", "Distance", "AirTime"} & set(wanted):
        dest = nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"))
        customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
        orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
        # Customers meet the orders first, so the line items are shuffled at
        # most once, on the order key, and before other joins make them wider.
        orders = orders.join(customer, orders.o_custkey == customer.c_custkey)
        orders = orders.join(dest, orders.c_nationkey == dest.cn_key)
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey)
    if {"Carrier"} & set(wanted):
        part = table(spark, sf, "part").select("p_partkey", "p_brand")
        rows = rows.join(part, rows.l_partkey == part.p_partkey)
    if {"Origin", "Distance", "AirTime"} & set(wanted):
        origin = nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"))
        supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
        # One table at a time: Spark knows a file's size, but not a join's, so
        # only this way small tables are broadcast by their real size.
        rows = rows.join(supplier, rows.l_suppkey == supplier.s_suppkey)
        rows = rows.join(origin, rows.s_nationkey == origin.sn_key)
    return rows.select(*[expressions[c].alias(c) for c in wanted])


def distances(spark: SparkSession, sf: str) -> DataFrame:
    """Route distances; a route has one distance."""
    return (
        flights(spark, sf, "Origin", "Dest", "Distance").filter("Dest is not null").distinct()
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Scoring requests, one per event."""
    # Message work is heavy per row: use all cores even on one small file.
    events = spread(table(spark, sf, "events"))
    nation = table(spark, sf, "nation")
    origin = nation.select(F.col("n_nationkey").alias("on_key"), F.col("n_name").alias("Origin"))
    dest = nation.select(F.col("n_nationkey").alias("dn_key"), F.col("n_name").alias("Dest"))
    rows = events.join(origin, F.col("user_id") % 25 == F.col("on_key")).join(
        dest, F.col("event_id") % 25 == F.col("dn_key")
    )
    distance = F.lit(100.0) + F.lit(50.0) * F.abs(F.col("on_key") - F.col("dn_key"))
    return rows.select(
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("UUID"),
        F.col("event_type").alias("Carrier"),
        "Origin",
        "Dest",
        F.col("value").alias("DepDelay"),
        F.when(F.col("event_id") % 11 != 0, distance).alias("Distance"),
        F.dayofmonth("ts").alias("DayOfMonth"),
        F.weekday("ts").alias("DayOfWeek"),
        F.dayofyear("ts").alias("DayOfYear"),
        iso_text(F.col("ts")).alias("Timestamp"),
    )


def request_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The requests as message text; every 97th event sends a broken line."""
    rows = requests(spark, sf)
    broken = F.substring("UUID", 5, 20).cast("bigint") % 97 == 0
    lines = rows.select(F.to_json(F.struct(*REQUEST.fieldNames())).alias("value"), broken.alias("_broken"))
    return lines.select(F.when(F.col("_broken"), "not json").otherwise(F.col("value")).alias("value"))


def _predictions(events: DataFrame, prediction: Column) -> DataFrame:
    return spread(events).select(
        F.concat(F.lit("req-"), F.floor(F.col("event_id") / 2).cast("string")).alias("UUID"),
        prediction.cast("double").alias("Prediction"),
        F.concat(F.lit("O"), (F.col("user_id") % 25).cast("string")).alias("Origin"),
        F.concat(F.lit("D"), (F.col("event_id") % 25).cast("string")).alias("Dest"),
        F.col("event_type").alias("Carrier"),
        F.col("value").alias("DepDelay"),
        iso_text(F.col("ts")).alias("Timestamp"),
        # Place in the topic: of every third pair the older answer comes last.
        F.when(
            F.floor(F.col("event_id") / 2) % 3 == 0, F.col("event_id") + 1 - 2 * (F.col("event_id") % 2)
        ).otherwise(F.col("event_id")).alias("Offset"),
    )


def predictions_a(spark: SparkSession, sf: str) -> DataFrame:
    """Results of the first engine: two per request id, the one that arrived last counts."""
    return _predictions(table(spark, sf, "events"), F.col("event_id") % 4)


def predictions_b(spark: SparkSession, sf: str) -> DataFrame:
    """Results of the second engine, which does not answer ``error`` events."""
    events = table(spark, sf, "events").filter(F.col("event_type") != "error")
    return _predictions(events, F.col("user_id") % 4)


def airplanes(spark: SparkSession, sf: str) -> DataFrame:
    supplier, nation, region = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    rows = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    key = F.col("s_suppkey")

    def coded(prefix: str, number: Column) -> Column:
        return F.concat(F.lit(prefix), number.cast("string"))

    return rows.select(
        coded("N", key).alias("TailNum"),
        F.col("s_name").alias("Owner"),
        F.col("r_name").alias("OwnerState"),
        F.col("n_name").alias("Manufacturer"),
        coded("M", key % 10).alias("Model"),
        (F.lit(1980) + key % 40).cast("int").alias("ManufacturerYear"),
        coded("SN", key * 7).alias("SerialNumber"),
        coded("E", F.col("s_nationkey") % 3).alias("EngineManufacturer"),
        coded("EM", key % 4).alias("EngineModel"),
    )


def airlines(spark: SparkSession, sf: str) -> DataFrame:
    code = table(spark, sf, "part").select(F.col("p_brand").alias("CarrierCode")).distinct()
    domain = F.concat(F.lower(F.replace("CarrierCode", F.lit("#"), F.lit("-"))), F.lit(".example"))
    return code.select(
        "CarrierCode",
        F.concat(F.lit("Airline "), "CarrierCode").alias("Name"),
        F.concat(F.lit("https://"), domain).alias("url"),
        domain.alias("domain"),
        F.concat(F.lit("https://"), domain, F.lit("/logo.png")).alias("logo_url"),
        F.concat(F.lit("Summary of "), "CarrierCode").alias("summary"),
    )


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Registered model versions, one per order."""
    stage = (
        F.when(F.col("o_orderstatus") == "O", "None")
        .when(F.col("o_orderstatus") == "P", "Staging")
        .otherwise("Production")
    )
    return table(spark, sf, "orders").select(
        F.concat(F.lit("model-"), F.col("o_orderpriority")).alias("name"),
        F.col("o_orderkey").alias("version"),
        stage.alias("stage"),
        F.md5(F.col("o_orderkey").cast("string")).alias("run_id"),
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Training runs, one per order."""
    return table(spark, sf, "orders").select(
        F.md5(F.col("o_orderkey").cast("string")).alias("run_id"),
        F.concat(F.lit("model-"), F.col("o_orderpriority")).alias("model_name"),
        F.concat(F.lit("models/"), F.col("o_orderkey").cast("string")).alias("model_path"),
        iso_text(F.col("o_orderdate")).alias("trained_at"),
        (F.floor(F.col("o_totalprice")) % 1000 / 1000).alias("accuracy"),
    )


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """File listing: one object per document; French ones carry no mtime."""
    return table(spark, sf, "documents").select(
        F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"),
        F.col("n_chars").alias("size"),
        F.when(F.col("lang") != "fr", F.lit(1_700_000_000) + F.col("doc_id") * 60).alias("mtime"),
        F.md5("text").alias("md5"),
    )


def manifest_copy(spark: SparkSession, sf: str) -> DataFrame:
    """A stale mirror of the listing: one source missing, one language resized,
    one rewritten at equal size, plus left-over objects from the label table."""
    source = manifest(spark, sf)
    level = F.split("path", "/")
    mirrored = source.filter(level[0] != "src3").select(
        "path",
        F.when(level[1] == "de", F.col("size") + 1).otherwise(F.col("size")).alias("size"),
        F.when(level[1] == "en", F.col("mtime")).alias("mtime"),
        F.when(level[1] == "es", F.md5("md5")).otherwise(F.col("md5")).alias("md5"),
    )
    extra = table(spark, sf, "labels").select(
        F.concat(F.lit("old/"), F.col("quality").cast("string"), F.lit("/"), F.col("doc_id").cast("string")).alias("path"),
        F.col("doc_id").alias("size"),
        F.lit(None).cast("bigint").alias("mtime"),
        F.md5(F.col("doc_id").cast("string")).alias("md5"),
    )
    return mirrored.unionByName(extra)


_PREDICTION_SQL = """
SELECT 'req-' || CAST(event_id // 2 AS VARCHAR) AS "UUID", CAST({prediction} AS DOUBLE) AS "Prediction",
  'O' || CAST(user_id % 25 AS VARCHAR) AS "Origin", 'D' || CAST(event_id % 25 AS VARCHAR) AS "Dest",
  event_type AS "Carrier", value AS "DepDelay", strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "Timestamp",
  CASE WHEN event_id // 2 % 3 = 0 THEN event_id + 1 - 2 * (event_id % 2) ELSE event_id END AS "Offset"
FROM events {where}"""

# SQL text of each view, in dependency order.
SQL = {
    "flights": """
SELECT CAST(l_orderkey AS VARCHAR) AS "FlightNum", p_brand AS "Carrier", 'N' || CAST(l_suppkey AS VARCHAR) AS "TailNum",
  sn.n_name AS "Origin", CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE cn.n_name END AS "Dest",
  strftime(l_shipdate, '%Y-%m-%d') AS "FlightDate",
  CAST(year(l_shipdate) AS INTEGER) AS "Year", CAST(month(l_shipdate) AS INTEGER) AS "Month",
  CAST(day(l_shipdate) AS INTEGER) AS "DayOfMonth", CAST(dayofyear(l_shipdate) AS INTEGER) AS "DayOfYear",
  CAST(isodow(l_shipdate) - 1 AS INTEGER) AS "DayOfWeek",
  CAST((l_partkey % 24) * 100 + l_suppkey % 60 AS INTEGER) AS "DepTime",
  CAST((((l_partkey % 24) * 60 + l_suppkey % 60 + 90) // 60 % 24) * 100
    + ((l_partkey % 24) * 60 + l_suppkey % 60 + 90) % 60 AS INTEGER) AS "ArrTime",
  l_quantity - 25 AS "DepDelay",
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_quantity - 25 + 2 * l_linenumber END AS "ArrDelay",
  CAST(100 + 50 * abs(s_nationkey - c_nationkey) AS DOUBLE) AS "Distance",
  CAST(100 + 50 * abs(s_nationkey - c_nationkey) AS DOUBLE) / 8 AS "AirTime"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN nation cn ON c_nationkey = cn.n_nationkey""",
    "distances": """
SELECT DISTINCT "Origin", "Dest", "Distance" FROM flights WHERE "Dest" IS NOT NULL""",
    "training": """
SELECT "Carrier", "Origin", "Dest", concat_ws('-', "Origin", "Dest") AS "Route", "DepDelay", "Distance",
  "DayOfMonth", "DayOfWeek", "DayOfYear",
  CASE WHEN "ArrDelay" < -15 THEN 0 WHEN "ArrDelay" < 0 THEN 1 WHEN "ArrDelay" < 30 THEN 2 ELSE 3 END AS "ArrDelayBucket"
FROM flights WHERE "Carrier" IS NOT NULL AND "Origin" IS NOT NULL AND "Dest" IS NOT NULL AND "DepDelay" IS NOT NULL
  AND "Distance" IS NOT NULL AND "DayOfMonth" IS NOT NULL""",
    "requests": """
SELECT 'evt-' || CAST(event_id AS VARCHAR) AS "UUID", event_type AS "Carrier", o.n_name AS "Origin", d.n_name AS "Dest",
  value AS "DepDelay",
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(100 + 50 * abs(o.n_nationkey - d.n_nationkey) AS DOUBLE) END AS "Distance",
  CAST(day(ts) AS INTEGER) AS "DayOfMonth", CAST(isodow(ts) - 1 AS INTEGER) AS "DayOfWeek",
  CAST(dayofyear(ts) AS INTEGER) AS "DayOfYear", strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "Timestamp", event_id
FROM events JOIN nation o ON user_id % 25 = o.n_nationkey JOIN nation d ON event_id % 25 = d.n_nationkey""",
    "predictions_a": _PREDICTION_SQL.format(prediction="event_id % 4", where=""),
    "predictions_b": _PREDICTION_SQL.format(prediction="user_id % 4", where="WHERE event_type <> 'error'"),
    "airplanes": """
SELECT 'N' || CAST(s_suppkey AS VARCHAR) AS "TailNum", s_name AS "Owner", r_name AS "OwnerState", n_name AS "Manufacturer",
  'M' || CAST(s_suppkey % 10 AS VARCHAR) AS "Model", CAST(1980 + s_suppkey % 40 AS INTEGER) AS "ManufacturerYear",
  'SN' || CAST(s_suppkey * 7 AS VARCHAR) AS "SerialNumber", 'E' || CAST(s_nationkey % 3 AS VARCHAR) AS "EngineManufacturer",
  'EM' || CAST(s_suppkey % 4 AS VARCHAR) AS "EngineModel"
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "airlines": """
SELECT DISTINCT p_brand AS "CarrierCode", 'Airline ' || p_brand AS "Name",
  'https://' || lower(replace(p_brand, '#', '-')) || '.example' AS "url",
  lower(replace(p_brand, '#', '-')) || '.example' AS "domain",
  'https://' || lower(replace(p_brand, '#', '-')) || '.example/logo.png' AS "logo_url",
  'Summary of ' || p_brand AS "summary" FROM part""",
    "versions": """
SELECT 'model-' || o_orderpriority AS "name", o_orderkey AS "version",
  CASE o_orderstatus WHEN 'O' THEN 'None' WHEN 'P' THEN 'Staging' ELSE 'Production' END AS "stage",
  md5(CAST(o_orderkey AS VARCHAR)) AS "run_id" FROM orders""",
    "runs": """
SELECT md5(CAST(o_orderkey AS VARCHAR)) AS "run_id", 'model-' || o_orderpriority AS "model_name",
  'models/' || CAST(o_orderkey AS VARCHAR) AS "model_path", strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS "trained_at",
  CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS DOUBLE) / 1000 AS "accuracy" FROM orders""",
    "manifest": """
SELECT "source" || '/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS "path", n_chars AS "size",
  CASE WHEN lang <> 'fr' THEN 1700000000 + doc_id * 60 END AS "mtime", md5("text") AS "md5",
  "source" AS src, lang FROM documents""",
    "manifest_copy": """
SELECT "path", CASE WHEN lang = 'de' THEN "size" + 1 ELSE "size" END AS "size", CASE WHEN lang = 'en' THEN "mtime" END AS "mtime",
  CASE WHEN lang = 'es' THEN md5("md5") ELSE "md5" END AS "md5" FROM manifest WHERE src <> 'src3'
UNION ALL SELECT 'old/' || CAST(quality AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR), doc_id, NULL, md5(CAST(doc_id AS VARCHAR)) FROM labels""",
}

_NEEDS = {
    "distances": ["flights"],
    "training": ["flights"],
    "manifest_copy": ["manifest"],
}


def with_views(body: str, *views: str) -> str:
    """SQL of a query over views; ``body`` may start with WITH for own steps."""
    wanted = set(views)
    for view in views:
        wanted.update(_NEEDS.get(view, []))
    steps = ", ".join(f"{name} AS ({SQL[name]})" for name in SQL if name in wanted)
    body = body.strip()
    if not steps:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {steps}, {body[5:]}"
    return f"WITH {steps} {body}"
