"""Queries of the projection and expression operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.functions import clocks, defaults, features, labels, messages
from flightlake.operators import requests as forms
from flightlake.operators import training
from flightlake.plans import views
from flightlake.plans.catalog import query

_ROUTE_INPUT = """SELECT "FlightNum", "TailNum", "FlightDate", {route} AS "Route" FROM flights"""


@query("route_concat_ws", _ROUTE_INPUT.format(route="""concat_ws('-', "Origin", "Dest")"""), "flights")
def _(spark, sf):
    rows = views.flights(spark, sf, "FlightNum", "TailNum", "FlightDate", "Origin", "Dest")
    return rows.select("FlightNum", "TailNum", "FlightDate", features.route_skip_nulls().alias("Route"))


@query("route_concat_null", _ROUTE_INPUT.format(route="""("Origin" || '-' || "Dest")"""), "flights")
def _(spark, sf):
    rows = views.flights(spark, sf, "FlightNum", "TailNum", "FlightDate", "Origin", "Dest")
    return rows.select("FlightNum", "TailNum", "FlightDate", features.route_or_null().alias("Route"))


@query(
    "arr_delay_bucket",
    """SELECT "FlightNum", "ArrDelay", CASE WHEN "ArrDelay" < -15 THEN 0 WHEN "ArrDelay" < 0 THEN 1
       WHEN "ArrDelay" < 30 THEN 2 ELSE 3 END AS "ArrDelayBucket" FROM flights""",
    "flights",
)
def _(spark, sf):
    rows = views.flights(spark, sf, "FlightNum", "ArrDelay")
    return rows.withColumn("ArrDelayBucket", features.delay_class())


@query(
    "arr_delay_bucketizer",
    """SELECT "FlightNum", "ArrDelay", CASE WHEN "ArrDelay" IS NULL THEN NULL WHEN "ArrDelay" < -15 THEN 0.0::DOUBLE
       WHEN "ArrDelay" < 0 THEN 1.0::DOUBLE WHEN "ArrDelay" < 30 THEN 2.0::DOUBLE ELSE 3.0::DOUBLE END AS "ArrDelayBucket"
       FROM flights""",
    "flights",
)
def _(spark, sf):
    return features.delay_bucketizer().transform(views.flights(spark, sf, "FlightNum", "ArrDelay"))


_MODEL_COLUMNS = """"Carrier", "Origin", "Dest", concat_ws('-', "Origin", "Dest") AS "Route", "DepDelay", "Distance",
  "DayOfMonth", "DayOfWeek", "DayOfYear", CASE WHEN "ArrDelay" < -15 THEN 0 WHEN "ArrDelay" < 0 THEN 1
  WHEN "ArrDelay" < 30 THEN 2 ELSE 3 END AS "ArrDelayBucket" """

_TRAINING_INPUT = [c for c in schemas.FEATURES if c != "Route"] + ["ArrDelay"]


def _with_model_columns(spark, sf):
    rows = views.flights(spark, sf, *_TRAINING_INPUT)
    return rows.withColumn("Route", features.route_skip_nulls()).withColumn(
        schemas.LABEL, features.delay_class()
    )


@query("feature_select", f"SELECT {_MODEL_COLUMNS} FROM flights", "flights")
def _(spark, sf):
    return training.feature_select(_with_model_columns(spark, sf))


@query("drop_null_rows", """SELECT "FlightNum", "Dest", "ArrDelay" FROM flights
       WHERE "Dest" IS NOT NULL AND "ArrDelay" IS NOT NULL""", "flights")
def _(spark, sf):
    return views.flights(spark, sf, "FlightNum", "Dest", "ArrDelay").na.drop("any")


@query("training_set", "SELECT * FROM training", "training")
def _(spark, sf):
    return training.training_set(views.flights(spark, sf, *_TRAINING_INPUT))


@query(
    "training_class_counts",
    """SELECT "ArrDelayBucket", CAST(count(*) AS BIGINT) AS n FROM training GROUP BY "ArrDelayBucket" """,
    "training",
)
def training_class_counts(spark, sf):
    rows = training.training_set(views.flights(spark, sf, *_TRAINING_INPUT))
    return rows.groupBy(schemas.LABEL).agg(F.count(F.lit(1)).alias("n"))


@query(
    "preview",
    """SELECT "Carrier", "Origin", "Dest", "DepDelay", "ArrDelay" FROM flights
       ORDER BY "Carrier" NULLS LAST, "Origin" NULLS LAST, "Dest" NULLS LAST, "DepDelay" NULLS LAST, "ArrDelay" NULLS LAST LIMIT 5""",
    "flights",
)
def _(spark, sf):
    columns = ["Carrier", "Origin", "Dest", "DepDelay", "ArrDelay"]
    rows = views.flights(spark, sf, *columns)
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in columns]).limit(5)


@query(
    "value_to_string",
    """SELECT CASE WHEN event_id % 97 = 0 THEN 0 ELSE 1 END AS parsed, CAST(count(*) AS BIGINT) AS n
       FROM events GROUP BY 1""",
)
def _(spark, sf):
    payload = views.request_lines(spark, sf).select(F.col("value").cast("binary").alias("value"))
    text = messages.value_to_string(payload)
    parsed = messages.is_json_object().cast("int").alias("parsed")
    return text.groupBy(parsed).agg(F.count(F.lit(1)).alias("n"))


_PARSED_REQUEST = """SELECT {columns} FROM (SELECT
  CASE WHEN bad THEN NULL ELSE "UUID" END AS "UUID", CASE WHEN bad THEN NULL ELSE "Carrier" END AS "Carrier",
  CASE WHEN bad THEN NULL ELSE "Origin" END AS "Origin", CASE WHEN bad THEN NULL ELSE "Dest" END AS "Dest",
  CASE WHEN bad THEN NULL ELSE "DepDelay" END AS "DepDelay", CASE WHEN bad THEN NULL ELSE "Distance" END AS "Distance",
  CASE WHEN bad THEN NULL ELSE "DayOfMonth" END AS "DayOfMonth", CASE WHEN bad THEN NULL ELSE "DayOfWeek" END AS "DayOfWeek",
  CASE WHEN bad THEN NULL ELSE "DayOfYear" END AS "DayOfYear", CASE WHEN bad THEN NULL ELSE "Timestamp" END AS "Timestamp"
  FROM (SELECT *, event_id % 97 = 0 AS bad FROM requests)) AS p"""


@query("json_parse", _PARSED_REQUEST.format(columns="*"), "requests")
def _(spark, sf):
    return messages.parse_messages(views.request_lines(spark, sf), schemas.REQUEST)


@query(
    "struct_flatten",
    _PARSED_REQUEST.format(
        columns="""p."Origin", p."DayOfWeek", p."Dest", p."DepDelay", p."Carrier", p."UUID", p."Distance",
        replace(substr(p."Timestamp", 1, 19), 'T', ' ') AS "Seconds" """
    ),
    "requests",
)
def _(spark, sf):
    parsed = messages.parse_json(views.request_lines(spark, sf), schemas.REQUEST_TYPED, into="flight")
    fields = ["Origin", "DayOfWeek", "Dest", "DepDelay", "Carrier", "UUID", "Distance", "Timestamp"]
    rows = messages.flatten(parsed, "flight", fields)
    return rows.withColumn("Seconds", F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss")).drop("Timestamp")


@query(
    "json_path_extract",
    """SELECT "Origin" AS origin, "Dest" AS dest, "Distance" AS distance FROM requests
       WHERE event_id % 97 <> 0 AND "Distance" IS NOT NULL""",
    "requests",
)
def _(spark, sf):
    paths = {"origin": "$.Origin", "dest": "$.Dest", "distance": "$.Distance"}
    found = messages.extract_paths(views.request_lines(spark, sf), paths)
    return found.withColumn("distance", F.col("distance").cast("double"))


@query(
    "json_emit",
    """SELECT "UUID", "Origin", "Distance", "Distance" IS NOT NULL AS kept_short, true AS kept_full FROM requests""",
    "requests",
)
def _(spark, sf):
    rows = views.requests(spark, sf)
    columns = ["UUID", "Origin", "Distance"]
    short = F.to_json(F.struct(*columns))
    full = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    both = rows.select(short.alias("short"), full.alias("full"))
    parsed = both.select(
        F.from_json("full", "UUID string, Origin string, Distance double").alias("d"),
        F.col("short").contains('"Distance"').alias("kept_short"),
        F.col("full").contains('"Distance"').alias("kept_full"),
    )
    return parsed.select("d.*", "kept_short", "kept_full")


@query("drop_columns", """SELECT "UUID", "Carrier", "Origin", "Dest" FROM requests""", "requests")
def _(spark, sf):
    unwanted = ["DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "DayOfYear", "Timestamp", "rawPrediction"]
    return views.requests(spark, sf).drop(*unwanted)


@query("rename_column", """SELECT "UUID", "Prediction" FROM predictions_a""", "predictions_a")
def _(spark, sf):
    lower = views.predictions_a(spark, sf).select("UUID", F.col("Prediction").alias("prediction"))
    return lower.withColumnRenamed("prediction", "Prediction")


@query(
    "fill_defaults_spark",
    _PARSED_REQUEST.format(
        columns="""p."UUID", coalesce(nullif(p."Carrier", ''), 'AA') AS "Carrier",
        coalesce(nullif(p."Origin", ''), 'LAX') AS "Origin", coalesce(nullif(p."Dest", ''), 'JFK') AS "Dest",
        coalesce(p."DepDelay", 0.0) AS "DepDelay", coalesce(p."Distance", 500.0) AS "Distance",
        coalesce(p."DayOfMonth", 1) AS "DayOfMonth", coalesce(p."DayOfWeek", 1) AS "DayOfWeek",
        coalesce(p."DayOfYear", 1) AS "DayOfYear", p."Timestamp",
        coalesce(nullif(p."Origin", ''), 'LAX') || '-' || coalesce(nullif(p."Dest", ''), 'JFK') AS "Route" """
    ),
    "requests",
)
def _(spark, sf):
    parsed = messages.parse_messages(views.request_lines(spark, sf), schemas.REQUEST)
    return defaults.fill_by_field(parsed)


_FLINK_SQL = """SELECT "UUID", "Carrier", "Origin", "Dest", "Origin" || '-' || "Dest" AS "Route",
  "DepDelay", coalesce("Distance", 0.0) AS "Distance", "DayOfMonth",
  CASE WHEN "DayOfWeek" = 0 THEN 1 ELSE "DayOfWeek" END AS "DayOfWeek", "DayOfYear"
  FROM requests WHERE event_id % 97 <> 0"""


@query("fill_defaults_flink", _FLINK_SQL, "requests")
def _(spark, sf):
    good, _rejected = defaults.split_failed(defaults.fill_or_fail(views.request_lines(spark, sf)))
    return good.select(
        F.col("echo_UUID").alias("UUID"), "Carrier", "Origin", "Dest", "Route", "DepDelay", "Distance",
        "DayOfMonth", "DayOfWeek", "DayOfYear",
    )


@query(
    "drop_failed",
    """SELECT 'kept' AS part, NULL AS message, NULL AS reason, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_id % 97 <> 0
       UNION ALL SELECT 'rejected', 'not json', 'no JSON object', CAST(count(*) AS BIGINT) FROM events WHERE event_id % 97 = 0""",
)
def _(spark, sf):
    # One pass over the messages: the failure mark is the grouping key.
    marked = defaults.fill_or_fail(views.request_lines(spark, sf))
    part = F.when(F.col("failed"), "rejected").otherwise("kept").alias("part")
    message = F.when(F.col("failed"), F.col("message")).alias("message")
    return marked.groupBy(part, message, "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_parts",
    """SELECT "FlightNum", "FlightDate", "DayOfYear", "DayOfMonth", "DayOfWeek" FROM flights""",
    "flights",
)
def _(spark, sf):
    return views.flights(spark, sf, "FlightNum", "FlightDate").withColumns(clocks.date_parts())


# Web forms: one per line item, everything as text.
def _forms(spark, sf):
    rows = views.flights(spark, sf, "DepDelay", "Carrier", "FlightDate", "Dest", "FlightNum", "Origin", "ArrDelay")
    delay = F.when(F.col("ArrDelay").isNull(), F.lit("unknown")).otherwise(F.col("DepDelay").cast("string"))
    return rows.withColumn("DepDelay", delay).drop("ArrDelay")


_TYPED_FORM = """SELECT CASE WHEN "ArrDelay" IS NULL THEN NULL ELSE "DepDelay" END AS "DepDelay", "Carrier", "FlightDate", "Dest",
  "FlightNum", "Origin" FROM flights"""


@query("typed_form", _TYPED_FORM, "flights")
def _(spark, sf):
    return forms.typed_form(_forms(spark, sf))


def _distance_table(spark, sf):
    from flightlake.session import materialize

    return materialize(views.distances(spark, sf), "distances")


@query(
    "request_enrich",
    """SELECT CASE WHEN f."ArrDelay" IS NULL THEN NULL ELSE f."DepDelay" END AS "DepDelay", f."Carrier", f."FlightDate", f."Dest",
       f."FlightNum", f."Origin", d."Distance", f."DayOfYear", f."DayOfMonth", f."DayOfWeek"
       FROM flights f LEFT JOIN distances d ON f."Origin" = d."Origin" AND f."Dest" = d."Dest" """,
    "flights", "distances",
)
def _(spark, sf):
    return forms.request_enrich(_forms(spark, sf), _distance_table(spark, sf))


@query(
    "request_stamp",
    """SELECT "Carrier", "Origin", "Dest", "DepDelay", true AS has_time, true AS has_id FROM requests""",
    "requests",
)
def _(spark, sf):
    """Clock and id are new in every run: checked by their form."""
    stamped = clocks.stamp(views.requests(spark, sf).select("Carrier", "Origin", "Dest", "DepDelay"))
    return stamped.withColumns({
        "has_time": F.col("Timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$"),
        "has_id": F.col("UUID").rlike(r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"),
    }).drop("Timestamp", "UUID")


@query("add_constant", """SELECT "UUID", 'flight_prediction' AS log_type FROM requests""", "requests")
def _(spark, sf):
    return views.requests(spark, sf).select("UUID").withColumn("log_type", F.lit("flight_prediction"))


@query(
    "parse_ts_multi",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
         WHEN event_type = 'click' THEN strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%f')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS parsed FROM events""",
)
def _(spark, sf):
    # The three spellings that arrive, by kind of event; errors carry none.
    ts = F.col("ts").cast("timestamp")
    text = (
        F.when(F.col("event_type") == "click", F.unix_millis(ts).cast("string"))
        .when(F.col("event_type") == "view", F.concat(clocks.iso_text(ts), F.lit("Z")))
        .when(F.col("event_type") == "error", F.lit("yesterday"))
        .otherwise(clocks.iso_text(ts))
    )
    parsed = clocks.parse_any(F.col("text"))
    return (
        views.table(spark, sf, "events").withColumn("text", text)
        .select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"))
    )


@query(
    "parse_ts_iso_z",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS parsed FROM events""",
)
def _(spark, sf):
    ts = F.col("ts").cast("timestamp")
    text = F.when(F.col("event_type") == "error", F.lit("soon")).otherwise(
        F.concat(clocks.iso_text(ts), F.lit("Z"))
    )
    return (
        views.table(spark, sf, "events").withColumn("text", text)
        .select(
            "event_id",
            F.date_format(clocks.parse_iso_zulu(F.col("text")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"),
        )
    )


@query(
    "prediction_text",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN '0.0' ELSE CAST(event_id % 4 AS VARCHAR) || '.0' END AS prediction
       FROM events""",
)
def _(spark, sf):
    predicted = F.when(F.col("event_type") != "error", F.col("event_id") % 4)
    return views.table(spark, sf, "events").select(
        "event_id", labels.prediction_text(predicted).alias("prediction")
    )


def _label_sql(cases: dict[int, str], otherwise: str) -> str:
    when = " ".join(f"WHEN {value} THEN '{text}'" for value, text in cases.items())
    return f"SELECT event_id, CASE event_id % 6 {when} ELSE {otherwise} END AS label FROM events"


@query("bucket_label_4", _label_sql(labels.LIVE_LABELS, "'Prediction: ' || CAST(event_id % 6 AS VARCHAR)"))
def _(spark, sf):
    label = labels.live_label(F.col("event_id") % 6)
    return views.table(spark, sf, "events").select("event_id", label.alias("label"))


@query("bucket_label_3", _label_sql(labels.BATCH_LABELS, "''"))
def _(spark, sf):
    label = labels.batch_label(F.col("event_id") % 6)
    return views.table(spark, sf, "events").select("event_id", label.alias("label"))


@query(
    "truncate_label",
    """SELECT c_custkey, CASE WHEN length(c_name) > 14 THEN substr(c_name, 1, 14) || '...' ELSE c_name END AS name_label,
       CASE WHEN length(c_mktsegment) > 14 THEN substr(c_mktsegment, 1, 14) || '...' ELSE c_mktsegment END AS segment_label
       FROM customer""",
)
def _(spark, sf):
    return views.table(spark, sf, "customer").select(
        "c_custkey",
        labels.axis_label(F.col("c_name")).alias("name_label"),
        labels.axis_label(F.col("c_mktsegment")).alias("segment_label"),
    )
