"""Queries of the sources and sinks; what is written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.functions import labels, messages
from flightlake.operators import latest, training
from flightlake.operators.sizing import spread
from flightlake.plans import views
from flightlake.plans.catalog import query
from flightlake.session import materialize, scratch_dir
from flightlake.sources import readers, writers
from flightlake.streaming import jobs

TRAINING_COLUMNS = schemas.TRAINING.fieldNames()
_TRAINING = ", ".join(f'"{c}"' for c in TRAINING_COLUMNS)


def _training_rows(spark, sf):
    return views.flights(spark, sf, *TRAINING_COLUMNS)


@query("src_jsonl", f"SELECT {_TRAINING} FROM flights", "flights")
def _(spark, sf):
    path = scratch_dir(spark, "jsonl")
    # Compressing bz2 is slow: use all cores even on one small table.
    rows = spread(materialize(_training_rows(spark, sf), "rows"))
    rows.write.option("compression", "bzip2").json(path)
    return readers.read_jsonl(spark, path)


@query("src_table", "SELECT * FROM orders")
def _(spark, sf):
    return readers.read_table(spark, f"{sf}/orders.parquet")


@query(
    "src_table_filtered",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 250000",
)
def _(spark, sf):
    predicate = "o_orderpriority = '1-URGENT' AND o_totalprice > 250000"
    return readers.read_filtered(spark, f"{sf}/orders.parquet", predicate).select("o_orderkey", "o_totalprice")


@query(
    "src_driver_rows",
    """SELECT l.label, CAST(count(*) AS BIGINT) AS n FROM training t JOIN (VALUES (0, 'Early (15+ min early)'),
       (1, 'Slightly Early (0-15 min early)'), (2, 'Slightly Late (0-30 min delay)'), (3, 'Very Late (30+ min delay)')) l(c, label)
       ON t."ArrDelayBucket" = l.c GROUP BY l.label""",
    "training",
)
def _(spark, sf):
    """Literal label rows joined to the training rows."""
    names = readers.literal_rows(spark, labels.LIVE_LABELS.items(), "ArrDelayBucket int, label string")
    columns = [c for c in schemas.FEATURES if c != "Route"] + ["ArrDelay"]
    rows = training.training_set(views.flights(spark, sf, *columns))
    counts = rows.groupBy("ArrDelayBucket").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(names, "ArrDelayBucket").select("label", "n")


@query(
    "src_text_lines",
    """SELECT count(*) FILTER (WHERE event_id % 97 = 0)::BIGINT AS broken, CAST(count(*) AS BIGINT) AS lines FROM requests""",
    "requests",
)
def _(spark, sf):
    path = scratch_dir(spark, "lines")
    writers.write_topic(views.request_lines(spark, sf), path)
    lines = readers.text_lines(spark, path)
    broken = F.count_if(F.col("value") == "not json")
    return lines.agg(broken.alias("broken"), F.count(F.lit(1)).alias("lines"))


@query(
    "src_topic",
    """SELECT "UUID", "Carrier", "DepDelay", "Timestamp" FROM requests WHERE event_id % 97 <> 0
       UNION ALL SELECT NULL, NULL, NULL, NULL FROM requests WHERE event_id % 97 = 0""",
    "requests",
)
def _(spark, sf):
    topic, out, state = (scratch_dir(spark, n) for n in ("topic", "received", "state"))
    writers.write_topic(views.request_lines(spark, sf), topic)
    jobs.drain(jobs.start_files(readers.read_topic(spark, topic), out, state))
    received = messages.parse_messages(readers.text_lines(spark, out), schemas.REQUEST)
    return received.select("UUID", "Carrier", "DepDelay", "Timestamp")


@query(
    "src_multi_topic",
    """SELECT "UUID", "Distance", CAST(NULL AS DOUBLE) AS "Prediction" FROM requests WHERE event_id % 97 <> 0
       UNION ALL SELECT NULL, NULL, NULL FROM requests WHERE event_id % 97 = 0
       UNION ALL SELECT "UUID", NULL, "Prediction" FROM predictions_a""",
    "requests", "predictions_a",
)
def _(spark, sf):
    asked, answered, out, state = (scratch_dir(spark, n) for n in ("asked", "answered", "both", "state"))
    writers.write_topic(views.request_lines(spark, sf), asked)
    answers = views.predictions_a(spark, sf)
    writers.write_topic(messages.emit_json(answers, jobs.MESSAGE_COLUMNS), answered)
    jobs.drain(jobs.start_files(readers.read_topics(spark, [asked, answered]), out, state))
    return readers.text_lines(spark, out).select(
        F.from_json("value", "UUID string, Distance double, Prediction double").alias("d")
    ).select("d.*")


@query("sink_table_replace", f"SELECT {_TRAINING} FROM flights", "flights")
def _(spark, sf):
    path = scratch_dir(spark, "table")
    rows = _training_rows(spark, sf)
    writers.replace_table(views.airplanes(spark, sf), path)
    return writers.replace_table(rows, path)


@query(
    "sink_topic_json",
    """SELECT "UUID", "Prediction", "Origin", "Dest", "Carrier", "DepDelay", "Timestamp" FROM predictions_a""",
    "predictions_a",
)
def _(spark, sf):
    topic = scratch_dir(spark, "topic")
    rows = views.predictions_a(spark, sf)
    writers.write_topic(messages.emit_json(rows, jobs.MESSAGE_COLUMNS), topic)
    return messages.parse_messages(readers.text_lines(spark, topic), schemas.PREDICTION)


# Every flight reports its route's distance as resurveyed that day.
_SURVEYS = """SELECT "Origin", "Dest", "FlightDate", "Distance" + "DayOfMonth" AS "Distance" FROM flights WHERE "Dest" IS NOT NULL"""


@query(
    "sink_upsert_distance",
    f"""SELECT "Origin", "Dest", max_by("Distance", "FlightDate") AS "Distance" FROM ({_SURVEYS}) GROUP BY "Origin", "Dest" """,
    "flights",
)
def sink_upsert_distance(spark, sf):
    rows = views.flights(spark, sf, "Origin", "Dest", "FlightDate", "DayOfMonth", "Distance")
    surveys = rows.filter("Dest is not null").select(
        "Origin", "Dest", "FlightDate", (F.col("Distance") + F.col("DayOfMonth")).alias("Distance")
    )
    return latest.latest_per_key(surveys, ["Origin", "Dest"], ["FlightDate"]).drop("FlightDate")


@query(
    "sink_upsert_prediction",
    """SELECT "UUID" AS uuid, CAST(CAST(max_by("Prediction", "Offset") AS BIGINT) AS VARCHAR) || '.0' AS prediction,
       strftime(CAST(max_by("Timestamp", "Offset") AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
       max_by("Origin", "Offset") AS origin, max_by("Dest", "Offset") AS dest, max_by("Carrier", "Offset") AS carrier,
       max_by("DepDelay", "Offset") AS dep_delay FROM predictions_a GROUP BY "UUID" """,
    "predictions_a",
)
def _(spark, sf):
    """Every third id's older answer arrives last, and counts."""
    lines = messages.emit_json(views.predictions_a(spark, sf), jobs.MESSAGE_COLUMNS, "Offset")
    stored = latest.store_predictions(lines, ["Offset"])
    return stored.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    "sink_append_task",
    """SELECT "UUID", "Carrier", "Origin", "Dest", "DepDelay", "Timestamp" FROM requests""",
    "requests",
)
def _(spark, sf):
    path = scratch_dir(spark, "tasks")
    rows = views.requests(spark, sf).select("UUID", "Carrier", "Origin", "Dest", "DepDelay", "Timestamp")
    first = F.col("Carrier") == "click"
    writers.append_rows(rows.filter(first), path)
    writers.append_rows(rows.filter(~first), path)
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "sink_daily_partition",
    """SELECT strftime(ts, '%Y.%m.%d') AS event_date, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS ids
       FROM events GROUP BY 1""",
)
def _(spark, sf):
    path = scratch_dir(spark, "daily")
    writers.write_daily(views.table(spark, sf, "events"), "ts", path)
    return (
        spark.read.schema("event_id bigint, event_date string").parquet(path)
        .groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
    )


@query(
    "sink_json_dump",
    """SELECT "Year", "Month", "Carrier", CAST(count(*) AS BIGINT) AS total_flights FROM flights GROUP BY ALL""",
    "flights",
)
def _(spark, sf):
    path = scratch_dir(spark, "dump")
    rows = views.flights(spark, sf, "Year", "Month", "Carrier")
    totals = rows.groupBy("Year", "Month", "Carrier").agg(F.count(F.lit(1)).alias("total_flights"))
    writers.dump_json(totals, path)
    return spark.read.schema(totals.schema).json(path)


@query("dim_indexed_import", "SELECT * FROM distances", "distances")
def _(spark, sf):
    return writers.write_indexed(views.distances(spark, sf), ["Origin", "Dest"], scratch_dir(spark, "routes"))


@query(
    "batch_of_n",
    """WITH s AS (SELECT (row_number() OVER (ORDER BY "Origin", "Dest") - 1) AS rn, 'INSERT INTO origin_dest_distances(origin, dest, distance) VALUES ('''
         || "Origin" || ''', ''' || "Dest" || ''', ' || CAST("Distance" AS VARCHAR) || ');' || chr(10) AS stmt FROM distances)
       SELECT CAST(rn // 100 AS BIGINT) AS batch_no, CAST(count(*) AS BIGINT) AS n,
         'BEGIN BATCH' || chr(10) || string_agg(stmt, '' ORDER BY rn) || chr(10) || 'APPLY BATCH;' AS "text" FROM s GROUP BY 1""",
    "distances",
)
def _(spark, sf):
    return writers.insert_batches(views.distances(spark, sf))
