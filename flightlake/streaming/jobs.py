"""Streaming jobs.  Each starts a query and hands it back; the caller picks the trigger."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flightlake import schemas
from flightlake.functions import defaults, messages
from flightlake.functions.clocks import parse_any
from flightlake.functions.features import route_or_null
from flightlake.operators import versions
from flightlake.operators.aggregates import union_topics
from flightlake.operators.joins import engine_match
from flightlake.operators.latest import latest_per_key, prediction_rows
from flightlake.operators.model import SCORING_COLUMNS, DelayModel
from flightlake.operators.tables import existing
from flightlake.session import folders, remove, scratch_dir
from flightlake.sources.loads import file_path
from flightlake.sources.writers import event_day

# How often a job checkpoints and how often the route file is reloaded.
CHECKPOINT_EVERY = "10 seconds"
REFRESH_EVERY = "3600 seconds"

MESSAGE_COLUMNS = ["UUID", "Prediction", "Origin", "Dest", "Carrier", "DepDelay", "Timestamp"]

Trigger = dict[str, object]
DRAIN: Trigger = {"availableNow": True}
POLL: Trigger = {"processingTime": CHECKPOINT_EVERY}


def drain(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself; its failure is raised here."""
    query.awaitTermination()


def run_until(query: StreamingQuery, done: Callable[[], bool], seconds: float = 300.0) -> None:
    """Let a query go on until ``done`` or the time is over, then stop it; its failure is raised here."""
    until = time.monotonic() + seconds
    try:
        while not done():
            if time.monotonic() > until:
                raise TimeoutError(f"not done after {seconds} seconds")
            query.awaitTermination(0.2)
    finally:
        query.stop()


def score_lines(lines: DataFrame, model: DelayModel) -> DataFrame:
    """Request messages to prediction messages; the same for batch and stream.

    A broken line is scored on defaults and answered without an id.
    """
    parsed = messages.parse_messages(lines, schemas.REQUEST)
    # Defaults are for the model only: the answer echoes what was sent.
    echoed = [c for c in MESSAGE_COLUMNS if c != "Prediction"]
    sent = parsed.withColumn("_sent", F.struct(*echoed))
    scored = model.transform(defaults.fill_by_field(sent))
    return messages.emit_json(scored.select("_sent.*", "Prediction"), MESSAGE_COLUMNS)


def score_typed(lines: DataFrame, forest: PipelineModel) -> DataFrame:
    """The typed variant: no stand-ins, category codes as the message brings them.

    What is missing goes into the model as NaN; the time is echoed as a real
    timestamp, to the millisecond.
    """
    parsed = messages.parse_messages(lines, schemas.REQUEST_TYPED).withColumn("Route", route_or_null())
    coded = parsed.withColumns({f"{c}_code": F.col(f"{c}_index") for c in schemas.CATEGORICAL})
    unused = ["Prediction", *[f"{c}_index" for c in schemas.CATEGORICAL]]
    scored = forest.transform(coded.drop(*unused)).withColumnRenamed("prediction", "Prediction")
    return messages.emit_json(scored.drop(*SCORING_COLUMNS), MESSAGE_COLUMNS)


def score_or_reject(lines: DataFrame, model: DelayModel) -> tuple[DataFrame, DataFrame]:
    """(prediction messages, rejected lines) of one micro-batch under the second policy."""
    good, bad = defaults.split_failed(defaults.fill_or_fail(messages.value_to_string(lines)))
    scored = model.transform(good).withColumn("Prediction", F.col("Prediction").cast("double"))
    echoed = scored.select(
        "Prediction", "DepDelay",
        *[F.col(f"echo_{c}").alias(c) for c in defaults.PASS_THROUGH],
    )
    return messages.emit_json(echoed, MESSAGE_COLUMNS, keep_nulls=True), bad


def start_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "text", trigger: Trigger = DRAIN, **by) -> StreamingQuery:
    """Append a stream to files; restarted from its checkpoint it neither loses nor repeats rows."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if by.get("partition_by"):
        writer = writer.partitionBy(by["partition_by"])
    if by.get("compression"):
        writer = writer.option("compression", by["compression"])
    return writer.trigger(**trigger).start(path)


def start_kafka(df: DataFrame, topic: str, servers: str, checkpoint: str, trigger: Trigger = POLL) -> StreamingQuery:
    """Publish the ``value`` column to a broker topic (needs the broker connector)."""
    return (
        df.select("value").writeStream.format("kafka").outputMode("append")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def start_console(df: DataFrame, trigger: Trigger = POLL, rows: int = 20, counts: str | None = None) -> StreamingQuery:
    """Print the first rows of every micro-batch for debugging.

    Only those rows reach the driver.  With ``counts`` the number of messages
    of each micro-batch is stored there.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.limit(rows).show(rows)
        if counts:
            write_batch(batch.agg(F.count(F.lit(1)).alias("messages")), counts, batch_id)

    return start_batches(df, handle, scratch_dir(df.sparkSession, "console"), trigger)


def start_memory(df: DataFrame, name: str, trigger: Trigger = DRAIN) -> StreamingQuery:
    """The debug sink tests can read back as a table; for small streams only."""
    writer = df.writeStream.format("memory").queryName(name).outputMode("append")
    state = scratch_dir(df.sparkSession, "memory")
    return writer.option("checkpointLocation", state).trigger(**trigger).start()


def start_batches(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, trigger: Trigger = DRAIN
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` per micro-batch; it must tolerate a replay of the same id."""
    return (
        df.writeStream.foreachBatch(handle).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Store one micro-batch as a partition of its own; a replay rewrites it."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All stored micro-batches, with their ``batch_id``."""
    with_id = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(with_id).parquet(path)


def start_rejecting(lines: DataFrame, model: DelayModel, good_path: str, bad_path: str, checkpoint: str, trigger: Trigger = DRAIN) -> StreamingQuery:
    """Score what parses, store what does not: one read of the batch, two sinks."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good, bad = score_or_reject(batch, model)
            write_batch(good, good_path, batch_id)
            write_batch(bad, bad_path, batch_id)
        finally:
            batch.unpersist()

    return start_batches(lines, handle, checkpoint, trigger)


def start_fanout(df: DataFrame, sinks: list[Callable[[DataFrame, int], None]], checkpoint: str, trigger: Trigger = DRAIN) -> StreamingQuery:
    """One stream to several sinks, computed once per micro-batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return start_batches(df, handle, checkpoint, trigger)


def start_upsert(df: DataFrame, path: str, checkpoint: str, trigger: Trigger = DRAIN) -> StreamingQuery:
    """Append each micro-batch to a table that is read newest-row-per-key."""
    return start_batches(df, lambda batch, n: write_batch(batch, path, n), checkpoint, trigger)


def _base(path: str) -> str:
    return f"{path.rstrip('/')}-base"


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, int]:
    """(rows of the newest compacted table and of later micro-batches, last compacted batch)."""
    rows = read_batches(spark, path, schema)
    base = existing(spark, _base(path))
    upto = base.agg(F.max("upto")).first()[0] if base is not None else None
    if upto is None:
        return rows, -1
    with_id = T.StructType([*schema.fields, T.StructField("upto", T.LongType())])
    kept = spark.read.schema(with_id).parquet(_base(path)).filter(F.col("upto") == upto)
    later = rows.filter(F.col("batch_id") > upto)
    return kept.withColumnRenamed("upto", "batch_id").unionByName(later), upto


def newest(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: list[str]) -> DataFrame:
    """The upserted table: per key the row of the last micro-batch, within one the last by ``order``.

    Reads the newest compacted table and only the micro-batches after it.
    """
    return latest_per_key(_stored(spark, path, schema)[0], keys, ["batch_id", *order]).drop("batch_id")


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: list[str]) -> int:
    """Store one row per key up to the last micro-batch; readers go on from there.

    Returns that micro-batch.  A compaction that was cut short left no complete
    table under its number and is written again.
    """
    rows, done = _stored(spark, path, schema)
    last = rows.agg(F.max("batch_id")).first()[0]
    if last is None or last == done:
        return done
    kept = latest_per_key(rows.filter(F.col("batch_id") <= last), keys, ["batch_id", *order]).drop("batch_id")
    dated = kept.withColumn("upto", F.lit(last).cast("bigint")).write.mode("overwrite")
    dated.option("partitionOverwriteMode", "dynamic").partitionBy("upto").parquet(_base(path))
    return last


def tidy(spark: SparkSession, path: str) -> int:
    """Remove what readers no longer need after compactions; returns the number of folders removed.

    The newest compacted table and the one before it stay, and so do the micro-batches
    after that one, for readers that began before the newest was there.
    """
    tables = sorted(int(f.removeprefix("upto=")) for f in folders(spark, _base(path)) if f.startswith("upto="))
    if len(tables) < 2:
        return 0
    gone = [f"{_base(path)}/upto={n}" for n in tables[:-2]]
    batches = [int(f.removeprefix("batch_id=")) for f in folders(spark, path) if f.startswith("batch_id=")]
    gone += [f"{path}/batch_id={n}" for n in batches if n <= tables[-2]]
    for folder in gone:
        remove(spark, folder)
    return len(gone)


# When a message arrived inside its micro-batch: file and line of a folder topic.
ARRIVAL = (
    T.StructType().add("arrived", T.TimestampType()).add("file", T.StringType())
    .add("block", T.LongType()).add("line", T.LongType())
)


def _placed(lines: DataFrame) -> DataFrame:
    """A folder topic's messages with the file they came in."""
    found = F.col("_metadata.file_modification_time").alias("arrived")
    return lines.select("value", found, file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"))


def start_placed(lines: DataFrame, rows: Callable[..., DataFrame], path: str, checkpoint: str, trigger: Trigger = DRAIN) -> StreamingQuery:
    """Store ``rows(messages, *arrival columns)`` of every micro-batch with the messages' arrival."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("line", F.monotonically_increasing_id())
        write_batch(rows(numbered, *ARRIVAL.fieldNames()), path, batch_id)

    return start_batches(_placed(lines), handle, checkpoint, trigger)


def _with_arrival(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *ARRIVAL.fields])


def stored_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Keyed prediction table from the stored messages of a result topic: the last that arrived."""
    arrival = ARRIVAL.fieldNames()
    return newest(spark, path, _with_arrival(schemas.STORED_PREDICTION), ["uuid"], arrival).drop(*arrival)


def compact_predictions(spark: SparkSession, path: str) -> int:
    return compact(spark, path, _with_arrival(schemas.STORED_PREDICTION), ["uuid"], ARRIVAL.fieldNames())


def start_storing(lines: DataFrame, path: str, checkpoint: str, trigger: Trigger = DRAIN) -> StreamingQuery:
    """Store a result topic; :func:`stored_predictions` reads it one row per id."""
    return start_placed(lines, prediction_rows, path, checkpoint, trigger)


_ANSWER = T.StructType().add("UUID", T.StringType()).add("Prediction", T.DoubleType())


def start_answers(lines: DataFrame, path: str, checkpoint: str, trigger: Trigger = DRAIN) -> StreamingQuery:
    """Store one engine's answers; nothing waits and nothing is late."""

    def answers(batch: DataFrame, *keep: str) -> DataFrame:
        parsed = batch.select(F.from_json("value", _ANSWER).alias("d"), *keep)
        return parsed.select("d.*", *keep).filter("UUID is not null")

    return start_placed(lines, answers, path, checkpoint, trigger)


def matched_answers(spark: SparkSession, first: str, second: str) -> DataFrame:
    """Both engines' last answers side by side, of everything stored so far.

    An answer that comes late replaces or completes its row at the next read.
    """
    order = ["batch_id", *ARRIVAL.fieldNames()]
    sides = [_stored(spark, path, _with_arrival(_ANSWER))[0] for path in (first, second)]
    return engine_match(*sides, order)


def index_rows(requests: DataFrame, predictions: DataFrame) -> DataFrame:
    """Both topics' messages as dated log rows; without a readable time, now counts."""
    asked = messages.parse_messages(requests, schemas.REQUEST)
    answered = messages.parse_messages(predictions, schemas.PREDICTION)
    ts = F.coalesce(parse_any(F.col("Timestamp")), F.current_timestamp())
    return (
        union_topics(asked, answered)
        .withColumn("log_type", F.lit("flight_prediction"))
        .withColumn("event_ts", ts)
        .withColumn("event_date", event_day(F.col("event_ts")))
    )


def start_daily(rows: DataFrame, path: str, checkpoint: str, trigger: Trigger = DRAIN) -> StreamingQuery:
    """Store log rows by micro-batch and day; a day's rows share files, as in the batch twin."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        dated = batch.hint("rebalance", "event_date").write.mode("overwrite")
        dated.partitionBy("event_date").parquet(f"{path}/batch_id={batch_id}")

    return start_batches(rows, handle, checkpoint, trigger)


def _routes(spark: SparkSession, feed: str) -> DataFrame:
    """The routes of all route files, also of those that changed under the same name.

    Of several lines for a route the one in the newest file counts, then the last.
    """
    placed = _placed(spark.read.text(feed)).withColumn("line", F.monotonically_increasing_id())
    arrival = ARRIVAL.fieldNames()
    parsed = placed.select(F.from_json("value", schemas.DISTANCE).alias("d"), *arrival).select("d.*", *arrival)
    return latest_per_key(parsed.na.drop("any"), ["Origin", "Dest"], arrival).drop(*arrival)


def reload_distances(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """Read all route files anew; the table is replaced in place."""
    routes = _routes(spark, feed)
    routes.write.mode("overwrite").parquet(path)
    return spark.read.schema(routes.schema).parquet(path)


def reload_versioned(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """The same into a table of versions: readers are not disturbed, a failed reload changes nothing."""
    return versions.replace(_routes(spark, feed), path)


def start_refresh(
    spark: SparkSession, feed: str, path: str, checkpoint: str, trigger: Trigger | None = None, versioned: bool = False
) -> StreamingQuery:
    """Reload the route distances at every trigger, by default once an hour."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", "1").load()
    load = reload_versioned if versioned else reload_distances
    reload = lambda _ticks, _batch_id: load(spark, feed, path)
    return start_batches(ticks, reload, checkpoint, trigger or {"processingTime": REFRESH_EVERY})
