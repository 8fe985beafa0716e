"""Two engines' answers matched as they arrive.

A stream-stream full outer join holds an answer in state until its partner comes or
the watermark has passed it by ``wait``; then it comes out alone, and the state is
free.  An answer older than the watermark finds no state any more and would be lost.
So each topic is read a second time by a query that keeps such answers in a store of
their own.  Readers merge both: per id and engine the last answer that arrived.

Which answers the join drops depends on how it cuts its micro-batches.  The second
query therefore keeps every answer that is ``wait`` older than what any earlier or
equally old file held: all that the join may drop, and some that it does not, which
changes nothing, as readers take one answer per id and engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flightlake.functions.clocks import parse_any
from flightlake.operators.tables import existing
from flightlake.session import settings
from flightlake.streaming import jobs

# Fixed value: how long an answer waits for that of the other engine.
WAIT = "10 minutes"

# Answers that wait are on the executors' disks, however many; this is what each executor
# holds of them in memory.  As rows of its heap they would not fit.
STATE_MB = 500
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": str(STATE_MB),
    # A micro-batch saves what it changed, not all that waits.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One store per partition instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

_MESSAGE = T.StructType().add("UUID", T.StringType()).add("Prediction", T.DoubleType()).add("Timestamp", T.StringType())
_ANSWER = "UUID string, at timestamp, Prediction double, arrival struct<arrived: timestamp, file: string, block: bigint, at: timestamp>"


def _answers(lines: DataFrame) -> DataFrame:
    """Answers with their own time (that of their file if it cannot be read) and their arrival."""
    parsed = jobs._placed(lines).select(F.from_json("value", _MESSAGE).alias("d"), "arrived", "file", "block")
    timed = parsed.where("d.UUID is not null").withColumn("at", F.coalesce(parse_any(F.col("d.Timestamp")), F.col("arrived")))
    return timed.select("d.UUID", "at", "d.Prediction", F.struct("arrived", "file", "block", "at").alias("arrival"))


def matched(first: DataFrame, second: DataFrame, wait: str = WAIT) -> DataFrame:
    """The join of two answer streams: (UUID, first, second), one of them null in answers without a partner."""

    def side(answers: DataFrame, name: str) -> DataFrame:
        answer = F.struct("Prediction", "arrival").alias(name)
        return answers.withWatermark("at", wait).select(F.col("UUID").alias(f"{name}_id"), F.col("at").alias(f"{name}_at"), answer)

    near = F.expr(f"second_at BETWEEN first_at - INTERVAL {wait} AND first_at + INTERVAL {wait}")
    both = side(first, "first").join(side(second, "second"), (F.col("first_id") == F.col("second_id")) & near, "full_outer")
    return both.select(F.coalesce("first_id", "second_id").alias("UUID"), "first", "second")


def start_matching(
    first: DataFrame, second: DataFrame, path: str, checkpoint: str, wait: str = WAIT, trigger: jobs.Trigger = jobs.DRAIN
) -> list[StreamingQuery]:
    """Match two topics' messages into the store at ``path``; late answers go beside it."""
    joined = matched(_answers(first), _answers(second), wait)
    with settings(first.sparkSession, STATE):
        queries = [jobs.start_batches(joined, lambda batch, n: jobs.write_batch(batch, f"{path}/matched", n), f"{checkpoint}/matched", trigger)]
    for name, lines in (("first", first), ("second", second)):
        queries.append(_start_late(_answers(lines), f"{path}/late-{name}", f"{path}/clock-{name}", f"{checkpoint}/late-{name}", wait, trigger))
    return queries


def _start_late(answers: DataFrame, path: str, clock: str, checkpoint: str, wait: str, trigger: jobs.Trigger) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            # one row per file of the micro-batch
            tops = batch.groupBy("arrival.file", "arrival.arrived").agg(F.max("at").alias("top"))
            jobs.write_batch(tops, clock, batch_id)
            seen = existing(batch.sparkSession, clock)
            earlier = seen.where(F.col("batch_id") < batch_id).agg(F.max("top")).first()[0]
            by_time = W.orderBy(F.unix_micros("arrived"))
            same = F.count(F.lit(1)).over(W.partitionBy("arrived"))
            so_far = F.max("top").over(by_time.rangeBetween(W.unboundedPreceding, 0))
            before = F.max("top").over(by_time.rangeBetween(W.unboundedPreceding, -1))
            top = F.greatest(F.when(same > 1, so_far).otherwise(before), F.lit(earlier).cast("timestamp"))
            bounds = tops.select(F.col("file").alias("_file"), (top - F.expr(f"INTERVAL {wait}")).alias("_bound"))
            late = batch.join(bounds, F.col("arrival.file") == F.col("_file")).where(F.col("at") < F.col("_bound"))
            jobs.write_batch(late.select("UUID", "at", "Prediction", "arrival"), path, batch_id)
        finally:
            batch.unpersist()

    return jobs.start_batches(answers, handle, checkpoint, trigger)


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    """Both engines' last answers side by side: those that came out of the join and late ones.

    Answers that still wait in the join's state are not there yet.
    """
    one = "struct<Prediction: double, arrival: struct<arrived: timestamp, file: string, block: bigint, at: timestamp>>"
    joined = spark.read.schema(f"UUID string, first {one}, second {one}").parquet(f"{path}/matched")
    sides = [joined.where(F.col(name).isNotNull()).select("UUID", F.lit(name).alias("engine"), f"{name}.*") for name in ("first", "second")]
    for name in ("first", "second"):
        if existing(spark, f"{path}/late-{name}") is not None:
            late = spark.read.schema(_ANSWER).parquet(f"{path}/late-{name}")
            sides.append(late.select("UUID", F.lit(name).alias("engine"), "Prediction", "arrival"))
    every = sides[0]
    for side in sides[1:]:
        every = every.unionByName(side)

    def last(name: str) -> Column:
        order = F.when(F.col("engine") == name, F.struct("arrival", "Prediction"))
        return F.max_by("Prediction", order).alias(f"{name}_prediction")

    return every.groupBy("UUID").agg(last("first"), last("second"))
