"""A log by day: the day comes first in the path, and a day's small files are put together.

Every micro-batch adds a folder to each day it has rows for.  ``compact_day`` writes a
day's rows up to its last micro-batch as few files of a fair size; readers take the
newest such table and the folders after it, so a day is always whole.  What a
compaction has taken in is removed by the next one, when nobody reads it any more.
Reading or compacting a day lists the files of that day only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flightlake.session import folders, remove
from flightlake.streaming import jobs


def start_days(rows: DataFrame, path: str, checkpoint: str, trigger: jobs.Trigger = jobs.DRAIN) -> StreamingQuery:
    """Store log rows by ``event_date`` and micro-batch; a replay rewrites its own folders."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn("batch_id", F.lit(batch_id).cast("long")).hint("rebalance", "event_date")
        writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("event_date", "batch_id").parquet(path)

    return jobs.start_batches(rows, handle, checkpoint, trigger)


def stored_days(spark: SparkSession, path: str) -> list[str]:
    return sorted(name.removeprefix("event_date=") for name in folders(spark, path) if name.startswith("event_date="))


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    return sorted(int(f.removeprefix(f"{name}=")) for f in folders(spark, path) if f.startswith(f"{name}="))


def _complete(spark: SparkSession, path: str, day: str) -> list[int]:
    """Micro-batches up to which the day was put together; a cut-short compaction does not count."""
    base = f"{path}-days/event_date={day}"
    return [n for n in _numbers(spark, base, "upto") if "_SUCCESS" in folders(spark, f"{base}/upto={n}")]


def read_day(spark: SparkSession, path: str, day: str, schema: T.StructType) -> DataFrame:
    """A day's rows: the newest compacted table and the micro-batches after it."""
    done = _complete(spark, path, day)
    later = [n for n in _numbers(spark, f"{path}/event_date={day}", "batch_id") if not done or n > done[-1]]
    parts = [f"{path}-days/event_date={day}/upto={done[-1]}"] if done else []
    parts += [f"{path}/event_date={day}/batch_id={n}" for n in later]
    plain = T.StructType([f for f in schema if f.name not in ("event_date", "batch_id")])
    if not parts:
        return spark.createDataFrame([], plain).withColumn("event_date", F.lit(day))
    return spark.read.schema(plain).parquet(*parts).withColumn("event_date", F.lit(day))


def compact_day(spark: SparkSession, path: str, day: str, schema: T.StructType) -> int:
    """Put a day's files together; returns the last micro-batch taken in, -1 if there is none.

    Files are sized by the bytes that are written.  Folders that the compaction
    before this one took in, and older compacted tables, are removed.
    """
    done = _complete(spark, path, day)
    batches = _numbers(spark, f"{path}/event_date={day}", "batch_id")
    last = max([*batches, *done], default=-1)
    if last < 0 or (done and done[-1] == last):
        return last
    whole = read_day(spark, path, day, schema).drop("event_date")
    whole.hint("rebalance").write.mode("overwrite").parquet(f"{path}-days/event_date={day}/upto={last}")
    for n in done[:-1]:
        remove(spark, f"{path}-days/event_date={day}/upto={n}")
    for n in batches:
        if done and n <= done[-1]:
            remove(spark, f"{path}/event_date={day}/batch_id={n}")
    return last
