"""Queries that aggregate rows for as long as they arrive.

Groups live in state; a micro-batch gives the groups that changed, which are stored
under its id.  A group's row is the one of the last micro-batch that changed it, so a
micro-batch written again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flightlake.streaming import jobs


def start_totals(
    spark: SparkSession,
    sql: str,
    view: str,
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: jobs.Trigger = jobs.DRAIN,
    event_time: str | None = None,
    lateness: str = "0 seconds",
) -> StreamingQuery:
    """Run an aggregating query over ``stream``, known to the text as ``view``.

    With ``event_time`` groups by a window of that column leave the state once they
    are ``lateness`` old, and later rows for them are dropped; without it every group
    stays, which suits groups whose number is bounded.
    """
    rows = stream.withWatermark(event_time, lateness) if event_time else stream
    rows.createOrReplaceTempView(view)
    writer = spark.sql(sql).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(lambda batch, n: jobs.write_batch(batch, path, n)).trigger(**trigger).start()


def read_totals(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The groups as they are now."""
    return jobs.newest(spark, path, schema, list(keys), [])


def compact_totals(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> int:
    """Store one row per group up to the last micro-batch, so readers skip all before."""
    return jobs.compact(spark, path, schema, list(keys), [])
