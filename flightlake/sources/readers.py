"""Inputs: files, tables, literal rows and topics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flightlake.schemas import TRAINING


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = TRAINING) -> DataFrame:
    """JSON lines with a declared schema; bz2 files are split across tasks."""
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """All rows of a catalog table, or of a Parquet table given by path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_filtered(spark: SparkSession, path: str, predicate: str, fmt: str = "parquet") -> DataFrame:
    """A table by format with a SQL predicate, which reaches the scan."""
    return spark.read.format(fmt).load(path).filter(predicate)


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """A few rows from the program, with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, without its line end."""
    return spark.read.text(path)


def read_topic(
    spark: SparkSession,
    topic: str,
    fmt: str = "text",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream of one topic's messages, as a ``value`` column.

    ``fmt="kafka"`` subscribes through the broker connector (newest messages
    first time, offsets from the checkpoint later).  Otherwise the topic is a
    folder of message files.
    """
    reader = spark.readStream
    if fmt == "kafka":
        settings = {"startingOffsets": "latest", **options, "subscribe": topic}
        return reader.format("kafka").options(**settings).load()
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    return reader.format(fmt).options(**options).load(topic)


def read_topics(spark: SparkSession, topics: list[str], fmt: str = "text", **options: str) -> DataFrame:
    """Several topics as one stream of messages."""
    if fmt == "kafka":
        return read_topic(spark, ",".join(topics), fmt, **options)
    streams = [read_topic(spark, topic, fmt, **options).select("value") for topic in topics]
    return reduce(DataFrame.unionByName, streams)
