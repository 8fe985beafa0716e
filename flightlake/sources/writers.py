"""Outputs: tables, topics, daily partitions and insert batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.clocks import DAY_PATTERN
from flightlake.operators.numbering import number_rows

# Rows per insert batch, and the statement texts.
BATCH_ROWS = 100
INSERT_TEXT = "INSERT INTO origin_dest_distances(origin, dest, distance) VALUES ('%s', '%s', %s);\n"
BATCH_OPEN = "BEGIN BATCH\n"
BATCH_CLOSE = "\nAPPLY BATCH;"


def replace_table(df: DataFrame, target: str) -> DataFrame:
    """Create or replace a Parquet table (by path or catalog name); returns it as read back."""
    spark = df.sparkSession
    if "/" in target:
        df.write.mode("overwrite").parquet(target)
        return spark.read.schema(df.schema).parquet(target)
    df.write.mode("overwrite").format("parquet").saveAsTable(target)
    return spark.table(target)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a Parquet table."""
    df.write.mode("append").parquet(path)


def write_topic(messages: DataFrame, topic: str, fmt: str = "text", **options: str) -> None:
    """Publish the ``value`` column to a topic (a broker or a folder of files)."""
    rows = messages.select("value")
    if fmt == "kafka":
        rows.write.format("kafka").options(**{**options, "topic": topic}).save()
    else:
        rows.write.mode("append").format(fmt).options(**options).save(topic)


def dump_json(df: DataFrame, path: str) -> None:
    """A result set as JSON lines, one document per row, written by all tasks."""
    df.write.mode("overwrite").json(path)


def event_day(ts: Column) -> Column:
    """The name of the day partition, in UTC."""
    return F.date_format(ts, DAY_PATTERN)


def write_daily(df: DataFrame, ts: str, path: str) -> None:
    """Partition by event day; rows of a busy day are spread over several files
    and quiet days share a task, sized at run time."""
    dated = df.withColumn("event_date", event_day(F.col(ts)))
    dated.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(path)


def write_indexed(df: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Write sorted by key ranges, so a key lookup skips all but a few row groups."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, keys: list[str], buckets: int, name: str, path: str) -> DataFrame:
    """Write as a catalog table in ``buckets`` hash buckets of ``keys``, sorted inside.

    Tables with equal numbers of buckets of equal keys are joined on these without a
    shuffle on either side.  The rows are dealt by the same hash first, so a bucket is
    one file; keep key values with very many rows out of such a table.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def in_batches(rows: DataFrame, order: list[str], size: int = BATCH_ROWS, unique: bool = False) -> DataFrame:
    """Add ``batch_no``: exactly ``size`` rows each in the given order, the last one the rest."""
    numbered = number_rows(rows, order, unique=unique)
    return numbered.withColumn("batch_no", F.floor((F.col("row_no") - 1) / size))


def insert_statement(origin: Column, dest: Column, distance: Column) -> Column:
    """The text of one insert."""
    return F.format_string(INSERT_TEXT, origin, dest, distance.cast("string"))


def insert_batches(distances: DataFrame, size: int = BATCH_ROWS) -> DataFrame:
    """Display text of the insert batches: one row per batch of ``size`` statements."""
    statement = insert_statement(F.col("Origin"), F.col("Dest"), F.col("Distance"))
    batched = in_batches(distances, ["Origin", "Dest"], size).withColumn("statement", statement)
    ordered = F.sort_array(F.collect_list(F.struct("row_no", "statement")))
    body = F.concat_ws("", F.transform(ordered, lambda s: s["statement"]))
    return batched.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n"),
        F.concat(F.lit(BATCH_OPEN), body, F.lit(BATCH_CLOSE)).alias("text"),
    )
