"""Tables that are replaced as a whole while others read them.

A new version is written beside the old ones and counts from the moment its write is
complete, which the marker file says that Spark leaves at the very end.  A write that
fails leaves the table as it was; a reader goes on with the version it began with, as
the ``KEPT`` newest versions stay.  One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flightlake.session import folders, remove

KEPT = 2


def _versions(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """(complete versions, versions whose write was cut short), rising."""
    numbers = sorted(int(f.removeprefix("version=")) for f in folders(spark, path) if f.startswith("version="))
    whole = [n for n in numbers if "_SUCCESS" in folders(spark, f"{path}/version={n}")]
    return whole, [n for n in numbers if n not in whole]


def replace(df: DataFrame, path: str) -> DataFrame:
    """Make ``df`` the table at ``path``; returns it as read back.  ``df`` may read the table itself."""
    spark = df.sparkSession
    whole, broken = _versions(spark, path)
    for number in broken:
        remove(spark, f"{path}/version={number}")
    number = whole[-1] + 1 if whole else 0
    df.write.mode("overwrite").parquet(f"{path}/version={number}")
    for old in [*whole, number][:-KEPT]:
        remove(spark, f"{path}/version={old}")
    return spark.read.schema(df.schema).parquet(f"{path}/version={number}")


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version, or None when there is none yet."""
    whole, _ = _versions(spark, path)
    return spark.read.parquet(f"{path}/version={whole[-1]}") if whole else None
