"""Tables replaced while they are read."""

import os

import pytest
from pyspark.sql import functions as F

from flightlake.operators import versions
from flightlake.streaming import jobs
from tests.conftest import rows


def test_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.current(spark, path) is None
    versions.replace(spark.range(3), path)
    reading = versions.current(spark, path)
    versions.replace(versions.current(spark, path).where("id > 0"), path)  # from itself
    assert rows(reading) == [(0,), (1,), (2,)] and rows(versions.current(spark, path)) == [(1,), (2,)]
    versions.replace(spark.range(1), path)
    assert sorted(os.listdir(path)) == ["version=1", "version=2"]


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark.range(3), path)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        versions.replace(broken, path)
    os.makedirs(f"{path}/version=1", exist_ok=True)  # what a lost driver leaves
    assert versions.current(spark, path).count() == 3
    versions.replace(spark.range(7), path)
    assert versions.current(spark, path).count() == 7


def test_routes_are_replaced_at_every_trigger(spark, tmp_path):
    feed, table, state = (str(tmp_path / n) for n in ("feed", "table", "state"))
    for n in (5, 6):
        spark.createDataFrame([(f'{{"Origin":"A","Dest":"B","Distance":{n}}}',)], "value string").write.mode("append").text(feed)
        jobs.drain(jobs.start_refresh(spark, feed, table, f"{state}-{n}", {"once": True}, versioned=True))
    assert rows(versions.current(spark, table)) == [("A", "B", 6.0)] and len(os.listdir(table)) == 2
