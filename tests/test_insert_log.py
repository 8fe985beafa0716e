"""Insert requests read only the files that may hold their rows."""

import shutil

import pytest
from pyspark.sql import types as T

from flightlake.operators import insert_log, tables
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


def _lines(spark, *values):
    return spark.createDataFrame([(f'{{"k":{v}}}', i + 1) for i, v in enumerate(values)], "value string, line_no bigint").coalesce(1)


def _insert(spark, path, request, *values):
    return tables.insert_rows(_lines(spark, *values), SCHEMA, path, request)


def _held(spark, path, request):
    return insert_log.files_of(tables.existing(spark, path), path, request)


def _ids_in(spark, files):
    return sorted(r[0] for r in spark.read.parquet(*files).select("insert_id").collect())


@pytest.mark.parametrize("folder", ["t", "with a space"])
def test_only_files_of_the_request_are_read(spark, tmp_path, folder):
    path = str(tmp_path / folder)
    for request in ("a", "b", "a_b", "c"):
        _insert(spark, path, request, 1, 2)
    for request in ("a", "b", "a_b", "c"):
        held = _held(spark, path, request)
        assert len(held) == 1 and _ids_in(spark, held) == [f"{request}_1", f"{request}_2"]
    assert _held(spark, path, "new") == []
    # the log is no part of the table
    assert rows(tables.existing(spark, path).groupBy("k").count()) == [(1, 4), (2, 4)]
    assert _insert(spark, path, "a", 1, 2, 3).count() == 9
    assert len(_held(spark, path, "a")) == 2


def test_files_the_log_does_not_know_are_read(spark, tmp_path):
    """As after a request that stored its rows and ended before anything else, or after another writer."""
    path = str(tmp_path / "t")
    _insert(spark, path, "a", 1)
    _held(spark, path, "a")
    rest = spark.createDataFrame([(7, "late_1"), (8, None), (9, "free")], "k int, insert_id string")
    rest.coalesce(1).write.mode("append").parquet(path)
    assert rows(_insert(spark, path, "late", 5, 6), "k", "insert_id") == sorted(
        [(1, "a_1"), (7, "late_1"), (8, None), (9, "free"), (6, "late_2")], key=str
    )


def test_a_log_that_is_lost_or_stale_is_made_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    for request in ("a", "b", "c"):
        _insert(spark, path, request, 1)
    _held(spark, path, "a")
    shutil.rmtree(f"{path}/_requests")
    assert _insert(spark, path, "a", 1).count() == 3
    # all files replaced by one, in place: the log goes with the folder
    table = tables.existing(spark, path)
    other = str(tmp_path / "u")
    table.coalesce(1).write.parquet(other)
    shutil.copytree(f"{path}/_requests", f"{other}/_requests")
    assert _insert(spark, other, "b", 1).count() == 3
    assert len(_held(spark, other, "b")) == 1


def test_empty_request_and_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        assert tables.insert_rows(_lines(spark, 1).limit(0), SCHEMA, path, "a").count() == 0
    assert _insert(spark, path, "a", 1).count() == 1
    assert _insert(spark, path, "a", 1).count() == 1
