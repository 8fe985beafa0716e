"""Views refreshed by the files that came and went."""

import os

import pytest
from pyspark.sql import functions as F

from flightlake.operators.incremental import IncrementalView
from flightlake.session import remove
from tests.conftest import rows

AGGREGATES = {"n": ("count", "v"), "s": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v"), "mid": ("avg", "v")}


def _add(spark, table, part, values):
    spark.createDataFrame(values, "k string, v int").repartition(2).write.parquet(f"{table}/part={part}")


def _again(spark, table, keys=("k",)):
    df = spark.read.parquet(table)
    return rows(df.groupBy(*keys).agg(F.count("v"), F.sum("v"), F.min("v"), F.max("v"), F.avg("v")))


def test_refresh_equals_the_recompute(spark, tmp_path):
    table, path = str(tmp_path / "a table"), str(tmp_path / "view")
    view = IncrementalView(table, path, ["k"], AGGREGATES, grace=100)
    with pytest.raises(ValueError):
        view.refresh(spark, 0.0)
    _add(spark, table, 0, [("a", 1), ("a", 5), (None, 2), ("b", None)])
    first = view.refresh(spark, 1.0)
    assert (first.version, first.removed) == (0, 0) and first.added > 0 and rows(view.read(spark, 1.0)) == _again(spark, table)
    _add(spark, table, 1, [("a", -7), (None, 9), ("c", 3), ("c", 4)])
    second = view.refresh(spark, 60.0)
    assert 1 <= second.added <= 2 and rows(view.read(spark, 60.0)) == _again(spark, table)
    # the files with the least value and with all rows of a group go
    remove(spark, f"{table}/part=1")
    _add(spark, table, 2, [("d", 1), ("a", 100)])
    third = view.refresh(spark, 120.0)
    assert third.removed == second.added and rows(view.read(spark, 120.0)) == _again(spark, table)
    assert "c" not in {r[0] for r in _again(spark, table)}
    # nothing changed: no version is written
    assert view.refresh(spark, 130.0) == (2, 0, 0)
    # version 0 was replaced more than 100 seconds ago, version 1 was not
    view.refresh(spark, 161.0)
    _add(spark, table, 3, [("e", 1)])
    assert view.refresh(spark, 165.0).version == 3
    assert {n for n in os.listdir(path) if n.startswith("groups")} == {"groups-1", "groups-2", "groups-3"}


def test_only_new_files_are_read(spark, tmp_path):
    table, path = str(tmp_path / "t"), str(tmp_path / "view")
    view = IncrementalView(table, path, ["k"], AGGREGATES)
    _add(spark, table, 0, [("a", 1), ("b", 2)])
    view.refresh(spark, 1.0)
    for name in os.listdir(f"{table}/part=0"):  # an old file that was read again would fail
        if name.endswith(".parquet"):
            (tmp_path / "t" / "part=0" / name).write_bytes(b"no parquet")
            crc = tmp_path / "t" / "part=0" / f".{name}.crc"
            if crc.exists():
                crc.unlink()
    more = spark.createDataFrame([("a", 3)], "k string, v int")
    more.coalesce(1).write.parquet(f"{table}/part=1")
    with pytest.MonkeyPatch.context() as patch:
        # the schema comes from the new part, as the old one is no longer readable
        from flightlake.operators import incremental

        schema = spark.read.option("basePath", table).parquet(f"{table}/part=1").schema
        patch.setattr(incremental, "existing", lambda s, p: s.read.schema(schema).parquet(p) if p == table else s.read.parquet(p))
        assert view.refresh(spark, 2.0).added == 1
        assert rows(view.read(spark, 2.0), "k", "s") == [("a", 4), ("b", 2)]


def test_a_failed_refresh_leaves_the_old_groups(spark, tmp_path, monkeypatch):
    table, path = str(tmp_path / "t"), str(tmp_path / "view")
    view = IncrementalView(table, path, [], AGGREGATES, max_staleness=1000)
    _add(spark, table, 0, [("a", 1), ("b", 2)])
    view.refresh(spark, 1.0)
    _add(spark, table, 1, [("a", 10)])
    monkeypatch.setattr(IncrementalView, "_write_log", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        view.refresh(spark, 2.0)
    monkeypatch.undo()
    assert rows(view.read(spark, 3.0), "n", "s") == [(2, 3)]
    remove(spark, f"{table}/part=1")
    assert view.refresh(spark, 4.0) == (0, 0, 0)
    _add(spark, table, 2, [("z", 5)])
    remove(spark, f"{table}/part=0")
    view.refresh(spark, 5.0)
    assert rows(view.read(spark, 5.0), "n", "s", "low") == [(1, 5, 5)]
