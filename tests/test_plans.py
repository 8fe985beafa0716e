"""What Spark makes of the queries: pushed filters, pruned columns, no needless shuffles."""

import re

import pytest

import __spark_entry__ as spark_entry
from flightlake.operators import serving
from flightlake.plans import views

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("flights") / "t")
    views.flights(spark, SF).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    return spark.read.parquet(path)


def test_lookup_filters_reach_the_scan(stored):
    plan = _plan(serving.flight_lookup(stored, "Brand#1", "1995-01-10", "576"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    for part in ("EqualTo(Carrier,Brand#1)", "EqualTo(FlightDate,1995-01-10)", "EqualTo(FlightNum,576)"):
        assert part in pushed
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_search_pushes_dates_and_numbers(stored):
    plan = _plan(serving.flight_search(stored, {"FlightDate": "1995-01-10", "Carrier": "brand#1"}))
    assert "EqualTo(FlightDate,1995-01-10)" in plan and "Exchange" not in plan


def test_only_needed_columns_and_joins(spark):
    plan = _plan(spark_entry.queries()["flights_by_month"](spark, SF))
    assert set(re.findall(r"ReadSchema: struct<(.*?)>", plan)) == {"l_shipdate:timestamp_ntz"}
    assert "Join" not in plan


def test_line_items_are_shuffled_at_most_once(spark):
    plan = _plan(spark_entry.queries()["training_set"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(l_", plan)) <= 1
    assert "BatchEvalPython" not in plan


def test_without_broadcasts_joins_are_on_keys(spark):
    """Large parts and suppliers: each join is a sort-merge join on its key, none a nested loop."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = _plan(spark_entry.queries()["training_set"](spark, SF))
    finally:
        spark.conf.set(setting, before)
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert set(re.findall(r"Exchange hashpartitioning\((l_\w+?)#", plan)) <= {"l_orderkey", "l_partkey", "l_suppkey"}


def test_a_page_writes_and_ranges_nothing(spark, stored, monkeypatch):
    monkeypatch.setattr(serving, "SLICE_ROWS", 100)
    plan = _plan(serving.flight_search(stored, {}, start=3000))
    assert "rangepartitioning" not in plan and "TakeOrderedAndProject" in plan and "PushedFilters" in plan


def test_messages_are_parsed_once(spark):
    plan = _plan(spark_entry.queries()["fill_defaults_flink"](spark, SF))
    assert plan.count("from_json(") == 1


def test_newest_rows_are_combined_before_the_shuffle(spark):
    plan = _plan(spark_entry.queries()["sink_upsert_distance"](spark, SF))
    assert "partial_max_by" in plan and "Window" not in plan


def test_counts_use_no_python(spark):
    for name in ("g_du", "dual_engine_match", "delay_histogram"):
        assert "Python" not in _plan(spark_entry.queries()[name](spark, SF))


def test_bucketed_sides_are_joined_without_a_shuffle(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = _plan(spark_entry.queries()["distance_lookup_bucketed"](spark, SF))
    finally:
        spark.conf.set(setting, before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
