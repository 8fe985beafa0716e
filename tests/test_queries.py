"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as spark_entry
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"

# Lookups of fixed keys, which tables this small need not hold.
LOOKUPS = {"list_flights", "flight_search", "flight_search_deep", "airplane_search"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry_returns_rows(spark):
    assert spark_entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(spark_entry.queries()))
def test_query(spark, con, name):
    frame = spark_entry.queries()[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        problems = differences(con, sql, frame)
        assert [p for p in problems if p != "no rows" or name not in LOOKUPS] == []
