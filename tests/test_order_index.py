"""Pages of a stored order, and pages cut from slices with many equal rows."""

import re

import pytest
from pyspark.sql import functions as F

from flightlake.operators import order_index, serving
from flightlake.operators.order_index import OrderIndex


def _rows(spark, count=3000):
    hot = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") * 7 % 10).cast("string"))
    return spark.range(count).select(hot.alias("k"), F.when(F.col("id") < 900, 0.5).otherwise(F.col("id") / 7).alias("v")).repartition(5)


def _sorted(df):
    return [(r.k, r.v) for r in sorted(df.collect(), key=lambda r: (r.k is None, r.k or "", r.v))]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(order_index, "PART_ROWS", 700)
        return OrderIndex.build(_rows(spark), ["k"], str(tmp_path_factory.mktemp("index") / "t"))


@pytest.mark.parametrize("start", [0, 699, 1400, 2995, 3000])
def test_any_page_of_the_table(spark, index, monkeypatch, start):
    monkeypatch.setattr(order_index, "PART_ROWS", 700)
    assert index.total == 3000
    assert [tuple(r) for r in index.page(start, 10).collect()] == _sorted(_rows(spark))[start : start + 10]


def test_a_page_reads_its_folder_and_positions(index, monkeypatch):
    monkeypatch.setattr(order_index, "PART_ROWS", 700)
    plan = index.page(1500, 10)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_part", plan) and "GreaterThanOrEqual(_position,1501)" in plan
    assert len(index.page(1500, 10).inputFiles()) > 0 and "offset" not in plan.lower()


@pytest.mark.parametrize("start,size", [(0, 10), (250, 10), (590, 25), (900, 10), (0, 0)])
def test_pages_of_matches(spark, index, monkeypatch, start, size):
    monkeypatch.setattr(order_index, "PART_ROWS", 700)
    monkeypatch.setattr(order_index, "RANGES", 6)
    monkeypatch.setattr(order_index, "SLICE_ROWS", 30)
    matches = index.rows.where("v = 0.5")
    want = _sorted(_rows(spark).where("v = 0.5"))
    shown, total = index.search(matches, start, size)
    assert [tuple(r) for r in shown.collect()] == want[start : start + size] and total == len(want) == 900


def test_an_empty_table_has_an_empty_page(spark, tmp_path):
    index = OrderIndex.build(_rows(spark).limit(0), ["k"], str(tmp_path / "t"))
    assert index.total == 0 and index.page(0, 5).count() == 0 and index.page(0, 5).columns == ["k", "v"]
    shown, total = index.search(index.rows.where("k = '1'"), 0, 5)
    assert (shown.count(), total) == (0, 0)


@pytest.mark.parametrize("start", [0, 150, 395, 800, 1190])
def test_equal_rows_are_never_sorted(spark, monkeypatch, start):
    """A third of the rows are alike: no offset beyond a slice is left in the plan."""
    monkeypatch.setattr(serving, "SLICE_ROWS", 50)
    df = spark.range(1200).select(F.when(F.col("id") % 3 == 0, F.lit(400)).otherwise(F.col("id")).alias("v"), F.lit(None).cast("string").alias("n"))
    want = sorted(400 if i % 3 == 0 else i for i in range(1200))[start : start + 10]
    shown, total = serving.paged(df, ["v"], start, 10)
    assert [r["v"] for r in shown.collect()] == want and total == 1200
    plan = shown._jdf.queryExecution().executedPlan().toString()
    offsets = [int(n) for n in re.findall(r"offset=(\d+)", plan)]
    limits = [int(n) for n in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", plan)]
    assert all(n <= 50 for n in offsets) and all(n <= 60 for n in limits)
