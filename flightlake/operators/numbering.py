"""Row numbers over a whole table without one task holding it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flightlake.session import materialize

# monotonically_increasing_id puts the task's number above this bit and the
# row's position inside the task below it.
_TASK_SHIFT = 33


def number_rows(df: DataFrame, order: list[str | Column], name: str = "row_no", unique: bool = False) -> DataFrame:
    """Add the 1-based position of each row in the total order ``order``.

    The rows are range-partitioned and sorted, so every task holds one bounded
    slice and a row's position in it is known as it is written; the slice sizes
    (one row per slice) then give each slice its start.  No window, and one
    shuffle.

    Rows that tie on the order are told apart by their place in a first written
    copy.  So a value with very many rows still spreads over slices, and a task
    repeated after the loss of an executor meets the same rows in the same slices.
    Where the order is ``unique`` (no ties), that copy is not needed.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    if unique:
        ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    else:
        stable = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), "unnumbered")
        ranged = stable.repartitionByRange(*keys, F.col("_tie")).sortWithinPartitions(*keys, F.col("_tie"))
    placed = materialize(ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    within = F.lit((1 << _TASK_SHIFT) - 1)
    sliced = placed.select(
        *df.columns,
        F.shiftrightunsigned("_at", _TASK_SHIFT).alias("_slice"),
        F.col("_at").bitwiseAND(within).alias("_pos"),
    )
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        # One row per slice: this window and the broadcast hold at most as many
        # rows as there were shuffle partitions.
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        sliced.join(F.broadcast(starts), "_slice")
        .withColumn(name, F.col("_start") + F.col("_pos") + 1)
        .select(*df.columns, name)
    )
