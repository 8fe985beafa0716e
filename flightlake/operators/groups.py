"""Nested lists per key whose length stays bounded, whatever the key's share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.operators.numbering import number_rows
from flightlake.operators.sizing import broadcast_if_small
from flightlake.session import materialize

LIST_ROWS = 10_000


def bounded_lists(
    df: DataFrame,
    keys: list[str],
    fields: list[str],
    into: str,
    order: list[str | Column] | None = None,
    max_rows: int = LIST_ROWS,
    unique: bool = False,
) -> DataFrame:
    """One row per key and ``Part``, with an ordered array of at most ``max_rows``.

    Keys with at most ``max_rows`` rows are one row, part 0, after one shuffle.
    Only the rows of longer keys are numbered, and cut by their position within
    the key, so a key's parts do not depend on other keys and a key with a third of
    all rows never becomes one array.  All rows are kept.  ``unique`` says that no
    two rows agree on keys and order.
    """
    rows = df.select(*keys, *fields)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > max_rows)
    long = materialize(sizes.select(*[F.col(k).alias(f"_{k}") for k in keys]), "long_keys")
    ordered = [*keys, *(order or fields)]
    if long.isEmpty():
        return _lists(rows.withColumn("Part", F.lit(0).cast("bigint")), keys, fields, into, order or fields)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    side = broadcast_if_small(long)
    short = rows.join(side, same, "left_anti").withColumn("Part", F.lit(0).cast("bigint"))
    numbered = materialize(number_rows(rows.join(side, same, "left_semi"), ordered, unique=unique), "long_rows")
    firsts = numbered.groupBy(*keys).agg(F.min("row_no").alias("_first")).select(*[F.col(k).alias(f"_{k}") for k in keys], "_first")
    placed = numbered.join(broadcast_if_small(firsts), same).withColumn(
        "Part", F.floor((F.col("row_no") - F.col("_first")) / max_rows)
    )
    return _lists(short.unionByName(placed.select(*short.columns)), keys, fields, into, order or fields)


def _lists(rows: DataFrame, keys: list[str], fields: list[str], into: str, order: list[str | Column]) -> DataFrame:
    """Rows of a key and part as one ordered array; nulls last."""
    names = [*[c for c in order if isinstance(c, str)], *[f for f in fields if f not in order]]
    sorters = [x for c in names for x in (F.col(c).isNull(), F.col(c))]
    item = F.struct(*[s.alias(f"_{i}") for i, s in enumerate(sorters)], F.struct(*fields).alias("_row"))
    lists = rows.groupBy(*keys, "Part").agg(F.sort_array(F.collect_list(item)).alias("_items"))
    plain = F.transform("_items", lambda x: x["_row"] if len(fields) > 1 else x["_row"][fields[0]])
    return lists.select(*keys, "Part", plain.alias(into))
