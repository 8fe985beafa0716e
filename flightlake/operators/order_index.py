"""A table stored in a total order, from which any page is read directly.

Rows are numbered once (ties by all other columns, then by their place in a written
copy) and stored by position: a folder per ``PART_ROWS`` positions, rows sorted
inside, so that the files' own statistics lead to a page.  A page of the whole table
reads the rows of its positions and nothing else, whatever its offset and however
many rows are equal.  A page of matching rows is found by counting the matches of
each of at most ``RANGES`` ranges of positions in one pass; only the ranges around
the page are counted again in finer steps, until few rows are left to sort.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.numbering import number_rows
from flightlake.operators.serving import SLICE_ROWS, _ordered
from flightlake.operators.tables import existing

PART_ROWS = 1_000_000
RANGES = 4096

_POSITION, _PART = "_position", "_part"


class OrderIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        stored = spark.read.parquet(f"{path}/rows")
        self.rows = stored
        self.columns = [c for c in stored.columns if c not in (_POSITION, _PART)]
        self.total = spark.read.parquet(f"{path}/size").first()["total"]

    @classmethod
    def build(cls, df: DataFrame, order: list[str], path: str) -> OrderIndex:
        """Store ``df`` by ``order``, made total by all other columns, nulls last."""
        numbered = number_rows(df, _ordered(df, order), name=_POSITION)
        placed = numbered.withColumn(_PART, F.expr(f"({_POSITION} - 1) div {PART_ROWS}"))
        placed.sortWithinPartitions(_PART, _POSITION).write.partitionBy(_PART).parquet(f"{path}/rows")
        if existing(df.sparkSession, f"{path}/rows") is None:  # a table without rows still has columns
            placed.write.mode("overwrite").parquet(f"{path}/rows")
        size = df.sparkSession.read.parquet(f"{path}/rows").agg(F.count(F.lit(1)).alias("total"))
        size.write.parquet(f"{path}/size")
        return cls(df.sparkSession, path)

    def _between(self, rows: DataFrame, first: int, last: int) -> DataFrame:
        """Rows of the positions ``first`` to ``last``; the condition reaches folders and files."""
        folder = F.col(_PART).between((first - 1) // PART_ROWS, (last - 1) // PART_ROWS)
        return rows.where(folder & F.col(_POSITION).between(first, last))

    def page(self, start: int, size: int) -> DataFrame:
        """``size`` rows of the whole table from ``start`` on."""
        return self._between(self.rows, start + 1, start + size).orderBy(_POSITION).select(*self.columns)

    def search(self, matches: DataFrame, start: int, size: int) -> tuple[DataFrame, int]:
        """(``size`` rows of ``matches`` from ``start`` on, number of all matches).

        ``matches`` are rows of the index that some condition selects, with all columns.
        """
        first, last, skip, total = 1, max(1, self.total), start, None
        while True:
            width = math.ceil((last - first + 1) / RANGES)
            place = F.expr(f"({_POSITION} - {first}) div {width}")
            found = self._between(matches, first, last).groupBy(place.alias("range")).agg(F.count(F.lit(1)).alias("n")).collect()
            total = sum(r["n"] for r in found) if total is None else total
            before, chosen = 0, []
            for row in sorted(found, key=lambda r: r["range"]):
                if before < skip + size and before + row["n"] > skip:
                    chosen.append((row["range"], before, row["n"]))
                before += row["n"]
            if not chosen or size <= 0:
                return matches.limit(0).select(*self.columns), total
            span = last - first
            last = min(last, first + (chosen[-1][0] + 1) * width - 1)
            first += chosen[0][0] * width
            skip -= chosen[0][1]
            few = sum(n for _, _, n in chosen) <= SLICE_ROWS
            if few or last - first == span:  # a page as large as this cannot be narrowed down further
                page = self._between(matches, first, last).orderBy(_POSITION).offset(skip).limit(size)
                return page.select(*self.columns), total
