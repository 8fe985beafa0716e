"""Category codes: sorted distinct values numbered from 0, unknown is -1."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.operators.numbering import number_rows
from flightlake.operators.sizing import BROADCAST_BYTES, BROADCAST_ROWS
from flightlake.schemas import CATEGORICAL, NUMERIC
from flightlake.session import materialize

UNKNOWN = -1


def fit_codes(df: DataFrame, columns: list[str] = CATEGORICAL) -> DataFrame:
    """Vocabulary table (column, value, code) of several columns.

    All columns are read in one pass; the distinct values are combined on the
    map side and numbered together, each column from 0.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    )
    values = df.select(cells.alias("cell")).select("cell.*").filter("value is not null").distinct()
    numbered = number_rows(values, ["column", "value"], unique=True)
    # One row per column.
    firsts = numbered.groupBy("column").agg(F.min("row_no").alias("first"))
    codes = numbered.join(F.broadcast(firsts), "column").select(
        "column", "value", (F.col("row_no") - F.col("first")).cast("int").alias("code")
    )
    return materialize(codes, "codes")


def small_columns(codes: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> set[str]:
    """Columns whose own vocabulary is small enough to send to every executor."""
    sizes = codes.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + F.lit(16)).alias("bytes")
    )
    return {r["column"] for r in sizes.collect() if r["n"] <= max_rows and r["bytes"] <= max_bytes}


def apply_codes(df: DataFrame, codes: DataFrame, columns: list[str] = CATEGORICAL, small: set[str] | None = None) -> DataFrame:
    """Add ``<column>_code``; a value outside the vocabulary gets -1.

    Each column's vocabulary is broadcast when it was measured to be small
    (``small`` carries the answer of an earlier measuring), and joined by shuffle
    otherwise; one large vocabulary does not make shuffles of the others.
    """
    df = _with_codes(df, codes, columns, small)
    return df.fillna(UNKNOWN, [f"{c}_code" for c in columns])


def _with_codes(df: DataFrame, codes: DataFrame, columns: list[str], small: set[str] | None) -> DataFrame:
    small = small_columns(codes) if small is None else small
    for column in columns:
        lookup = codes.filter(F.col("column") == column).select(
            F.col("value").alias(column), F.col("code").alias(f"{column}_code")
        )
        df = df.join(F.broadcast(lookup) if column in small else lookup, column, "left")
    return df


def index_columns(df: DataFrame, codes: DataFrame, columns: list[str] = CATEGORICAL) -> DataFrame:
    """Add ``<column>_index`` as a double; missing and unseen values get the number of known ones."""
    known = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    coded = _with_codes(df, codes, columns, None)
    index = {f"{c}_index": F.coalesce(F.col(f"{c}_code"), F.lit(known.get(c, 0))).cast("double") for c in columns}
    return coded.withColumns(index).drop(*[f"{c}_code" for c in columns])


def assembler(inputs: list[str] | None = None, output: str = "Features_vec") -> VectorAssembler:
    """Numeric and code columns as one vector; a missing value stays in as NaN."""
    return VectorAssembler(
        inputCols=inputs or [*NUMERIC, *[f"{c}_code" for c in CATEGORICAL]],
        outputCol=output,
        handleInvalid="keep",
    )
