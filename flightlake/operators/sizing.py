"""Decisions that rest on a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is sent to every executor only below both limits.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024


def is_small(side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a frame is within the limits; one pass that returns two numbers."""
    width = F.octet_length(F.to_json(F.struct("*")))
    rows, size = side.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint ``side`` for broadcast when a measuring pass proves it small.

    Beyond the limits the frame comes back unhinted and the join is Spark's
    sort-merge join with adaptive skew splitting.  The side is read once for
    this, so give it a table, not an expensive query.
    """
    return F.broadcast(side) if is_small(side, max_rows, max_bytes) else side


_HASH_CELLS = 1 << 40


def sample_rows(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """About ``rows`` rows, at most twice as many, chosen by a hash of ``columns``.

    The same rows in every run.  The share is fixed before rows are read, so
    what reaches one task or the driver does not grow with the number of tasks
    (a plain ordered limit sends ``rows`` rows from each).
    """
    share = min(1.0, rows / max(1, df.count()))
    place = F.pmod(F.xxhash64(*columns), F.lit(_HASH_CELLS))
    return df.filter(place <= int(share * _HASH_CELLS)).orderBy(place, *columns).limit(2 * rows)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when the input has fewer pieces than cores.

    That is the case for a small file, whose one row group a single task reads.
    A large table has more pieces than cores and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
