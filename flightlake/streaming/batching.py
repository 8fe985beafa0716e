"""Insert batches of a stream: full ones at once, a short one when it has waited long enough.

Rows of a bin wait in keyed state, at most one batch short of full.  A timer set by
the first of them releases the rest after ``wait``, also when nothing else arrives.
Bins are independent: take a key with many values to spread the work.

A micro-batch that is repeated gives the same batches: rows of a bin are taken in
the order of their arrival and text, and the clock of a micro-batch is stored with
its offsets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flightlake.sources.writers import BATCH_CLOSE, BATCH_OPEN, BATCH_ROWS
from flightlake.streaming import jobs

# Fixed value: how long a short batch is held.
MAX_AGE_MS = 30_000

_STATE = "rows array<string>, since bigint, made bigint"
_BATCH = "bin string, batch_no bigint, released boolean, rows array<string>"


def _binner(size: int, max_age_ms: int):
    def collect(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, since, made = ([], 0, 0) if not state.exists else state.get
        held = list(held)
        now = state.getCurrentProcessingTimeMs()
        batches: list[tuple[Any, ...]] = []
        if state.hasTimedOut:
            batches.append((key[0], made, True, held))
            held, made = [], made + 1
        else:
            arrived = pd.concat(list(frames)).sort_values(["arrived", "row"], kind="stable")["row"]
            if not held:
                since = now
            for row in arrived:
                held.append(row)
                if len(held) == size:
                    batches.append((key[0], made, False, held))
                    held, made, since = [], made + 1, now
        state.update((held, since, made))
        if held:
            state.setTimeoutDuration(max(1, since + max_age_ms - now))
        yield pd.DataFrame(batches, columns=["bin", "batch_no", "released", "rows"])

    return collect


def binned(rows: DataFrame, size: int = BATCH_ROWS, max_age_ms: int = MAX_AGE_MS) -> DataFrame:
    """Batches (bin, batch_no, released, rows) of a stream of (bin, row, arrived).

    A batch holds exactly ``size`` rows, or fewer if it was released by its age.
    Numbers run within a bin.
    """
    return rows.groupBy("bin").applyInPandasWithState(
        _binner(size, max_age_ms), _BATCH, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def start_binning(
    lines: DataFrame,
    bin_by: Column,
    statement: Column,
    path: str,
    checkpoint: str,
    size: int = BATCH_ROWS,
    max_age_ms: int = MAX_AGE_MS,
    trigger: jobs.Trigger = jobs.POLL,
) -> StreamingQuery:
    """Store the insert batches of a folder topic's messages.

    ``bin_by`` and ``statement`` are made from the message text ``value``; messages
    without a statement are skipped.
    """
    rows = jobs._placed(lines).select(bin_by.cast("string").alias("bin"), statement.alias("row"), "arrived").where("row is not null")
    return jobs.start_batches(binned(rows, size, max_age_ms), lambda batch, n: jobs.write_batch(batch, path, n), checkpoint, trigger)


def insert_texts(spark: SparkSession, path: str) -> DataFrame:
    """The stored batches as display text."""
    stored = spark.read.schema(_BATCH).parquet(path)
    text = F.concat(F.lit(BATCH_OPEN), F.array_join("rows", ""), F.lit(BATCH_CLOSE))
    return stored.select("bin", "batch_no", "released", F.size("rows").cast("long").alias("n"), text.alias("text"))
