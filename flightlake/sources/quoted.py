"""Records of delimited text whose quoted values hold line breaks, cut by many tasks.

Where a record ends depends on whether a line begins inside quotes, which a task
that starts in the middle of a file cannot know.  So every line gets its effect in
both cases (inside or outside afterwards, if it begins outside or inside); effects
are composed along the lines of each file block for both possible beginnings, then
along the blocks of each file, which are one row each.  That settles how every line
begins and the number of its record in its file.  A record of one line is complete
as it is; only lines of longer records meet by (file, record).

Lines end in ``\\n`` or ``\\r\\n``; inside quotes both stay as they are.  A quote opens
a value only where a field begins, and a doubled quote inside a value is a quote.
Compressed files cannot be read from the middle: each is one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flightlake.operators.sizing import broadcast_if_small
from flightlake.session import materialize

# A longer record means a quote that is never closed.
MOST_RECORD_BYTES = 100 * 1024 * 1024

# What the text before a quote leaves a reader in.
_FIELD_START, _INSIDE, _CLOSED, _PLAIN = range(4)


def _after(line: Column, quote: str, sep: str, inside: bool) -> Column:
    """Whether a reader is inside quotes after ``line``, having begun so or not."""

    def at_quote(state: Column, text: Column) -> Column:
        opens = text.endswith(sep) | ((state == _FIELD_START) & (text == ""))
        doubled = (state == _CLOSED) & (text == "")
        return F.when(state == _INSIDE, F.lit(_CLOSED)).when(opens | doubled, F.lit(_INSIDE)).otherwise(F.lit(_PLAIN))

    parts = F.split(line, f"\\Q{quote}\\E", -1)
    before_quotes = F.slice(parts, F.lit(1), F.size(parts) - 1)
    begin = F.lit(_INSIDE if inside else _FIELD_START)
    return F.when(F.contains(line, F.lit(quote)), F.aggregate(before_quotes, begin, at_quote) == _INSIDE).otherwise(F.lit(inside))


def _composed(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add ``in0`` and ``in1``: whether a row begins inside, if the first of its group
    begins outside or inside.

    Effects of earlier rows compose to that of the last one that settles the state
    whatever it was, and the number of changes since.
    """
    along = W.partitionBy(*keys).orderBy(order)
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    settles = F.col("out0") == F.col("out1")
    turns = F.col("out0") & ~F.col("out1")
    rows = rows.withColumn("_turns", F.coalesce(F.sum(turns.cast("long")).over(earlier), F.lit(0)))
    settled = F.when(settles, F.struct(F.col("out0").alias("state"), F.col("_turns").alias("turns")))
    rows = rows.withColumn("_last", F.last(settled, ignorenulls=True).over(earlier))
    turned = ((F.col("_turns") - F.coalesce(F.col("_last.turns"), F.lit(0))) % 2) == 1

    def begins(inside: bool) -> Column:
        return F.coalesce(F.col("_last.state"), F.lit(inside)) != turned

    return rows.withColumn("in0", begins(False)).withColumn("in1", begins(True)).drop("_turns", "_last")


def read_records(spark: SparkSession, path: str | list[str], quote: str, sep: str, skip: int = 0) -> DataFrame:
    """The records of UTF-8 files as a ``value`` column, but the first ``skip`` of each file.

    Blank lines outside quotes count as records.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
        _after(F.col("value"), quote, sep, False).alias("out0"), _after(F.col("value"), quote, sep, True).alias("out1"),
    )
    # One shuffle, by file block: Spark's own pieces of input, whose size is bounded.
    inside = _composed(lines, ["file", "block"], "line")
    so_far = W.partitionBy("file", "block").orderBy("line").rowsBetween(W.unboundedPreceding, 0)
    both = inside.select(
        "file", "block", "line", "value", "in0", "in1",
        *[F.when(F.col(f"in{i}"), F.col("out1")).otherwise(F.col("out0")).alias(f"out{i}") for i in (0, 1)],
        *[F.sum((~F.col(f"in{i}")).cast("long")).over(so_far).alias(f"begun{i}") for i in (0, 1)],
    )
    stored = materialize(both, "lines")
    last = F.max_by(F.struct("out0", "out1", "begun0", "begun1"), "line")
    blocks = _composed(stored.groupBy("file", "block").agg(last.alias("l")).select("file", "block", "l.*"), ["file"], "block")
    begun = F.when(F.col("in0"), F.col("begun1")).otherwise(F.col("begun0"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.col("in0").alias("begins"), F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("before"))
    known = stored.join(broadcast_if_small(materialize(blocks, "blocks")), ["file", "block"])

    def either(name: str) -> Column:
        return F.when(F.col("begins"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    placed = known.select(
        "file", "block", "line", "value", either("in").alias("inside"), either("out").alias("open"), (F.col("before") + either("begun")).alias("record")
    ).where(F.col("record") > skip)
    whole = ~F.col("inside") & ~F.col("open")
    parts = placed.where(~whole)
    _refuse_endless(parts)
    ordered = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    joined = parts.groupBy("file", "record").agg(F.array_join(F.transform(ordered, lambda p: p["value"]), "\n").alias("value"))
    ended = F.when(F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return placed.where(whole).select("value").unionByName(joined.select("value")).select(ended.alias("value"))


def _refuse_endless(parts: DataFrame) -> None:
    """A quote that is never closed would make the rest of a file one record."""
    sizes = parts.groupBy("file", "record").agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
    worst = sizes.where(F.col("bytes") > MOST_RECORD_BYTES).orderBy(F.desc("bytes")).first()
    if worst is not None:
        raise ValueError(f"record {worst['record']} of {worst['file']} has {worst['bytes']} bytes: is a quote not closed?")
