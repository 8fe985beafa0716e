"""Keyed tables where the last write wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.clocks import parse_iso_zulu
from flightlake.functions.messages import parsed_once
from flightlake.functions.numbers import number


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key.

    ``max_by`` combines on the map side, so a hot key reaches its reducer as
    one row per task; no window ever holds all versions of a key.  Rows that are
    equally new are told apart by their other values, so the answer does not
    depend on the order in which tasks end.
    """
    rest = [c for c in df.columns if c not in keys]
    # maps have no order
    ties = [f.name for f in df.schema if f.name in rest and f.name not in order and "map<" not in f.dataType.simpleString()]
    newest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order, *ties)).alias("_row")
    )
    return newest.select(*keys, "_row.*").select(*df.columns)


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``current`` with ``incoming`` applied; the newer row of a key stays."""
    return latest_per_key(current.unionByName(incoming), keys, order)


def prediction_rows(lines: DataFrame, *keep: str) -> DataFrame:
    """Result messages (``value``) as rows to store; unreadable ones are skipped.

    An absent number counts as 0 and an absent time as null, but a number or
    time that cannot be read skips the message, as does a missing id.
    """
    fields = F.col("_fields")

    def value(name: str) -> Column:
        absent = ~F.map_contains_key(fields, name)
        return F.when(absent, F.lit(0.0)).otherwise(number(fields[name]))

    parsed = parsed_once(lines, _fields=F.from_json("value", "map<string,string>"))
    read = parsed.select(
        fields["UUID"].alias("uuid"),
        value("Prediction").alias("_prediction"),
        parse_iso_zulu(fields["Timestamp"]).alias("timestamp"),
        *[fields[c].alias(c.lower()) for c in ("Origin", "Dest", "Carrier")],
        value("DepDelay").alias("dep_delay"),
        fields["Timestamp"].alias("_time"),
        *keep,
    )
    readable = (
        F.col("uuid").isNotNull()
        & F.col("_prediction").isNotNull()
        & F.col("dep_delay").isNotNull()
        & (F.col("_time").isNull() | F.col("timestamp").isNotNull())
    )
    stored = F.col("_prediction").cast("string").alias("prediction")
    return read.filter(readable).select(
        "uuid", stored, "timestamp", "origin", "dest", "carrier", "dep_delay", *keep
    )


def store_predictions(lines: DataFrame, arrival: list[str]) -> DataFrame:
    """The prediction table after all messages: one row per id, the one that arrived last.

    ``arrival`` names the columns beside ``value`` that say when a message came
    (an offset, or file and line); the time inside a message does not count.
    """
    return latest_per_key(prediction_rows(lines, *arrival), ["uuid"], arrival).drop(*arrival)
