"""Date and time expressions.  All clocks are UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DAY_PATTERN = "yyyy.MM.dd"


def date_parts(date: str = "FlightDate") -> dict[str, Column]:
    """Day of year, day of month and weekday (Monday is 0) of an ISO date text."""
    day = F.try_to_timestamp(F.col(date)).cast("date")
    return {
        "DayOfYear": F.dayofyear(day),
        "DayOfMonth": F.dayofmonth(day),
        "DayOfWeek": F.weekday(day),
    }


def parse_any(text: Column) -> Column:
    """ISO 8601, epoch milliseconds, or microsecond ISO text; null if none fits."""
    # Four digits are a year.
    digits = text.rlike(r"^-?\d{1,16}$") & ~text.rlike(r"^\d{4}$")
    millis = F.timestamp_millis(F.when(digits, text.try_cast("bigint")))
    return F.coalesce(
        millis,
        F.when(text.rlike(r"^\d{4}(-|$)"), F.try_to_timestamp(text)),
        F.try_to_timestamp(text, F.lit(ISO_MICROS)),
    )


def parse_iso_zulu(text: Column) -> Column:
    """ISO text where a ``Z`` stands for +00:00; anything else is null."""
    return F.try_to_timestamp(F.regexp_replace(text, "Z", "+00:00"))


def iso_text(ts: Column) -> Column:
    """Timestamp as microsecond ISO text."""
    return F.date_format(ts, ISO_MICROS)


def stamp(df: DataFrame) -> DataFrame:
    """Add the current time as ISO text and a random request id."""
    return df.withColumns({"Timestamp": iso_text(F.current_timestamp()), "UUID": F.uuid()})
