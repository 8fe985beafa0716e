"""The two policies for incomplete scoring requests."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.features import route_or_null
from flightlake.functions.messages import parsed_once
from flightlake.functions.numbers import number

# Stand-ins of the first policy.
TEXT_DEFAULTS = {"Carrier": "AA", "Origin": "LAX", "Dest": "JFK"}
NUMBER_DEFAULTS = {"DepDelay": 0.0, "Distance": 500.0}
DAY_FIELDS = ["DayOfMonth", "DayOfWeek", "DayOfYear"]
DAY_DEFAULT = 1

PASS_THROUGH = ["UUID", "Origin", "Dest", "Carrier", "Timestamp"]


def fill_by_field(df: DataFrame) -> DataFrame:
    """First policy: empty or null text and null numbers get per-field values.

    A zero is a real value and stays.
    """
    filled = {
        **{c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(v)) for c, v in TEXT_DEFAULTS.items()},
        **{c: F.coalesce(F.col(c), F.lit(v)) for c, v in NUMBER_DEFAULTS.items()},
        **{c: F.coalesce(F.col(c), F.lit(DAY_DEFAULT)) for c in DAY_FIELDS},
    }
    return df.withColumns(filled).withColumn("Route", route_or_null())


def _text(fields: Column, name: str) -> Column:
    # A key that is absent reads as empty text, an explicit null as "None".
    return (
        F.when(~F.map_contains_key(fields, name), F.lit(""))
        .otherwise(F.coalesce(fields[name], F.lit("None")))
    )


def _number(fields: Column, name: str, stand_in: int) -> Column:
    # Absent, null, empty and zero all read as the stand-in; other text that is
    # not a number gives null, which marks the record as failed.
    raw = fields[name]
    value = number(raw)
    return F.when(
        raw.isNull() | (raw == "") | F.coalesce(value == 0, F.lit(False)), F.lit(float(stand_in))
    ).otherwise(value)


def fill_or_fail(lines: DataFrame, column: str = "value") -> DataFrame:
    """Second policy, from message text; ``failed`` marks records to drop.

    It needs the text because an absent key and an explicit null differ.  The
    model inputs are in the plain columns, the values echoed to the caller in
    the ``echo_`` ones, the text itself and why it failed in ``message`` and
    ``reason``.
    """
    fields = F.col("_fields")
    parsed = parsed_once(lines, _fields=F.from_json(F.col(column), "map<string,string>"))
    typed = parsed.select(
        "_fields",
        F.col(column).alias("message"),
        *[_text(fields, c).alias(c) for c in TEXT_DEFAULTS],
        *[_number(fields, c, 0).alias(c) for c in NUMBER_DEFAULTS],
        *[_number(fields, c, DAY_DEFAULT).try_cast("int").alias(c) for c in DAY_FIELDS],
        *[
            F.when(~F.map_contains_key(fields, c), F.lit("")).otherwise(fields[c]).alias(f"echo_{c}")
            for c in PASS_THROUGH
        ],
    )
    numbers = [*NUMBER_DEFAULTS, *DAY_FIELDS]
    unread = F.col("_fields").isNull()
    failed = unread
    for name in numbers:
        failed = failed | F.col(name).isNull()
    wrong = F.concat_ws(", ", *[F.when(F.col(n).isNull(), F.lit(f"{n} is no number")) for n in numbers])
    reason = F.when(unread, F.lit("no JSON object")).when(failed, wrong)
    return typed.withColumns({"failed": failed, "reason": reason, "Route": route_or_null()}).drop("_fields")


def split_failed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to score, rejected messages with the reason)."""
    return df.filter(~F.col("failed")).drop("failed", "message", "reason"), df.filter("failed").select("message", "reason")
