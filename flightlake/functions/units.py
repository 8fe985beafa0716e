"""Readable sizes and counts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Binary size units by power of two, decimal count suffixes by power of ten.
SIZE_UNITS = {0: "B", 10: "KiB", 20: "MiB", 30: "GiB", 40: "TiB", 50: "PiB", 60: "EiB"}
COUNT_SUFFIXES = {3: "k", 6: "m", 9: "b", 12: "t", 15: "q"}


def _trim_zeros(text: Column) -> Column:
    return F.regexp_replace(text, r"\.?0+$", "")


def human_size(size: Column) -> Column:
    """Largest binary unit not above ``size``, at most two decimals."""
    text = None
    for power, unit in sorted(SIZE_UNITS.items(), reverse=True):
        scaled = F.bround(size.cast("double") / F.lit(2.0**power), 2)
        shown = F.concat(_trim_zeros(F.format_string("%.2f", scaled)), F.lit(f" {unit}"))
        text = F.when(size >= 2**power, shown) if text is None else text.when(size >= 2**power, shown)
    return text.otherwise(F.concat(size.cast("string"), F.lit(" B")))


def short_count(number: Column) -> Column:
    """Largest decimal suffix not above ``number``, one decimal; small numbers as they are."""
    text = F
    for power, suffix in sorted(COUNT_SUFFIXES.items(), reverse=True):
        scaled = F.bround(number.cast("double") / F.lit(10.0**power), 1)
        text = text.when(
            number >= 10**power, F.concat(F.format_string("%.1f", scaled), F.lit(suffix))
        )
    return text.otherwise(number.cast("string"))
