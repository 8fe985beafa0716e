"""Numbers read from text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(text: Column) -> Column:
    """Text as a double, or null.  Java's type suffixes (``5d``, ``5f``) are no number."""
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))
