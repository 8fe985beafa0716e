"""Column expressions for routes and delay classes."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column
from pyspark.sql import functions as F

# Edges of the four arrival-delay classes, in minutes.
DELAY_SPLITS = [-15.0, 0.0, 30.0]


def route_skip_nulls(origin: str = "Origin", dest: str = "Dest") -> Column:
    """``Origin-Dest``; a missing side is left out."""
    return F.concat_ws("-", F.col(origin), F.col(dest))


def route_or_null(origin: str = "Origin", dest: str = "Dest") -> Column:
    """``Origin-Dest``; null when either side is null."""
    return F.concat(F.col(origin), F.lit("-"), F.col(dest))


def delay_class(delay: str = "ArrDelay") -> Column:
    """Class 0-3 of an arrival delay.  A null delay lands in the last class."""
    value = F.col(delay)
    early, on_time, late = DELAY_SPLITS
    return (
        F.when(value < early, 0).when(value < on_time, 1).when(value < late, 2).otherwise(3)
    )


def delay_bucketizer(input_col: str = "ArrDelay", output_col: str = "ArrDelayBucket") -> Bucketizer:
    """The ML-stage form: null stays null, NaN goes to an extra class 4."""
    return Bucketizer(
        splits=[float("-inf"), *DELAY_SPLITS, float("inf")],
        inputCol=input_col,
        outputCol=output_col,
        handleInvalid="keep",
    )


def histogram_bin(value: str, width: float) -> Column:
    """Left edge of the fixed-width bin holding ``value``."""
    return F.floor(F.col(value) / F.lit(width)) * F.lit(width)
