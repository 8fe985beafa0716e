"""From the flight table to model input."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.features import delay_class, route_skip_nulls
from flightlake.schemas import FEATURES, LABEL


def feature_select(df: DataFrame) -> DataFrame:
    """The nine features and the label."""
    return df.select(*FEATURES, LABEL)


def training_set(flights: DataFrame) -> DataFrame:
    """Route and delay class added, model columns kept, incomplete rows dropped.

    A null arrival delay does not drop a row: it was already classed.
    """
    return feature_select(
        flights.withColumn("Route", route_skip_nulls()).withColumn(LABEL, delay_class())
    ).na.drop("any")


def hash_share(*columns: str) -> Column:
    """A number in [0, 1) fixed by the row's values, the same in every run and engine."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def split_by_key(df: DataFrame, keys: list[str], train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: repeatable, and no shuffle or sort."""
    share = hash_share(*keys)
    return df.filter(share < train_share), df.filter(share >= train_share)


def split_random(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by seeded sampling; repeatable only for a fixed input layout."""
    train, test = df.randomSplit([train_share, 1 - train_share], seed)
    return train, test
