"""JSON messages: text in, typed columns out, and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_to_string(df: DataFrame, column: str = "value") -> DataFrame:
    """Topic payload bytes as text."""
    return df.withColumn(column, F.col(column).cast("string"))


def parse_json(df: DataFrame, schema: T.StructType, column: str = "value", into: str = "d") -> DataFrame:
    """Permissive parse: malformed text and wrong-typed fields become nulls."""
    return df.withColumn(into, F.from_json(F.col(column), schema))


def flatten(df: DataFrame, struct: str = "d", fields: list[str] | None = None) -> DataFrame:
    """All fields of a struct column, or the named ones."""
    return df.select(*([f"{struct}.{name}" for name in fields] if fields else [f"{struct}.*"]))


def parsed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are expensive to compute and will be filtered on.

    A filter on a plain column is moved below the projection that computes it
    and computes it again, per use.  Filters do not pass a generated row.
    """
    cells = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(cells)))


def parse_messages(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Message text (or bytes) to one column per field."""
    return flatten(parse_json(value_to_string(lines, column), schema, column))


def is_json_object(column: str = "value") -> Column:
    """True when the text is one well-formed JSON object.

    ``try_parse_json`` checks the whole text; the map view rules out arrays and
    bare scalars.
    """
    text = F.col(column)
    return F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{")


def extract_paths(df: DataFrame, paths: Mapping[str, str], column: str = "value") -> DataFrame:
    """Scalars at JSON paths; a record lacking any of them is discarded."""
    scalars = {name: F.get_json_object(F.col(column), path) for name, path in paths.items()}
    return parsed_once(df, **scalars).select(*paths).na.drop("any")


def emit_json(df: DataFrame, columns: list[str], *keep: str, keep_nulls: bool = False) -> DataFrame:
    """One JSON ``value`` column, beside those to keep; null fields are dropped unless ``keep_nulls``."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return df.select(F.to_json(F.struct(*columns), options).alias("value"), *keep)
