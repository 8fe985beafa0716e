"""Scoring requests built from web forms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions.clocks import date_parts, stamp
from flightlake.functions.numbers import number
from flightlake.operators.joins import distance_lookup

# Form fields and their types.
FORM_TYPES = {
    "DepDelay": "double",
    "Carrier": "string",
    "FlightDate": "string",
    "Dest": "string",
    "FlightNum": "string",
    "Origin": "string",
}


def typed_form(forms: DataFrame, types: Mapping[str, str] = FORM_TYPES, keep: list[str] | None = None) -> DataFrame:
    """Form texts as typed columns; a text that does not fit becomes null."""
    typed = [
        (number(F.col(name)) if kind == "double" else F.col(name).try_cast(kind)).alias(name)
        for name, kind in types.items()
    ]
    return forms.select(*(keep or []), *typed)


def request_enrich(forms: DataFrame, distances: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed form, route distance and date parts: the request without its stamp."""
    return distance_lookup(typed_form(forms, keep=keep), distances).withColumns(date_parts())


def request_stamped(forms: DataFrame, distances: DataFrame) -> DataFrame:
    return stamp(request_enrich(forms, distances))
