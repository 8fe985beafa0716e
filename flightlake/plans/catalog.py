"""Named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flightlake.plans.views import with_views
from flightlake.session import configure

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str) -> Callable[[Run], Run]:
    """Register a query; ``sql`` gives the same rows from the tables or ``views``."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf: run(configure(spark), sf)
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return run

    return register
