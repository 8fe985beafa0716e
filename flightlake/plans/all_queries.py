"""Importing this module registers every query."""

from flightlake.plans import (  # noqa: F401
    queries_expressions,
    queries_joins,
    queries_manifest,
    queries_model,
    queries_serving,
    queries_sources,
    queries_streaming,
    queries_tables,
)

FLAGSHIP = "delay_classes_by_month"
