"""Compare a query with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.9g}"
    return str(value) if value is not None else None


_SPARK_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def differences(con, sql: str, frame) -> list[str]:
    """Empty when columns, types, row count and values agree."""
    relation = con.sql(sql)
    problems = []
    if sorted(relation.columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} but SQL has {sorted(relation.columns)}"]
    sql_types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    for name, kind in frame.dtypes:
        want = _SPARK_TYPES.get(kind, kind)
        if want != sql_types[name]:
            problems.append(f"type of {name}: {kind} but SQL has {sql_types[name]}")
    names = sorted(frame.columns)
    spark_rows = Counter(
        tuple(_cell(row[c]) for c in names) for row in (r.asDict() for r in frame.collect())
    )
    where = [relation.columns.index(c) for c in names]
    sql_rows = Counter(tuple(_cell(row[i]) for i in where) for row in relation.fetchall())
    if sum(spark_rows.values()) != sum(sql_rows.values()):
        problems.append(f"{sum(spark_rows.values())} rows but SQL has {sum(sql_rows.values())}")
    only_spark, only_sql = spark_rows - sql_rows, sql_rows - spark_rows
    if only_spark or only_sql:
        problems.append(f"{names}: only Spark {list(only_spark)[:3]}, only SQL {list(only_sql)[:3]}")
    if not spark_rows:
        problems.append("no rows")
    return problems
