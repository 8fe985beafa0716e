"""Warehouse-style operations on Parquet tables."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.streaming import StreamingQuery

from flightlake.functions.messages import parsed_once
from flightlake.operators import insert_log
from flightlake.operators.serving import page
from flightlake.operators.sizing import broadcast_if_small
from flightlake.session import folders, materialize, remove
from flightlake.sources.loads import CORRUPT, TAB_NAMES, accept, file_path, parse_strict

# --- writing -----------------------------------------------------------------


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return None
        raise


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the given schema: absent columns are null, unknown ones an error."""
    unknown = set(df.columns) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Write with mode append, empty, truncate or truncate_data; returns the table.

    ``empty`` fails when the table holds rows, ``truncate_data`` replaces the
    rows but keeps the schema.
    """
    spark = df.sparkSession
    current = existing(spark, path) if mode in {"empty", "truncate_data"} else None
    if mode == "empty" and current is not None and not current.isEmpty():
        raise ValueError(f"table {path} is not empty")
    if mode == "truncate_data" and current is not None:
        df = aligned(df, current.schema)
    writer = laid_out(df, partition_by, cluster_by).write.mode("append" if mode == "append" else "overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.parquet(path)


def laid_out(df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> DataFrame:
    """Rows placed for writing.

    Clustered: sorted by value ranges, where the row hash after the keys lets a
    value with very many rows spread over several tasks.  Only partitioned: one
    partition's rows come together in as many files as their size needs.
    """
    if cluster_by:
        keys = [*partition_by, *cluster_by]
        # maps cannot be hashed
        hashable = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
        return df.repartitionByRange(*keys, F.xxhash64(*hashable)).sortWithinPartitions(*keys)
    return df.hint("rebalance", *partition_by) if partition_by else df


def updated_schema(
    current: T.StructType,
    incoming: T.StructType,
    allow_addition: bool = False,
    allow_relaxation: bool = False,
) -> T.StructType:
    """The table schema after an append, or an error when the append may not change it."""
    known = {f.name: f for f in current}
    added = [f for f in incoming if f.name not in known]
    if added and not allow_addition:
        raise ValueError(f"new columns not allowed: {[f.name for f in added]}")
    given = {f.name: f for f in incoming}
    fields = []
    for field in current:
        optional = field.name not in given or given[field.name].nullable
        if field.name in given and given[field.name].dataType != field.dataType:
            raise ValueError(f"column {field.name} is {field.dataType.simpleString()}, not {given[field.name].dataType.simpleString()}")
        if optional and not field.nullable and not allow_relaxation:
            raise ValueError(f"column {field.name} is required")
        fields.append(T.StructField(field.name, field.dataType, field.nullable or optional))
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType, True) for f in added]])


def append_updating(
    incoming: DataFrame, path: str, current: T.StructType, **allowed: bool
) -> tuple[DataFrame, T.StructType]:
    """Append to the table at ``path``, whose schema may change as far as allowed.

    Files keep no column that is not theirs: older rows read as null in columns
    that came later.  The table is read back in the updated schema, which is
    returned as well; a table's required columns are part of its schema, not of
    its files, so the caller keeps it.
    """
    schema = updated_schema(current, incoming.schema, **allowed)
    write_table(incoming, path, "append")
    return incoming.sparkSession.read.schema(schema).parquet(path), schema


# --- partitions --------------------------------------------------------------

# Partition id formats by unit.
PARTITION_FORMATS = {"HOUR": "yyyyMMddHH", "DAY": "yyyyMMdd", "MONTH": "yyyyMM", "YEAR": "yyyy"}


def time_partition(df: DataFrame, field: str | None = None, unit: str = "DAY", into: str = "partition_id") -> DataFrame:
    """Add the id of the time partition of ``field``, or of the load time."""
    ts = F.col(field) if field else F.current_timestamp()
    return df.withColumn(into, F.date_format(ts, PARTITION_FORMATS[unit]))


def _alive(seconds: int, now: Column, unit: str, column: str) -> Column:
    # A bare year or month starts on its first day.
    first_day = {"YEAR": "0101", "MONTH": "01"}.get(unit, "")
    padded = F.rpad(F.concat(F.col(column).cast("string"), F.lit(first_day)), 10, "0")
    start = F.try_to_timestamp(padded, F.lit(PARTITION_FORMATS["HOUR"]))
    # Rows without a partition time never expire.
    return start.isNull() | (start + F.make_dt_interval(secs=F.lit(seconds)) > now)


def unexpired(df: DataFrame, seconds: int, now: Column, unit: str = "DAY", column: str = "partition_id") -> DataFrame:
    """Partitions younger than their time plus ``seconds``; 0 or less keeps all.

    The condition is on the partition column alone, so expired folders are not read.
    """
    return df.filter(_alive(seconds, now, unit, column)) if seconds > 0 else df


def drop_expired(spark: SparkSession, path: str, seconds: int, now: Column, unit: str = "DAY", column: str = "partition_id") -> list[str]:
    """Delete the folders of expired partitions of the table at ``path``; returns their ids.

    The ids come from the folder names, no file is read; 0 or less keeps all.
    """
    ids = [name.removeprefix(f"{column}=") for name in folders(spark, path) if name.startswith(f"{column}=")]
    if seconds <= 0 or not ids:
        return []
    listed = spark.createDataFrame([(i,) for i in ids], f"`{column}` string")
    expired = sorted(r[0] for r in listed.filter(~_alive(seconds, now, unit, column)).collect())
    for partition in expired:
        remove(spark, f"{path}/{column}={partition}")
    return expired


def range_partition(df: DataFrame, spec: str, into: str = "bucket_start") -> DataFrame:
    """Add the start of the ``field,start,end,interval`` bucket; null outside."""
    parts = spec.split(",")
    if len(parts) != 4:
        raise ValueError("expected field,start,end,interval")
    field, (start, end, step) = parts[0], map(int, parts[1:])
    value = F.col(field)
    # whole-number division: a double cannot hold every value above 2**53
    bucket = value - F.pmod(value - F.lit(start), F.lit(step))
    return df.withColumn(into, F.when((value >= start) & (value < end), bucket).cast("bigint"))


def read_partitions(
    spark: SparkSession, path: str, column: str, low: str | None = None, high: str | None = None, values: Sequence[str] = ()
) -> DataFrame:
    """A partitioned table between bounds or for given partitions; without any it refuses to scan."""
    if low is None and high is None and not values:
        raise ValueError(f"give a filter on {column}: the table must not be scanned whole")
    rows = spark.read.option("basePath", path).parquet(path)
    text = F.col(column).cast("string")
    if low is not None:
        rows = rows.filter(text >= low)
    if high is not None:
        rows = rows.filter(text <= high)
    return rows.filter(text.isin(list(values))) if values else rows


# --- moving tables -----------------------------------------------------------

# Compression names and Spark's.
COMPRESSIONS = {"NONE": "none", "GZIP": "gzip", "DEFLATE": "deflate", "SNAPPY": "snappy", "ZSTD": "zstd"}


def extract(df: DataFrame, path: str, fmt: str = "CSV", delimiter: str = ",", header: bool = True, compression: str = "NONE") -> None:
    """Table to files; a nested table cannot become CSV."""
    codec = COMPRESSIONS[compression]
    if fmt == "CSV":
        nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
        if nested:
            raise ValueError(f"nested columns cannot be written as CSV: {nested}")
        sep = "\t" if delimiter in TAB_NAMES else delimiter
        writer = df.write.option("sep", sep).option("header", str(header).lower()).option("escape", '"')
        writer.option("compression", codec).mode("overwrite").csv(path)
    elif fmt == "NEWLINE_DELIMITED_JSON":
        df.write.option("compression", codec).mode("overwrite").json(path)
    else:
        df.write.format(fmt.lower()).option("compression", codec).mode("overwrite").save(path)


def copy_tables(sources: Sequence[DataFrame], path: str, mode: str = "empty") -> DataFrame:
    """Several tables' rows, one after another, into a target."""
    return write_table(reduce(DataFrame.unionByName, sources), path, mode)


# What a shard suffix of each unit must look like.
SUFFIX_PATTERNS = {"HOUR": r"\d{10}", "DAY": r"\d{8}", "MONTH": r"\d{6}", "YEAR": r"\d{4}"}


def shards_to_partitions(
    spark: SparkSession, root: str, prefix: str, schema: T.StructType, target: str, unit: str = "DAY", no_clobber: bool = False
) -> DataFrame:
    """Tables ``<prefix><suffix>`` under ``root`` to one table partitioned by the suffix.

    All shards are one scan and one write; a table whose suffix is no time is
    left out, a partition of the target is replaced unless ``no_clobber``.
    """
    pattern = f"/{re.escape(prefix)}({SUFFIX_PATTERNS[unit]})/[^/]*$"
    suffix = F.regexp_extract(file_path(), pattern, 1)
    rows = spark.read.schema(schema).parquet(f"{root}/{prefix}*").withColumn("partition_id", suffix)
    month_day = {"YEAR": "0101", "MONTH": "01"}.get(unit, "")
    day = F.substring(F.concat("partition_id", F.lit(month_day)), 1, 8)
    is_time = F.try_to_timestamp(day, F.lit("yyyyMMdd")).isNotNull()
    if unit == "HOUR":
        is_time = is_time & (F.substring("partition_id", 9, 2) < "24")
    rows = rows.filter((F.col("partition_id") != "") & is_time)
    full = existing(spark, target)
    if no_clobber and full is not None:
        # One row per partition folder.
        taken = full.select(F.col("partition_id").cast("string").alias("partition_id")).distinct()
        rows = rows.join(broadcast_if_small(taken), "partition_id", "left_anti")
    (
        rows.hint("rebalance", "partition_id").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("partition_id").parquet(target)
    )
    with_id = T.StructType([*schema.fields, T.StructField("partition_id", T.StringType())])
    return spark.read.schema(with_id).parquet(target)


# --- reading -----------------------------------------------------------------

# Fixed value: rows shown when no number is given.
HEAD_ROWS = 100


def head(df: DataFrame, order: list[str], start: int = 0, rows: int = HEAD_ROWS, fields: list[str] | None = None) -> DataFrame:
    """``rows`` rows after ``start`` in a total order, some (nested) fields."""
    shown = page(df, order, start, rows)
    return shown.select(*fields) if fields else shown


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def decode_wire(text: Column, kind: T.DataType) -> Column:
    """A value in wire form as a typed, possibly nested, value.

    A record travels as ``{"f": [{"v": ...}, ...]}``, a repeated value as
    ``[{"v": ...}, ...]``, a plain value as itself.
    """
    if isinstance(kind, T.StructType):
        def record(cells: Column) -> Column:
            fields = [decode_wire(F.get(cells, F.lit(i))["v"], f.dataType).alias(f.name) for i, f in enumerate(kind)]
            return F.when(cells.isNotNull(), F.struct(*fields))

        return _bound(F.from_json(text, "f array<struct<v: string>>")["f"], record)
    if isinstance(kind, T.ArrayType):
        cells = F.from_json(text, "array<struct<v: string>>")
        return F.transform(cells, lambda cell: decode_wire(cell["v"], kind.elementType))
    return text.try_cast(kind)


def nested_rows(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Rows in wire form as nested columns."""
    return parsed_once(lines, _r=decode_wire(F.col(column), schema)).select("_r.*")


def flatten_rows(df: DataFrame, repeated: str) -> DataFrame:
    """One row per element of a repeated record, its fields as columns; an empty one leaves nulls."""
    rest = [c for c in df.columns if c != repeated]
    kind = df.schema[repeated].dataType.elementType
    opened = df.select(*rest, F.explode_outer(repeated).alias("_e"))
    if isinstance(kind, T.StructType):
        return opened.select(*rest, "_e.*")
    return opened.withColumnRenamed("_e", repeated)


def map_to_structs(df: DataFrame, column: str) -> DataFrame:
    """A map column as an array of key and value records."""
    return df.withColumn(column, F.map_entries(column))


# --- inserting ---------------------------------------------------------------


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their line number, files in path order."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )
    # A block's lines follow each other in one task, so ids grow by one inside it.
    # Lines are not shuffled: only counts per block and per file are added up.
    placed = lines.withColumn("_id", F.monotonically_increasing_id())
    blocks = placed.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    blocks = materialize(blocks, "line_blocks")
    before = W.rowsBetween(W.unboundedPreceding, -1)
    files = blocks.groupBy("_file").agg(F.sum("_lines").alias("_lines")).select(
        "_file", F.coalesce(F.sum("_lines").over(before.orderBy("_file")), F.lit(0)).alias("_before")
    )
    inside = F.coalesce(F.sum("_lines").over(before.partitionBy("_file").orderBy("_block")), F.lit(0))
    starts = materialize(
        blocks.withColumn("_inside", inside).join(files, "_file")
        .select("_file", "_block", (F.col("_before") + F.col("_inside") - F.col("_first") + 1).alias("_shift")),
        "line_starts",
    )
    numbered = placed.join(broadcast_if_small(starts), ["_file", "_block"])
    return numbered.select("value", (F.col("_id") + F.col("_shift")).alias("line_no"))


def insert_rows(
    lines: DataFrame,
    schema: T.StructType,
    path: str,
    insert_id: str | None = None,
    skip_invalid: bool = False,
    ignore_unknown: bool = False,
    template_suffix: str = "",
) -> DataFrame:
    """Append JSON lines (``value, line_no``) to a table; returns the table, which holds no repeats.

    With ``insert_id`` each row is known as ``<insert_id>_<line number>``, so
    lines sent again change nothing.  One bad row fails the whole request,
    unless invalid rows are skipped.
    """
    if ignore_unknown:
        options = {"columnNameOfCorruptRecord": CORRUPT}
        with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        parsed = parsed_once(lines, d=F.from_json("value", with_corrupt, options)).select("line_no", "d.*")
    else:
        parsed = parse_strict(lines, schema, "line_no")
    # Without skipping, the lines are parsed into a staging table and counted there.
    rows = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if skip_invalid else accept(parsed)
    known_as = F.concat(F.lit(f"{insert_id}_"), F.col("line_no").cast("string")) if insert_id else F.lit(None).cast("string")
    target = path + template_suffix
    rows = rows.withColumn("insert_id", known_as).drop("line_no")
    stored = existing(lines.sparkSession, target)
    if insert_id:
        rows = rows.dropDuplicates(["insert_id"])
        # One narrow column of the files that hold rows of this request; a first attempt reads none.
        held = insert_log.files_of(stored, target, insert_id) if stored is not None else []
        if held:
            known = lines.sparkSession.read.parquet(*held).select("insert_id").filter(F.col("insert_id").startswith(f"{insert_id}_"))
            rows = rows.join(known, "insert_id", "left_anti").select(*rows.columns)
    rows.write.mode("append").parquet(target)
    return lines.sparkSession.read.schema(rows.schema).parquet(target)


# --- queries -----------------------------------------------------------------

# Warehouse parameter types and how their text is read.
_READERS: dict[str, Callable[[str], Any]] = {
    "STRING": str,
    "INT64": int,
    "INTEGER": int,
    "FLOAT64": float,
    "FLOAT": float,
    "BOOL": lambda text: text.lower() == "true",
    "BOOLEAN": lambda text: text.lower() == "true",
    "NUMERIC": Decimal,
    "DATE": date.fromisoformat,
    "DATETIME": datetime.fromisoformat,
    "TIMESTAMP": lambda text: datetime.fromisoformat(text.replace("Z", "+00:00")),
}
_OPEN_ENDS = {"UNBOUNDED", "NULL"}


def _struct_fields(text: str) -> list[tuple[str, str]]:
    """``a INT64, b ARRAY<STRING>`` as pairs; commas inside brackets do not split."""
    parts, depth = [""], 0
    for c in text:
        depth += (c == "<") - (c == ">")
        if depth < 0:
            break
        if c == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += c
    if depth:
        raise ValueError(f"brackets do not match: {text!r}")
    pairs = []
    for part in parts:
        name, _, kind = part.strip().partition(" ")
        if not kind:
            raise ValueError(f"struct field without a name: {part!r}")
        pairs.append((name, kind.strip()))
    return pairs


def typed_value(kind: str, value: Any) -> Any:
    """A parameter value (text, or decoded JSON) as a literal ``spark.sql`` accepts."""
    if value is None or value == "NULL":
        return F.lit(None)
    outer, _, inner = kind.partition("<")
    outer, inner = outer.upper() or "STRING", inner.removesuffix(">")
    if outer == "ARRAY":
        items = json.loads(value) if isinstance(value, str) else value
        return F.array(*[F.lit(typed_value(inner, item)) for item in items])
    if outer == "STRUCT":
        given = json.loads(value) if isinstance(value, str) else value
        fields = dict(_struct_fields(inner))
        return F.struct(*[F.lit(typed_value(fields[n], v)).alias(n) for n, v in given.items()])
    if outer == "RANGE":
        ends = re.fullmatch(r"\[\s*(.+?)\s*,\s*(.+?)\s*\)", value)
        if not ends:
            raise ValueError(f"not a range: {value!r}")
        start, end = (None if e.upper() in _OPEN_ENDS else e for e in ends.groups())
        return F.struct(F.lit(typed_value(inner, start)).alias("start"), F.lit(typed_value(inner, end)).alias("end"))
    return _READERS[outer](value if isinstance(value, str) else str(value))


def query_args(parameters: Sequence[str]) -> dict[str, Any] | list[Any]:
    """``name:type:value`` texts as arguments for ``spark.sql``; unnamed ones are positional."""
    named, positional = {}, []
    for text in parameters:
        name, kind, value = (text.split(":", 2) + [None, None])[:3]
        if value is None:
            raise ValueError(f"expected name:type:value, got {text!r}")
        if name:
            named[name] = typed_value(kind, value)
        else:
            positional.append(typed_value(kind, value))
    if named and positional:
        raise ValueError("parameters are either all named or all positional")
    return named or positional


def query_to_table(spark: SparkSession, sql: str, path: str, mode: str = "empty", partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), **frames: DataFrame) -> DataFrame:
    """A query's result as a table; ``{name}`` in the text stands for a frame."""
    return write_table(spark.sql(sql, **frames), path, mode, partition_by, cluster_by)


def query_external(spark: SparkSession, sql: str, name: str, fmt: str, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """A query over files described on the spot."""
    external = spark.read.format(fmt).options(**options).schema(schema).load(path)
    return spark.sql(sql, **{name: external})


def continuous_query(spark: SparkSession, sql: str, view: str, stream: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object]) -> StreamingQuery:
    """Run a query for as long as rows arrive, appending its results."""
    stream.createOrReplaceTempView(view)
    writer = spark.sql(sql).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start(path)


def query_with_function(spark: SparkSession, definition: str, sql: str, **frames: DataFrame) -> DataFrame:
    """A query that uses a SQL function defined for it (inlined by the optimizer)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")
    return spark.sql(sql, **frames)


def row_policy(df: DataFrame, policies: Sequence[tuple[str, Sequence[str], str]], caller: str) -> DataFrame:
    """Rows the caller may see: any predicate of the policies granted to them.

    ``policies`` are (name, grantees, SQL predicate).  A table with policies
    shows nothing to a caller none of them names.
    """
    granted = [predicate for _name, grantees, predicate in policies if caller in grantees]
    if not granted:
        return df.filter(F.lit(False))
    return df.filter(reduce(Column.__or__, [F.coalesce(F.expr(p), F.lit(False)) for p in granted]))


class MaterializedView:
    """A stored query result with the time it was computed."""

    LOG = "path string, refreshed_at double"

    def __init__(self, path: str, query: Callable[[], DataFrame], refresh_seconds: float = 1800.0, max_staleness: float = 0.0):
        self.path, self.query = path, query
        self.refresh_seconds, self.max_staleness = refresh_seconds, max_staleness

    def _newest(self, spark: SparkSession):
        log = existing(spark, f"{self.path}/log")
        return log.orderBy(F.col("refreshed_at").desc()).first() if log is not None else None

    def refresh(self, spark: SparkSession, now: float) -> str:
        version = f"{self.path}/version-{int(now * 1000)}"
        self.query().write.mode("overwrite").parquet(version)
        spark.createDataFrame([(version, float(now))], self.LOG).write.mode("append").parquet(f"{self.path}/log")
        return version

    def maintain(self, spark: SparkSession, now: float) -> bool:
        """The periodic refresh: only when the interval has passed since the last one."""
        last = self._newest(spark)
        due = last is None or now - last.refreshed_at >= self.refresh_seconds
        if due:
            self.refresh(spark, now)
        return due

    def read(self, spark: SparkSession, now: float) -> DataFrame:
        """The stored result, computed anew when it is staler than allowed."""
        last = self._newest(spark)
        if last is None or now - last.refreshed_at > self.max_staleness:
            return spark.read.parquet(self.refresh(spark, now))
        return spark.read.parquet(last.path)
