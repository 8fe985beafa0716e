"""Queries of the load and table operators; what is written is read back."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flightlake.operators import tables
from flightlake.operators.incremental import IncrementalView
from flightlake.operators.sizing import spread
from flightlake.plans import views
from flightlake.plans.catalog import query
from flightlake.session import remove, scratch_dir
from flightlake.sources import loads
from flightlake.streaming import jobs, totals

ORDER_FIELDS = "o_orderkey:INTEGER,o_custkey:INTEGER,o_orderstatus,o_totalprice:FLOAT,o_orderpriority:STRING"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_ORDERS = ", ".join(ORDER_COLUMNS)


def _orders(spark, sf):
    return views.table(spark, sf, "orders")


def _write_lines(df, path):
    df.select("value").write.text(path)
    return path


@query(
    "w_load_csv",
    f"""SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS o_custkey,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
)
def _(spark, sf):
    """Three lines lead every file, one of them blank; two markers stand for null."""
    text = F.concat_ws(
        "|", "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", "-").otherwise(F.col("o_custkey").cast("string")),
        F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(F.concat(F.lit('"'), "o_orderstatus", F.lit('"'))),
        F.col("o_totalprice").cast("string"), "o_orderpriority",
    )
    # Files of about a million rows: a title line, a blank line, a header line, then the rows.
    orders = _orders(spark, sf)
    files = 4 + orders.count() // 1_000_000
    file = F.pmod(F.xxhash64("o_orderkey"), F.lit(files))
    rows = orders.select(file.alias("file"), F.lit(3).alias("part"), text.alias("value"))
    leads = rows.select("file").distinct().select(
        "file", F.explode(F.array(
            F.struct(F.lit(0).alias("part"), F.lit("all orders").alias("value")),
            F.struct(F.lit(1).alias("part"), F.lit("").alias("value")),
            F.struct(F.lit(2).alias("part"), F.lit("|".join(ORDER_COLUMNS)).alias("value")),
        )).alias("l")
    ).select("file", "l.part", "l.value")
    path = scratch_dir(spark, "csv")
    laid = rows.unionByName(leads).repartition("file").sortWithinPartitions("file", "part")
    laid.select("file", "value").write.partitionBy("file").text(path)
    loaded = loads.load_csv(
        spark, f"{path}/file=*", loads.schema_from_text(ORDER_FIELDS), "|", skip_rows=3, null_markers=["-", "N/A"]
    )
    return loads.accept(loaded)


@query(
    "w_load_csv_newlines",
    """SELECT doc_id, lang, "text" FROM documents""",
)
def _(spark, sf):
    """Whole texts with quotes and line breaks inside."""
    path = scratch_dir(spark, "csv")
    docs = views.table(spark, sf, "documents").select("doc_id", "lang", "text")
    docs.repartition("doc_id").write.option("quoteAll", "true").option("escape", '"').option("lineSep", "\n").csv(path)
    schema = loads.schema_from_text("doc_id:INTEGER,lang,text")
    return loads.accept(loads.load_csv(spark, path, schema, quoted_newlines=True))


# Text in the files of a language, at most (about).
_FILE_BYTES = 64 * 1024 * 1024


@query(
    "w_load_csv_quoted_blocks",
    """SELECT doc_id, lang, source, "text" FROM documents""",
)
def _(spark, sf):
    """Large files per language, each with two lead records that have line breaks; every file is read in many pieces."""
    path = scratch_dir(spark, "csv")
    docs = views.table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # One task writes a file: a language has as many as keep each bounded.
    files = 1 + size // _FILE_BYTES

    def quoted(name):
        return F.concat(F.lit('"'), F.replace(F.col(name), F.lit('"'), F.lit('""')), F.lit('"'))

    rows = docs.select("lang", F.pmod(F.monotonically_increasing_id(), F.lit(files)).alias("no"), F.lit(2).alias("part"), F.concat_ws(",", "doc_id", quoted("lang"), "source", quoted("text")).alias("value"))
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(files - 1).cast("bigint"))).alias("no")
    leads = docs.select("lang").distinct().select("lang", numbers).select("lang", "no", F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.lit('"all documents\n""of"" a language"').alias("value")),
        F.struct(F.lit(1).alias("part"), F.lit('doc_id,lang,source,"the\ntext"').alias("value")),
    )).alias("l")).select("lang", "no", "l.*")
    laid = rows.unionByName(leads).repartition("lang", "no").sortWithinPartitions("lang", "no", "part")
    laid.select(F.col("lang").alias("file"), "no", "value").write.partitionBy("file", "no").text(path)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(256 * 1024))  # small files here, so that several tasks meet in each
    try:
        return loads.accept(loads.load_csv(spark, f"{path}/file=*/no=*", loads.schema_from_text("doc_id:INTEGER,lang,source,text"), skip_rows=2, quoted_newlines=True))
    finally:
        spark.conf.set(setting, before)


def _event_lines(spark, sf):
    """Events as JSON lines; clicks carry an undeclared key, errors a wrong type."""
    value = F.when(F.col("event_type") == "error", "none").otherwise(F.col("value").cast("string"))
    extra = F.when(F.col("event_type") == "click", F.col("user_id"))
    fields = F.struct("event_id", "event_type", value.alias("value"), extra.alias("visitor"))
    # value is a JSON number where it reads as one
    text = F.regexp_replace(F.to_json(fields), r'"value":"(-?[0-9.E]+)"', '"value":$1')
    return spread(views.table(spark, sf, "events")).select(text.alias("value"))


EVENT_FIELDS = "event_id:INTEGER,event_type,value:FLOAT"


@query(
    "w_load_json",
    """SELECT 'ignore' AS mode, event_id, event_type, "value", false AS bad FROM events WHERE event_type <> 'error'
       UNION ALL SELECT 'ignore', event_id, event_type, NULL, true FROM events WHERE event_type = 'error'
       UNION ALL SELECT 'reject', event_id, event_type, "value", event_type = 'click' FROM events WHERE event_type <> 'error'
       UNION ALL SELECT 'reject', event_id, event_type, NULL, true FROM events WHERE event_type = 'error'""",
)
def _(spark, sf):
    path = _write_lines(_event_lines(spark, sf), scratch_dir(spark, "json"))
    schema = loads.schema_from_text(EVENT_FIELDS)

    def load(mode):
        rows = loads.load_json(spark, path, schema, ignore_unknown=mode == "ignore")
        bad = F.col(loads.CORRUPT).isNotNull().alias("bad")
        return rows.select(F.lit(mode).alias("mode"), "event_id", "event_type", "value", bad)

    return load("ignore").unionByName(load("reject"))


@query(
    "w_load_columnar",
    f"""SELECT 'orc' AS fmt, {_ORDERS} FROM orders UNION ALL SELECT 'parquet', {_ORDERS} FROM orders""",
)
def _(spark, sf):
    rows = []
    for fmt in ("orc", "parquet"):
        path = scratch_dir(spark, fmt)
        _orders(spark, sf).write.format(fmt).save(path)
        rows.append(loads.load_columnar(spark, path, fmt, ORDER_COLUMNS).select(F.lit(fmt).alias("fmt"), "*"))
    return rows[0].unionByName(rows[1])


@query("w_schema_string", f"SELECT {_ORDERS} FROM orders")
def _(spark, sf):
    path = scratch_dir(spark, "csv")
    _orders(spark, sf).select(*ORDER_COLUMNS).write.csv(path)
    return spark.read.schema(loads.schema_from_text(ORDER_FIELDS)).csv(path)


@query(
    "w_autodetect",
    """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
)
def _(spark, sf):
    path = scratch_dir(spark, "csv")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    _orders(spark, sf).select(*columns).write.option("header", "true").csv(path)
    return loads.load_detected(spark, path)


@query(
    "w_bad_records",
    f"SELECT {_ORDERS} FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')",
)
def _(spark, sf):
    path = scratch_dir(spark, "csv")
    broken = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    price = F.when(broken, "unknown").otherwise(F.col("o_totalprice").cast("string"))
    rows = _orders(spark, sf).select(*ORDER_COLUMNS).withColumn("o_totalprice", price)
    rows.write.csv(path)
    loaded = loads.load_csv(spark, path, loads.schema_from_text(ORDER_FIELDS))
    # exactly as many as there are: one more would fail the load
    return loads.accept(loaded, max_bad=_orders(spark, sf).filter(broken).count())


@query(
    "w_jagged_rows",
    """SELECT mode, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderstatus NOT IN ('F', 'P') THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus NOT IN ('F', 'P') THEN o_orderpriority END AS o_orderpriority,
       o_orderstatus = 'P' OR mode = 'strict' AND o_orderstatus = 'F' AS bad FROM orders, (VALUES ('allowed'), ('strict')) m(mode)""",
)
def _(spark, sf):
    """Finished orders send short lines; those of status P are short and hold a value that is no number."""
    path = scratch_dir(spark, "csv")
    short = F.concat_ws(",", "o_orderkey", "o_custkey")
    whole = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    wrong = F.concat_ws(",", "o_orderkey", F.lit("none"))
    status = F.col("o_orderstatus")
    _write_lines(
        _orders(spark, sf).select(F.when(status == "F", short).when(status == "P", wrong).otherwise(whole).alias("value")), path
    )
    schema = loads.schema_from_text("o_orderkey:INTEGER,o_custkey:INTEGER,o_orderstatus,o_orderpriority")

    def load(mode):
        rows = loads.load_csv(spark, path, schema, jagged=mode == "allowed")
        bad = F.col(loads.CORRUPT).isNotNull().alias("bad")
        return rows.select(F.lit(mode).alias("mode"), *schema.fieldNames(), bad)

    return load("allowed").unionByName(load("strict"))


@query(
    "w_formats",
    """SELECT event_id, CAST(ts AS DATE) AS day, strftime(date_trunc('minute', ts) - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M') AS minute_utc
       FROM events""",
)
def _(spark, sf):
    path = scratch_dir(spark, "csv")
    texts = [F.date_format("ts", "MM/dd/yyyy"), F.date_format("ts", "dd.MM.yyyy HH:mm")]
    views.table(spark, sf, "events").select("event_id", *texts).write.csv(path)
    loaded = loads.load_csv(
        spark, path, loads.schema_from_text("event_id:INTEGER,day:DATE,ts:TIMESTAMP"),
        date_format="MM/dd/yyyy", timestamp_format="dd.MM.yyyy HH:mm", time_zone="+02:00",
    )
    minute = F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute_utc")
    return loads.accept(loaded).select("event_id", "day", minute)


@query(
    "w_column_names",
    """SELECT o_orderkey AS order_key, o_totalprice AS _1st_total_price, o_orderstatus AS status__now_ FROM orders""",
)
def _(spark, sf):
    raw = _orders(spark, sf).select(
        F.col("o_orderkey").alias("order key"), F.col("o_totalprice").alias("1st total-price"),
        F.col("o_orderstatus").alias("status (now)"),
    )
    return loads.column_names(raw, "V1")


@query(
    "w_column_match",
    """SELECT match, o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
       CASE WHEN match = 'POSITION' OR o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority,
       o_orderstatus = 'P' AS bad FROM orders, (VALUES ('NAME'), ('POSITION')) m(match)""",
)
def _(spark, sf):
    """By name, files differ in the order of their columns, and some lack one; prices of status P do not convert."""
    schema = loads.schema_from_text(ORDER_FIELDS)
    price = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.col("o_totalprice").cast("string"))
    orders = _orders(spark, sf).withColumn("o_totalprice", price)
    finished = F.col("o_orderstatus") == "F"
    rows = []
    for match, parts in (
        ("NAME", [(orders.filter(~finished), ORDER_COLUMNS[::-1]), (orders.filter(finished), ORDER_COLUMNS[:-1])]),
        ("POSITION", [(orders, ORDER_COLUMNS)]),
    ):
        path = scratch_dir(spark, "csv")
        for part, columns in parts:
            part.select(*columns).write.mode("append").option("header", "true").csv(path)
        bad = F.col(loads.CORRUPT).isNotNull().alias("bad")
        loaded = loads.load_csv_matched(spark, path, schema, match)
        rows.append(loaded.select(F.lit(match).alias("match"), *ORDER_COLUMNS, bad))
    return rows[0].unionByName(rows[1])


@query(
    "w_decimal_target",
    """SELECT o_orderkey, CAST(round(CAST(t AS DECIMAL(38, 11)), 9) AS VARCHAR) AS numeric_text, t AS wide FROM
       (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '.123456789' || CAST(o_orderkey % 10 AS VARCHAR) || '1' AS t FROM orders)""",
)
def _(spark, sf):
    text = F.concat(
        F.col("o_orderkey").cast("string"), F.lit(".123456789"), (F.col("o_orderkey") % 10).cast("string"), F.lit("1")
    )
    narrow = loads.decimal_target(30, 9, ["NUMERIC", "STRING"])
    wide = loads.decimal_target(38, 11, ["NUMERIC", "STRING"])
    rows = _orders(spark, sf).select("o_orderkey", text.alias("t"))
    number = loads.to_decimal(F.col("t"), narrow, rounding=True)
    return rows.select(
        "o_orderkey", number.cast("string").alias("numeric_text"), loads.to_decimal(F.col("t"), wide).alias("wide")
    )


@query(
    "w_hive_partitions",
    """SELECT 'AUTO' AS mode, o_orderkey, CAST(month(o_orderdate) AS VARCHAR) AS month FROM orders WHERE month(o_orderdate) = 2
       UNION ALL SELECT 'STRINGS', o_orderkey, '0' || CAST(month(o_orderdate) AS VARCHAR) FROM orders WHERE month(o_orderdate) = 2""",
)
def _(spark, sf):
    path = scratch_dir(spark, "hive")
    rows = _orders(spark, sf).select("o_orderkey", F.date_format("o_orderdate", "MM").alias("month"))
    tables.laid_out(rows, ["month"]).write.partitionBy("month").parquet(path)

    def load(mode, predicate):
        loaded = loads.load_hive(spark, path, mode, predicate, require_filter=True)
        return loaded.select(F.lit(mode).alias("mode"), "o_orderkey", F.col("month").cast("string").alias("month"))

    return load("AUTO", "month = 2").unionByName(load("STRINGS", "month = '02'"))


@query("w_manifest_source", f"SELECT {_ORDERS} FROM orders WHERE o_orderpriority <> '5-LOW'")
def _(spark, sf):
    root, manifest = scratch_dir(spark, "parts"), scratch_dir(spark, "manifest")
    rows = _orders(spark, sf).select(*ORDER_COLUMNS).withColumn("folder", F.col("o_orderpriority"))
    tables.laid_out(rows, ["folder"]).write.partitionBy("folder").parquet(root)
    files = spark.read.parquet(root).filter("folder <> '5-LOW'").select(loads.file_path().alias("value"))
    _write_lines(files.distinct(), manifest)
    return loads.load_manifest(spark, manifest).select(*ORDER_COLUMNS)


@query(
    "w_write_mode",
    """SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F'""",
)
def _(spark, sf):
    """Filled while empty, replaced, emptied under the same schema, then appended to."""
    path = scratch_dir(spark, "table")
    rows = _orders(spark, sf)
    part = lambda s: rows.filter(F.col("o_orderstatus") == s)
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    tables.write_table(rows.select(*ORDER_COLUMNS), path, "empty")
    tables.write_table(part("P").select(*columns), path, "truncate")
    tables.write_table(part("O").select("o_totalprice", "o_orderkey"), path, "truncate_data")
    return tables.write_table(part("F").select(*columns), path, "append")


@query(
    "w_schema_update",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def _(spark, sf):
    rows = _orders(spark, sf)
    current = rows.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice")
    incoming = rows.filter("o_orderstatus = 'P'").select("o_orderkey", "o_orderpriority")
    path = scratch_dir(spark, "table")
    tables.write_table(current, path)
    stored, _schema = tables.append_updating(incoming, path, current.schema, allow_addition=True, allow_relaxation=True)
    return stored


_BY_UNIT = {"HOUR": "%Y%m%d%H", "DAY": "%Y%m%d", "MONTH": "%Y%m", "YEAR": "%Y"}


@query(
    "w_time_partition",
    " UNION ALL ".join(
        f"""SELECT '{unit}' AS unit, strftime(ts, '{pattern}') AS partition_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2"""
        for unit, pattern in _BY_UNIT.items()
    ),
)
def _(spark, sf):
    rows = views.table(spark, sf, "events").select("event_id", "ts")
    counts = []
    for unit in _BY_UNIT:
        dated = tables.time_partition(rows, "ts", unit)
        if unit == "DAY":
            dated = tables.write_table(dated, scratch_dir(spark, "days"), partition_by=["partition_id"])
        n = dated.groupBy(F.col("partition_id").cast("string").alias("partition_id")).agg(F.count(F.lit(1)).alias("n"))
        counts.append(n.select(F.lit(unit).alias("unit"), "partition_id", "n"))
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query(
    "w_partition_expiry",
    """SELECT event_id, strftime(ts, '%Y%m%d') AS partition_id FROM events
       WHERE date_trunc('day', ts) + INTERVAL 10 DAY > TIMESTAMP '2024-01-25 12:00:00'""",
)
def _(spark, sf):
    dated = tables.time_partition(views.table(spark, sf, "events").select("event_id", "ts"), "ts")
    stored = tables.write_table(dated, scratch_dir(spark, "days"), partition_by=["partition_id"])
    now = F.lit("2024-01-25 12:00:00").cast("timestamp")
    kept = tables.unexpired(stored, 10 * 24 * 3600, now)
    return kept.select("event_id", F.col("partition_id").cast("string").alias("partition_id"))


@query(
    "w_partition_expiry_dropped",
    """SELECT event_id, strftime(ts, '%Y%m%d') AS partition_id FROM events
       WHERE date_trunc('day', ts) + INTERVAL 10 DAY > TIMESTAMP '2024-01-25 12:00:00'""",
)
def _(spark, sf):
    """Folders of expired days are deleted; the table is then read without any condition."""
    dated = tables.time_partition(views.table(spark, sf, "events").select("event_id", "ts"), "ts")
    path = scratch_dir(spark, "days")
    tables.write_table(dated, path, partition_by=["partition_id"])
    tables.drop_expired(spark, path, 10 * 24 * 3600, F.lit("2024-01-25 12:00:00").cast("timestamp"))
    return spark.read.parquet(path).select("event_id", F.col("partition_id").cast("string").alias("partition_id"))


@query(
    "w_range_partition",
    """WITH v AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 9007199254740992 + o_custkey ELSE o_custkey END AS k FROM orders)
       SELECT CAST(CASE WHEN k >= 100 AND k < 9007199254742000 THEN 100 + (k - 100) // 7919 * 7919 END AS BIGINT) AS bucket_start,
       CAST(count(*) AS BIGINT) AS n FROM v GROUP BY 1""",
)
def _(spark, sf):
    """Keys of low orders lie where a double no longer tells neighbours apart."""
    far = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(2**53) + F.col("o_custkey")).otherwise(F.col("o_custkey"))
    keyed = _orders(spark, sf).select("o_orderkey", far.alias("k"))
    buckets = tables.range_partition(keyed, "k,100,9007199254742000,7919")
    tables.write_table(buckets, path := scratch_dir(spark, "ranges"), partition_by=["bucket_start"])
    stored = spark.read.schema("o_orderkey bigint, bucket_start bigint").parquet(path)
    return stored.groupBy("bucket_start").agg(F.count(F.lit(1)).alias("n"))


@query("w_clustering", f"SELECT {_ORDERS}, true AS in_order, true AS apart FROM orders")
def _(spark, sf):
    """With each row, whether its file is sorted and shares no key range with another file."""
    rows = _orders(spark, sf).select(*ORDER_COLUMNS)
    stored = tables.write_table(rows, scratch_dir(spark, "clustered"), cluster_by=["o_orderpriority", "o_custkey"])
    key = F.struct("o_orderpriority", "o_custkey")
    placed = stored.select("*", loads.file_path().alias("file"), key.alias("key")).withColumn("id", F.monotonically_increasing_id())
    before = F.lag("key").over(W.partitionBy("file").orderBy("id"))
    files = placed.withColumn("ok", F.coalesce(before <= F.col("key"), F.lit(True))).groupBy("file").agg(
        F.bool_and("ok").alias("in_order"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    # one row per file
    ranged = files.withColumn("apart", F.coalesce(F.lag("high").over(W.orderBy("low", "high")) <= F.col("low"), F.lit(True)))
    return placed.join(ranged.select("file", "in_order", "apart"), "file").select(*ORDER_COLUMNS, "in_order", "apart")


@query(
    "w_require_filter",
    """SELECT event_id FROM events WHERE strftime(ts, '%Y%m%d') BETWEEN '20240105' AND '20240107'""",
)
def _(spark, sf):
    dated = tables.time_partition(views.table(spark, sf, "events").select("event_id", "ts"), "ts")
    path = scratch_dir(spark, "days")
    tables.write_table(dated, path, partition_by=["partition_id"])
    return tables.read_partitions(spark, path, "partition_id", "20240105", "20240107").select("event_id")


@query(
    "w_extract",
    """SELECT 'CSV' AS fmt, c_custkey, c_name, c_acctbal FROM customer
       UNION ALL SELECT 'NEWLINE_DELIMITED_JSON', c_custkey, c_name, c_acctbal FROM customer
       UNION ALL SELECT 'PARQUET', c_custkey, c_name, c_acctbal FROM customer""",
)
def _(spark, sf):
    rows = views.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    schema, stored = loads.schema_from_text("c_custkey:INTEGER,c_name,c_acctbal:FLOAT"), []
    for fmt, codec in (("CSV", "GZIP"), ("NEWLINE_DELIMITED_JSON", "DEFLATE"), ("PARQUET", "ZSTD")):
        path = scratch_dir(spark, "extract")
        tables.extract(rows, path, fmt, "tab", compression=codec)
        if fmt == "CSV":
            back = loads.load_csv(spark, path, schema, "tab", skip_rows=1)
        elif fmt == "PARQUET":
            back = loads.load_columnar(spark, path)
        else:
            back = loads.load_json(spark, path, schema)
        stored.append(back.select(F.lit(fmt).alias("fmt"), *rows.columns))
    return stored[0].unionByName(stored[1]).unionByName(stored[2])


@query(
    "w_copy_tables",
    """SELECT c_custkey AS "key", c_name AS "name" FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""",
)
def _(spark, sf):
    customers = views.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    suppliers = views.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return tables.copy_tables([customers, suppliers], scratch_dir(spark, "copy"))


@query(
    "w_shards_to_partitions",
    """SELECT CAST(year(o_orderdate) AS VARCHAR) AS partition_id, o_orderkey,
       CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice FROM orders""",
)
def _(spark, sf):
    """Yearly tables to one partitioned table; 1996 is there already and is kept."""
    root, target = scratch_dir(spark, "shards"), scratch_dir(spark, "partitioned")
    rows = _orders(spark, sf).select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    newer = rows.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    # one write: the partition column's name and separator make the folder names
    folders = newer.withColumn("shard", F.concat(F.lit("orders_"), F.col("year").cast("string"))).drop("year")
    every = newer.drop("year").withColumn("shard", F.lit("orders_latest"))
    tables.laid_out(folders.unionByName(every), ["shard"]).write.partitionBy("shard").parquet(root)
    before = rows.filter("year = 1996").select("o_orderkey", "o_totalprice", F.lit("1996").alias("partition_id"))
    tables.write_table(before, target, partition_by=["partition_id"])
    schema = rows.drop("year").schema
    return tables.shards_to_partitions(spark, root, "shard=orders_", schema, target, "YEAR", no_clobber=True)


@query(
    "w_head",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100 OFFSET 200""",
)
def _(spark, sf):
    return tables.head(_orders(spark, sf), ["o_totalprice", "o_orderkey"], 200, fields=["o_orderkey", "o_totalprice"])


@query(
    "w_head_nested",
    """SELECT conv_id, turn, role FROM conversations ORDER BY conv_id, turn LIMIT 50 OFFSET 10""",
)
def _(spark, sf):
    said = views.table(spark, sf, "conversations").select("conv_id", "turn", F.struct("role", "text").alias("said"))
    return tables.head(said, ["conv_id", "turn"], 10, 50, ["conv_id", "turn", "said.role"])


@query(
    "w_nested_rows",
    """SELECT conv_id, turn, role, "text", word FROM (SELECT conv_id, turn, role, "text",
       unnest(string_split("text", ' ')) AS word FROM conversations)""",
)
def _(spark, sf):
    """Messages in wire form to records with repeated words, then flattened."""
    def cell(value):
        return F.concat(F.lit('{"v":'), value, F.lit("}"))

    def quoted(column):
        # one JSON string: the array's text without its brackets
        text = F.to_json(F.array(column))
        return F.substring(text, F.lit(2), F.char_length(text) - 2)

    def record(*cells):
        return F.concat(F.lit('{"f":['), F.concat_ws(",", *cells), F.lit("]}"))

    words = F.transform(F.split("text", " "), lambda w: cell(quoted(w)))
    said = record(cell(quoted("role")), cell(quoted("text")))
    line = record(
        cell(quoted(F.col("conv_id").cast("string"))), cell(quoted(F.col("turn").cast("string"))), cell(said),
        cell(F.concat(F.lit("["), F.concat_ws(",", words), F.lit("]"))),
    )
    lines = spread(views.table(spark, sf, "conversations")).select(line.alias("value"))
    schema = spark.range(0).selectExpr(
        "id AS conv_id", "id AS turn", "named_struct('role', '', 'text', '') AS said", "array('') AS word"
    ).schema
    flat = tables.flatten_rows(tables.nested_rows(lines, schema), "word")
    return flat.select("conv_id", "turn", "said.role", "said.text", "word")


@query(
    "w_map_to_structs",
    """SELECT event_id, 'k' AS "key", CAST(json_extract_string(props, '$.k') AS INTEGER) AS "value" FROM events""",
)
def _(spark, sf):
    maps = views.table(spark, sf, "events").select("event_id", F.from_json("props", "map<string,int>").alias("props"))
    return tables.flatten_rows(tables.map_to_structs(maps, "props"), "props")


@query(
    "w_insert_rows",
    """SELECT event_id, event_type, "value" FROM events WHERE event_type NOT IN ('click', 'error')""",
)
def _(spark, sf):
    """The same lines sent twice; lines with an unknown key or a wrong type are skipped."""
    lines = tables.numbered_lines(spark, _write_lines(_event_lines(spark, sf), scratch_dir(spark, "lines")))
    path, schema = scratch_dir(spark, "table"), loads.schema_from_text(EVENT_FIELDS)
    for _attempt in range(2):
        stored = tables.insert_rows(lines, schema, path, "load", skip_invalid=True, template_suffix="_eu")
    return stored.drop("insert_id")


@query(
    "w_query_params",
    """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000.5
       AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
)
def _(spark, sf):
    args = tables.query_args([
        "status::F", "least:FLOAT64:100000.5", 'wanted:ARRAY<STRING>:["1-URGENT", "2-HIGH"]',
        "days:RANGE<DATE>:[1996-01-01, 1998-01-01)", "other:STRUCT<a INT64, b ARRAY<INT64>>:{\"a\": 1, \"b\": [2, 3]}",
    ])
    text = """SELECT o_orderkey, o_totalprice, o_orderpriority FROM {orders}
              WHERE o_orderstatus = :status AND o_totalprice >= :least AND array_contains(:wanted, o_orderpriority)
              AND o_orderdate >= :days.start AND o_orderdate < :days.end AND :other.b[0] = :other.a + 1"""
    return spark.sql(text, args=args, orders=_orders(spark, sf))


@query(
    "w_query_to_table",
    """SELECT o_orderpriority, o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ALL""",
)
def _(spark, sf):
    text = "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM {orders} GROUP BY ALL"
    return tables.query_to_table(
        spark, text, scratch_dir(spark, "result"), "empty", ["o_orderpriority"], ["o_orderstatus"], orders=_orders(spark, sf)
    )


@query(
    "w_query_external",
    """SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, max(o_totalprice) AS top FROM orders GROUP BY o_orderstatus""",
)
def _(spark, sf):
    path = scratch_dir(spark, "csv")
    _orders(spark, sf).select(*ORDER_COLUMNS).write.option("sep", ";").csv(path)
    text = "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top FROM {external} GROUP BY o_orderstatus"
    return tables.query_external(spark, text, "external", "csv", path, loads.schema_from_text(ORDER_FIELDS), sep=";")


@query(
    "w_continuous_query",
    """SELECT event_id, upper(event_type) AS kind FROM events WHERE "value" > 10""",
)
def _(spark, sf):
    topic, out, state = (scratch_dir(spark, n) for n in ("topic", "out", "state"))
    rows = views.table(spark, sf, "events").select("event_id", "event_type", "value")
    rows.write.json(topic)
    stream = spark.readStream.schema(rows.schema).json(topic)
    text = "SELECT event_id, upper(event_type) AS kind FROM arriving_events WHERE value > 10"
    jobs.drain(tables.continuous_query(spark, text, "arriving_events", stream, out, state, jobs.DRAIN))
    return spark.read.schema("event_id bigint, kind string").parquet(out)


@query(
    "w_continuous_query_totals",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS n, max(event_id) AS newest, CAST(sum(user_id) AS BIGINT) AS visitors FROM events GROUP BY event_type""",
)
def _(spark, sf):
    """Totals over a growing folder: drained after each of three parts, stored once in between."""
    topic, out, state = (scratch_dir(spark, n) for n in ("topic", "out", "state"))
    rows = views.table(spark, sf, "events").select("event_id", "event_type", "user_id")
    text = "SELECT event_type, count(*) AS n, max(event_id) AS newest, sum(user_id) AS visitors FROM arriving_rows GROUP BY event_type"
    schema = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("newest"), F.sum("user_id").alias("visitors")).schema
    for part in range(3):
        rows.where(F.col("event_id") % 3 == part).write.mode("append").json(topic)
        stream = spark.readStream.schema(rows.schema).json(topic)
        jobs.drain(totals.start_totals(spark, text, "arriving_rows", stream, out, state))
        if part == 1:
            totals.compact_totals(spark, out, schema, ["event_type"])
    return totals.read_totals(spark, out, schema, ["event_type"])


@query(
    "w_query_udf",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'middle' ELSE 'large' END AS class FROM orders""",
)
def _(spark, sf):
    definition = """price_class(price DOUBLE) RETURNS STRING
        RETURN CASE WHEN price < 100000 THEN 'small' WHEN price < 300000 THEN 'middle' ELSE 'large' END"""
    text = "SELECT o_orderkey, price_class(o_totalprice) AS class FROM {orders}"
    return tables.query_with_function(spark, definition, text, orders=_orders(spark, sf))


POLICIES = [
    ("urgent", ["ana", "ben"], "o_orderpriority = '1-URGENT'"),
    ("open", ["ben"], "o_orderstatus = 'O'"),
]


@query(
    "w_row_policy",
    """SELECT 'ana' AS caller, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'
       UNION ALL SELECT 'ben', o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus = 'O'""",
)
def _(spark, sf):
    seen = [
        tables.row_policy(_orders(spark, sf), POLICIES, who).select(F.lit(who).alias("caller"), "o_orderkey")
        for who in ("ana", "ben", "eve")
    ]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@query(
    "w_materialized_view",
    """SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_orderpriority""",
)
def _(spark, sf):
    """Computed once; the second read, a minute later, is served from the store."""
    view = tables.MaterializedView(
        scratch_dir(spark, "view"),
        lambda: _orders(spark, sf).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")),
        max_staleness=3600,
    )
    view.read(spark, now=1_000.0)
    return view.read(spark, now=1_060.0)


@query(
    "w_materialized_view_incremental",
    """SELECT o_orderpriority, CAST(count(o_custkey) AS BIGINT) AS n, CAST(sum(o_custkey) AS BIGINT) AS customers,
       min(o_orderkey) AS first_order, max(o_orderkey) AS last_order, avg(o_custkey) AS middle
       FROM orders WHERE o_orderkey % 3 <> 1 GROUP BY o_orderpriority""",
)
def _(spark, sf):
    """Refreshed after each change of the table: two parts come, then one goes and another comes."""
    table, path = scratch_dir(spark, "orders"), scratch_dir(spark, "view")
    view = IncrementalView(
        table, path, ["o_orderpriority"],
        {
            "n": ("count", "o_custkey"), "customers": ("sum", "o_custkey"), "first_order": ("min", "o_orderkey"),
            "last_order": ("max", "o_orderkey"), "middle": ("avg", "o_custkey"),
        },
    )
    orders = _orders(spark, sf).select(*ORDER_COLUMNS)
    now = 1000.0
    for part in (0, 1):
        orders.where(F.col("o_orderkey") % 3 == part).write.parquet(f"{table}/part={part}")
        view.refresh(spark, now := now + 60)
    remove(spark, f"{table}/part=1")
    orders.where(F.col("o_orderkey") % 3 == 2).write.parquet(f"{table}/part=2")
    return view.read(spark, now + 60)
