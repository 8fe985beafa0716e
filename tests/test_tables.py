"""Loads and table operations: edges and refusals."""

from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.operators import tables
from flightlake.sources import loads, writers
from tests.conftest import rows


def _file(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def _lines(spark, *texts):
    return spark.createDataFrame(list(zip(texts, range(1, len(texts) + 1))), "value string, line_no bigint")


def test_schema_text(spark):
    schema = loads.schema_from_text("a:INTEGER, b ,c:numeric")
    assert [f.dataType.simpleString() for f in schema] == ["bigint", "string", "decimal(38,9)"]
    for wrong in ("", "a:b:c", ":STRING", "a:HUGE"):
        with pytest.raises(ValueError):
            loads.schema_from_text(wrong)


def test_leading_rows_and_null_markers(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        _file(tmp_path, name, "title\nk|v\n1|x\n2|NA\n3|-\n")
    schema = loads.schema_from_text("k:INTEGER,v")
    loaded = loads.load_csv(spark, str(tmp_path), schema, "|", skip_rows=2, null_markers=["NA", "-"])
    assert rows(loads.accept(loaded)) == sorted(2 * [(1, "x"), (2, None), (3, None)], key=str)


def test_blank_leading_lines_count_and_data_stays(spark, tmp_path):
    _file(tmp_path, "a.csv", "title\n\n1,a\n\n2,b\n")
    _file(tmp_path, "b.csv", "\n\n3,c\n")
    schema = loads.schema_from_text("k:INTEGER,v")
    loaded = loads.load_csv(spark, str(tmp_path), schema, skip_rows=2)
    assert rows(loads.accept(loaded)) == [(1, "a"), (2, "b"), (3, "c")]
    (tmp_path / "h").mkdir()
    one = loads.load_csv(spark, _file(tmp_path / "h", "c.csv", "\n4,d\n"), schema, skip_rows=1)
    assert rows(loads.accept(one)) == [(4, "d")]


def test_header_row_and_quoted_newlines(spark, tmp_path):
    path = _file(tmp_path, "q.csv", 'k,v\n1,"two\nlines, ""quoted"""\n')
    schema = loads.schema_from_text("k:INTEGER,v")
    loaded = loads.load_csv(spark, path, schema, skip_rows=1, quoted_newlines=True)
    assert rows(loads.accept(loaded)) == [(1, 'two\nlines, "quoted"')]


def test_bad_records_up_to_a_limit(spark, tmp_path):
    path = _file(tmp_path, "b.csv", "1,x\nbad,y\n3,z\n4,a,extra\n")
    loaded = loads.load_csv(spark, path, loads.schema_from_text("k:INTEGER,v"))
    assert rows(loads.accept(loaded, max_bad=2)) == [(1, "x"), (3, "z")]
    with pytest.raises(loads.TooManyBadRecords, match="2 bad"):
        loads.accept(loaded, max_bad=1)


def test_jagged_rows(spark, tmp_path):
    path = _file(tmp_path, "j.csv", '1\n2,"x,y"\n3,z\n')
    schema = loads.schema_from_text("k:INTEGER,v")
    assert rows(loads.accept(loads.load_csv(spark, path, schema, jagged=True))) == [(1, None), (2, "x,y"), (3, "z")]
    with pytest.raises(loads.TooManyBadRecords):
        loads.accept(loads.load_csv(spark, path, schema))
    wrong = _file(tmp_path, "w.csv", "xyz\n4\n")
    for jagged, good in ((True, [(4, None)]), (False, [])):
        loaded = loads.load_csv(spark, wrong, schema, jagged=jagged)
        assert rows(loads.accept(loaded, max_bad=2 - len(good))) == good
        with pytest.raises(loads.TooManyBadRecords):
            loads.accept(loaded, max_bad=1 - len(good))


def test_formats_with_markers(spark, tmp_path):
    path = _file(tmp_path, "d.csv", "12/25/2016,n\n-,n\nsoon,n\n")
    schema = loads.schema_from_text("d:DATE,v")
    loaded = loads.load_csv(spark, path, schema, null_markers=["-", "NA"], date_format="MM/dd/yyyy")
    got = rows(loads.accept(loaded.withColumn("d", F.col("d").cast("string")), max_bad=1))
    assert got == sorted([("2016-12-25", "n"), (None, "n")], key=str)


def test_unknown_json_keys(spark, tmp_path):
    path = _file(tmp_path, "e.json", '{"k":1}\n{"k":2,"z":3}\nnot json\n{"k":"x"}\n')
    schema = loads.schema_from_text("k:INTEGER")
    assert rows(loads.accept(loads.load_json(spark, path, schema), max_bad=2)) == [(1,), (2,)]
    assert rows(loads.accept(loads.load_json(spark, path, schema, ignore_unknown=False), max_bad=3)) == [(1,)]


def test_column_names(spark):
    df = spark.range(1).select(F.lit(1).alias("a b"), F.lit(2).alias("2x"))
    assert loads.column_names(df, "V1").columns == ["a_b", "_2x"]
    assert loads.column_names(df, "V2").columns == ["a b", "2x"]
    with pytest.raises(ValueError, match="invalid"):
        loads.column_names(df)
    with pytest.raises(ValueError, match="collide"):
        loads.column_names(spark.range(1).select(F.lit(1).alias("a b"), F.lit(2).alias("a_b")), "V1")


def test_columns_by_name_or_position(spark, tmp_path):
    path = _file(tmp_path, "m.csv", "v,k\nx,1\n")
    schema = loads.schema_from_text("k:INTEGER,v")
    assert rows(loads.load_csv_matched(spark, path, schema, "NAME").select("k", "v")) == [(1, "x")]
    folder = tmp_path / "differ"
    folder.mkdir()
    for name, text in (("a.csv", 'k,v\n1,"a,b"\nbad,y\n'), ("b.csv", "v,other,k\nx,0,2\n"), ("c.csv", "v\nz\n")):
        _file(folder, name, text)
    matched = loads.load_csv_matched(spark, str(folder), schema, "NAME")
    got = rows(matched.withColumn("bad", F.col(loads.CORRUPT).isNotNull()).drop(loads.CORRUPT))
    assert got == sorted([(1, "a,b", False), (None, "y", True), (2, "x", False), (None, "z", False)], key=str)
    by_position = loads.load_csv_matched(spark, path, schema, "POSITION").select("k", "v")
    assert rows(by_position) == [(None, "1")]


def test_decimal_targets(spark):
    both = ["NUMERIC", "BIGNUMERIC", "STRING"]
    assert loads.decimal_target(38, 9, both) == "NUMERIC"
    assert loads.decimal_target(38, 10, both) == "BIGNUMERIC"
    assert loads.decimal_target(77, 38, both) == "STRING"
    assert loads.decimal_target(38, 20, ["NUMERIC"]) == "NUMERIC"
    df = spark.createDataFrame([("1.1234567895",)], "t string")
    assert df.select(loads.to_decimal(F.col("t"), "NUMERIC", rounding=True)).first()[0] == Decimal("1.123456790")
    with pytest.raises(Exception, match="more than 9 fraction digits"):
        df.select(loads.to_decimal(F.col("t"), "NUMERIC")).collect()


def test_hive_filter_is_required(spark, tmp_path):
    with pytest.raises(ValueError):
        loads.load_hive(spark, str(tmp_path), require_filter=True)


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    two = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.write_table(two, path, "empty")
    with pytest.raises(ValueError, match="not empty"):
        tables.write_table(two, path, "empty")
    tables.write_table(two, path)
    assert tables.existing(spark, path).count() == 2
    kept = tables.write_table(spark.createDataFrame([(5,)], "k bigint"), path, "truncate_data")
    assert rows(kept) == [(5, None)] and kept.schema["k"].dataType == T.IntegerType()
    with pytest.raises(ValueError, match="not in the table"):
        tables.write_table(two.withColumnRenamed("v", "w"), path, "truncate_data")
    assert tables.write_table(spark.range(3), path, "truncate").columns == ["id"]
    assert tables.existing(spark, str(tmp_path / "none")) is None


def test_schema_updates_need_permission(spark):
    need = T.StructType([T.StructField("k", T.LongType(), False)])
    more = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.StringType())])
    loose = T.StructType([T.StructField("k", T.LongType(), True)])
    assert tables.updated_schema(need, more, allow_addition=True).fieldNames() == ["k", "v"]
    assert tables.updated_schema(need, loose, allow_relaxation=True)["k"].nullable
    with pytest.raises(ValueError, match="column k is"):
        tables.updated_schema(need, T.StructType([T.StructField("k", T.StringType(), False)]))
    for incoming in (more, loose):
        with pytest.raises(ValueError):
            tables.updated_schema(need, incoming)


def test_range_bounds(spark):
    df = spark.createDataFrame([(-1,), (0,), (9,), (10,), (99,), (100,), (None,)], "x int")
    got = {r.x: r.bucket_start for r in tables.range_partition(df, "x,0,100,10").collect()}
    assert got == {-1: None, 0: 0, 9: 0, 10: 10, 99: 90, 100: None, None: None}
    with pytest.raises(ValueError):
        tables.range_partition(df, "x,0,100")


@pytest.mark.parametrize("unit, ids", [("YEAR", ["2015", "2016"]), ("MONTH", ["201511", "201612"]), ("HOUR", ["2016122400", "2016122510"])])
def test_expiry_by_unit(spark, unit, ids):
    df = spark.createDataFrame([(i,) for i in ids], "partition_id string")
    now = F.lit("2016-12-25 12:00:00").cast("timestamp")
    seconds = {"YEAR": 365 * 86400, "MONTH": 30 * 86400, "HOUR": 86400}[unit]
    assert rows(tables.unexpired(df, seconds, now, unit)) == [(ids[1],)]
    assert tables.unexpired(df, 0, now, unit).count() == 2


def test_partitioned_table_refuses_a_whole_scan(spark, tmp_path):
    with pytest.raises(ValueError, match="filter"):
        tables.read_partitions(spark, str(tmp_path), "partition_id")


def test_partition_filter_prunes_folders(spark, tmp_path):
    days = tables.time_partition(spark.createDataFrame([("2016-12-24 01:00:00",), ("2016-12-25 01:00:00",)], "ts string"), "ts")
    tables.write_table(days, str(tmp_path / "d"), partition_by=["partition_id"])
    kept = tables.read_partitions(spark, str(tmp_path / "d"), "partition_id", "20161225")
    assert kept.count() == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_nested_rows_cannot_become_csv(spark, tmp_path):
    nested = spark.range(1).select(F.array("id").alias("ids"))
    with pytest.raises(ValueError, match="nested"):
        tables.extract(nested, str(tmp_path / "x"))
    tables.extract(nested, str(tmp_path / "j"), "NEWLINE_DELIMITED_JSON")
    assert spark.read.text(str(tmp_path / "j")).first().value == '{"ids":[0]}'


def test_shards_with_no_time_are_left_out(spark, tmp_path):
    root, target = str(tmp_path / "shards"), str(tmp_path / "target")
    for suffix, value in (("20161224", 1), ("20161225", 2), ("20161399", 3), ("latest", 4)):
        spark.range(value, value + 1).write.parquet(f"{root}/day_{suffix}")
    schema = spark.range(0).schema
    got = tables.shards_to_partitions(spark, root, "day_", schema, target)
    assert rows(got) == [(1, "20161224"), (2, "20161225")]
    spark.range(9, 10).write.mode("overwrite").parquet(f"{root}/day_20161225")
    spark.range(8, 9).write.parquet(f"{root}/day_20161226")
    kept = tables.shards_to_partitions(spark, root, "day_", schema, target, no_clobber=True)
    assert rows(kept) == [(1, "20161224"), (2, "20161225"), (8, "20161226")]
    replaced = tables.shards_to_partitions(spark, root, "day_", schema, target)
    assert rows(replaced) == [(1, "20161224"), (8, "20161226"), (9, "20161225")]


def test_wire_rows(spark):
    schema = T.StructType().add("k", T.IntegerType()).add("tags", T.ArrayType(T.StringType())).add(
        "in", T.ArrayType(T.StructType().add("a", T.DoubleType()))
    )
    line = '{"f":[{"v":"7"},{"v":[{"v":"x"},{"v":"y"}]},{"v":[{"v":{"f":[{"v":"1.5"}]}},{"v":{"f":[{"v":null}]}}]}]}'
    empty = '{"f":[{"v":"8"},{"v":[]},{"v":[]}]}'
    out = tables.nested_rows(spark.createDataFrame([(line,), (empty,)], "value string"), schema)
    first, second = out.collect()
    assert (first.k, first.tags, [c.a for c in first["in"]]) == (7, ["x", "y"], [1.5, None])
    assert (second.k, second.tags, second["in"]) == (8, [], [])
    flat = tables.flatten_rows(out.select("k", "in"), "in")
    assert rows(flat) == sorted([(7, 1.5), (7, None), (8, None)], key=str)


SCHEMA = "k:INTEGER,v"


def test_inserting_twice_changes_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "t"), loads.schema_from_text(SCHEMA)
    lines = _lines(spark, '{"k":1,"v":"a"}', '{"k":1,"v":"a"}')
    for _ in range(2):
        stored = tables.insert_rows(lines, schema, path, "job")
    assert rows(stored, "k", "insert_id") == [(1, "job_1"), (1, "job_2")]
    # the files themselves hold no repeats, also when a request repeats a line
    again = tables.insert_rows(lines.unionByName(lines), schema, path, "other")
    assert spark.read.parquet(path).count() == again.count() == 4
    for _ in range(2):
        stored = tables.insert_rows(lines, schema, path + "2")
    assert stored.count() == 4


def test_one_invalid_row_fails_the_request(spark, tmp_path):
    path, schema = str(tmp_path / "t"), loads.schema_from_text(SCHEMA)
    lines = _lines(spark, '{"k":1}', '{"k":"x"}', '{"k":2,"z":1}')
    with pytest.raises(loads.TooManyBadRecords):
        tables.insert_rows(lines, schema, path)
    assert tables.existing(spark, path) is None
    assert rows(tables.insert_rows(lines, schema, path, skip_invalid=True), "k") == [(1,)]
    assert rows(tables.insert_rows(lines, schema, path, skip_invalid=True, ignore_unknown=True, template_suffix="_b"), "k") == [(1,), (2,)]


def test_line_numbers(spark, tmp_path):
    writers.write_topic(spark.range(1000).select(F.col("id").cast("string").alias("value")).coalesce(1), str(tmp_path / "l"))
    out = tables.numbered_lines(spark, str(tmp_path / "l"))
    assert out.filter(F.col("value").cast("bigint") + 1 != F.col("line_no")).count() == 0


def test_query_parameters(spark):
    args = tables.query_args(["n:INT64:5", "s::x", "none:INT64:NULL", "r:RANGE<DATE>:[2020-01-01, UNBOUNDED)", "t:ARRAY<FLOAT64>:[1.5, 2]", "b:BOOL:true", "d:NUMERIC:1.25", "st:STRUCT<a INT64, b STRUCT<c STRING, d DATE>>:{\"a\": 1, \"b\": {\"c\": \"y\", \"d\": \"2020-01-01\"}}"])
    got = spark.sql("SELECT :n + 1, :s, :none, :r.start, :r.end, :t[1], :b, :d, :st.b.c, year(:st.b.d)", args=args).first()
    assert [str(v) for v in got] == ["6", "x", "None", "2020-01-01", "None", "2.0", "True", "1.25", "y", "2020"]
    positional = tables.query_args([":INT64:2", "::z"])
    assert spark.sql("SELECT ? * 2, ?", args=positional).first()[:] == (4, "z")
    assert tables._struct_fields("a ARRAY<STRUCT<b ARRAY<INT64>, c INT64>>, d INT64") == [("a", "ARRAY<STRUCT<b ARRAY<INT64>, c INT64>>"), ("d", "INT64")]
    for wrong in (["a"], ["n:INT64:1", ":INT64:2"], ["s:STRUCT<a ARRAY<INT64>:{}"]):
        with pytest.raises(ValueError):
            tables.query_args(wrong)


def test_row_policies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    policies = [("p", ["ana"], "v = 'a'"), ("q", ["ana", "ben"], "k = 3")]
    assert rows(tables.row_policy(df, policies, "ana"), "k") == [(1,), (3,)]
    assert rows(tables.row_policy(df, policies, "ben"), "k") == [(3,)]
    assert tables.row_policy(df, policies, "eve").count() == 0


def test_materialized_view_staleness(spark, tmp_path):
    source = {"rows": 1}
    view = tables.MaterializedView(str(tmp_path / "v"), lambda: spark.range(source["rows"]), refresh_seconds=100, max_staleness=60)
    assert view.read(spark, 1000.0).count() == 1
    source["rows"] = 2
    assert view.read(spark, 1050.0).count() == 1
    assert not view.maintain(spark, 1090.0)
    assert view.read(spark, 1061.0).count() == 2
    assert view.maintain(spark, 1300.0)


def test_continuous_query_view_needs_its_stream(spark):
    with pytest.raises(AnalysisException):
        spark.sql("SELECT * FROM no_such_stream")


def test_sql_function_in_a_query(spark):
    got = tables.query_with_function(spark, "plus_two(x INT) RETURNS INT RETURN x + 2", "SELECT plus_two(id) AS y FROM {t}", t=spark.range(2))
    assert rows(got) == [(2,), (3,)]


def test_expired_folders_are_deleted(spark, tmp_path):
    path = str(tmp_path / "days")
    days = spark.createDataFrame([("20240101", 1), ("20240102", 2), ("20240103", 3), (None, 4)], "partition_id string, v int")
    tables.write_table(days, path, partition_by=["partition_id"])
    now = F.lit("2024-01-04 00:00:00").cast("timestamp")
    assert tables.drop_expired(spark, path, 0, now) == []
    assert tables.drop_expired(spark, path, 2 * 24 * 3600, now) == ["20240101", "20240102"]
    assert rows(spark.read.parquet(path), "v") == [(3,), (4,)]
    assert tables.drop_expired(spark, str(tmp_path / "none"), 5, now) == []
