"""Column expressions on hand-made edge rows."""

import pytest
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.functions import clocks, defaults, features, globs, labels, messages, units
from flightlake.operators import training
from tests.conftest import rows

DELAYS = [(-15.1, 0), (-15.0, 1), (-0.1, 1), (0.0, 2), (29.9, 2), (30.0, 3), (None, 3)]


def test_delay_class_edges_and_null(spark):
    df = spark.createDataFrame(DELAYS, "ArrDelay double, want int")
    assert df.filter(features.delay_class() != F.col("want")).count() == 0


def test_bucketizer_keeps_null_and_marks_nan(spark):
    df = spark.createDataFrame([(d,) for d, _ in DELAYS] + [(float("nan"),)], "ArrDelay double")
    out = features.delay_bucketizer().transform(df)
    got = {str(r.ArrDelay): r.ArrDelayBucket for r in out.collect()}
    assert got["None"] is None and got["nan"] == 4.0
    assert [got[str(d)] for d, _ in DELAYS[:-1]] == [float(c) for _, c in DELAYS[:-1]]


def test_route_null_rules(spark):
    df = spark.createDataFrame(
        [("A", "B"), (None, "B"), ("A", None), (None, None)], "Origin string, Dest string"
    )
    out = df.select(features.route_skip_nulls().alias("skip"), features.route_or_null().alias("strict"))
    assert [tuple(r) for r in out.collect()] == [("A-B", "A-B"), ("B", None), ("A", None), ("", None)]


def test_null_delay_survives_the_null_drop(spark):
    row = ("AA", "ATL", "SFO", 5.0, 100.0, 1, 2, 3, None)
    names = "Carrier string, Origin string, Dest string, DepDelay double, Distance double, DayOfMonth int, DayOfWeek int, DayOfYear int, ArrDelay double"
    missing = ("AA", "ATL", None, 5.0, 100.0, 1, 2, 3, 1.0)
    out = training.training_set(spark.createDataFrame([row, missing], names)).collect()
    assert [(r.Route, r.ArrDelayBucket) for r in out] == [("ATL-SFO", 3)]


def test_weekday_counts_from_monday(spark):
    df = spark.createDataFrame(
        [("2016-12-25",), ("2024-01-01",), ("2024-02-29",), ("2024-12-31",), ("soon",)], "FlightDate string"
    )
    out = df.select("FlightDate", *[c.alias(n) for n, c in clocks.date_parts().items()])
    assert [tuple(r) for r in out.collect()] == [
        ("2016-12-25", 360, 25, 6), ("2024-01-01", 1, 1, 0), ("2024-02-29", 60, 29, 3),
        ("2024-12-31", 366, 31, 1), ("soon", None, None, None),
    ]


def _lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_first_policy_fills_by_field_and_keeps_zero(spark):
    lines = _lines(
        spark, '{"UUID":"u1","Carrier":"","Origin":null,"DepDelay":0,"DayOfWeek":0}', "not json"
    )
    parsed = messages.parse_messages(lines, schemas.REQUEST)
    got = rows(
        defaults.fill_by_field(parsed),
        "UUID", "Carrier", "Origin", "Dest", "DepDelay", "Distance", "DayOfWeek", "DayOfYear", "Route",
    )
    assert got == sorted(
        [("u1", "AA", "LAX", "JFK", 0.0, 500.0, 0, 1, "LAX-JFK"), (None, "AA", "LAX", "JFK", 0.0, 500.0, 1, 1, "LAX-JFK")],
        key=str,
    )


def test_second_policy_absent_null_and_zero(spark):
    lines = _lines(
        spark,
        '{"UUID":"u1","Carrier":null,"DepDelay":2.5,"DayOfWeek":0,"DayOfMonth":7}',
        '{"UUID":"u2","Carrier":"AA","Origin":"A","Dest":"B","Distance":"far"}',
        "not json", "[1]", "{}",
    )
    out = defaults.fill_or_fail(lines)
    good, bad = defaults.split_failed(out)
    assert rows(bad) == sorted([
        ('{"UUID":"u2","Carrier":"AA","Origin":"A","Dest":"B","Distance":"far"}', "Distance is no number"),
        ("not json", "no JSON object"), ("[1]", "no JSON object"),
    ])
    got = rows(good, "echo_UUID", "Carrier", "Origin", "Route", "DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "echo_Carrier")
    assert got == sorted(
        [("u1", "None", "", "-", 2.5, 0.0, 7, 1, None), ("", "", "", "-", 0.0, 0.0, 1, 1, "")], key=str
    )


def test_wrong_typed_field_is_null_and_extra_field_ignored(spark):
    lines = _lines(spark, '{"UUID":"u","DepDelay":"late","Distance":5,"Gate":"B2"}', "[1]", "not json")
    got = rows(messages.parse_messages(lines, schemas.REQUEST), "UUID", "DepDelay", "Distance")
    assert got == sorted([("u", None, 5.0), (None, None, None), (None, None, None)], key=str)


def test_json_null_fields_dropped_or_kept(spark):
    df = spark.createDataFrame([("u", None)], "UUID string, Distance double")
    assert messages.emit_json(df, df.columns).first().value == '{"UUID":"u"}'
    assert messages.emit_json(df, df.columns, keep_nulls=True).first().value == '{"UUID":"u","Distance":null}'


def test_missing_path_discards_the_record(spark):
    lines = _lines(spark, '{"Origin":"A","Dest":"B","Distance":1}', '{"Origin":"A"}', "not json")
    paths = {"origin": "$.Origin", "dest": "$.Dest", "distance": "$.Distance"}
    assert rows(messages.extract_paths(lines, paths)) == [("A", "B", "1")]


@pytest.mark.parametrize(
    "text, want",
    [
        ("2016-12-25T10:11:12.123456", "2016-12-25 10:11:12.123456"),
        ("2016-12-25T10:11:12Z", "2016-12-25 10:11:12.000000"),
        ("1482660672123", "2016-12-25 10:11:12.123000"),
        ("2016", "2016-01-01 00:00:00.000000"), ("5", "1970-01-01 00:00:00.005000"),
        ("yesterday", None), ("", None),
    ],
)
def test_timestamps_in_several_forms(spark, text, want):
    df = _lines(spark, text).select(F.date_format(clocks.parse_any(F.col("value")), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert df.first()[0] == want


def test_labels(spark):
    df = spark.createDataFrame([(float(n),) for n in range(5)] + [(None,)], "p double")
    four = [r[0] for r in df.select(labels.live_label(F.col("p"))).collect()]
    three = [r[0] for r in df.select(labels.batch_label(F.col("p"))).collect()]
    assert four[:4] == list(labels.LIVE_LABELS.values()) and four[4] == "Prediction: 4.0"
    assert three == [*labels.BATCH_LABELS.values(), "", "", ""]
    text = df.select(labels.prediction_text(F.col("p"))).collect()
    assert text[2][0] == "2.0" and text[5][0] == "0.0"


def test_axis_label_edges(spark):
    got = _lines(spark, "a" * 14, "a" * 15).select(labels.axis_label(F.col("value"))).collect()
    assert [r[0] for r in got] == ["a" * 14, "a" * 14 + "..."]


@pytest.mark.parametrize(
    "size, want",
    [(0, "0 B"), (1023, "1023 B"), (1024, "1 KiB"), (1536, "1.5 KiB"), (1152, "1.12 KiB"), (1048575, "1024 KiB"),
     (1048576, "1 MiB"), (5 * 2**40, "5 TiB"), (2**60, "1 EiB")],
)
def test_human_size(spark, size, want):
    assert spark.range(1).select(units.human_size(F.lit(size).cast("bigint"))).first()[0] == want


@pytest.mark.parametrize("number, want", [(0, "0"), (999, "999"), (1000, "1.0k"), (123456789, "123.5m"), (4 * 10**15, "4.0q")])
def test_short_count(spark, number, want):
    assert spark.range(1).select(units.short_count(F.lit(number).cast("bigint"))).first()[0] == want


PATHS = ["a/b/c.txt", "a/c.txt", "c.txt", "a/b/d/c.txt", "x/b.txt"]


@pytest.mark.parametrize(
    "pattern, want",
    [
        ("a/*/c.txt", ["a/b/c.txt"]),
        ("a/**/c.txt", ["a/b/c.txt", "a/b/d/c.txt", "a/c.txt"]),
        ("**/c.txt", ["a/b/c.txt", "a/b/d/c.txt", "a/c.txt", "c.txt"]),
        ("*.txt", ["c.txt"]),
        ("**.txt", sorted(PATHS)),
        ("?/[b-d].txt", ["a/c.txt", "x/b.txt"]),
        ("?/[!c].txt", ["x/b.txt"]),
    ],
)
def test_wildcards(spark, pattern, want):
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    got = df.filter(globs.matches_wildcard(F.col("path"), pattern))
    assert sorted(r.path for r in got.collect()) == want
