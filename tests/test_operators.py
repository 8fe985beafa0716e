"""Operators on small tables, among them hot keys and ties."""

import pytest
from pyspark.sql import functions as F

from flightlake.operators import (
    aggregates, encode, groups, joins, latest, numbering, registry, requests, serving, sizing, training,
)
from flightlake.sources import writers
from tests.conftest import rows


def test_numbers_are_dense_with_a_hot_tied_key(spark):
    # a third of the rows are alike
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    out = numbering.number_rows(df.repartition(6), ["k"]).cache()
    assert out.agg(F.min("row_no"), F.max("row_no"), F.countDistinct("row_no")).first()[:] == (1, 9000, 9000)
    # larger keys have larger numbers
    spans = out.groupBy("k").agg(F.min("row_no").alias("a"), F.max("row_no").alias("b")).orderBy("k").collect()
    assert all(x.b + 1 == y.a for x, y in zip(spans, spans[1:]))


def test_unique_numbering_follows_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    out = numbering.number_rows(df, ["k"], unique=True)
    assert out.filter(F.col("row_no") != F.col("k") + 1).count() == 0


def test_numbering_an_empty_table(spark):
    assert numbering.number_rows(spark.range(0), ["id"]).count() == 0


def test_lists_of_a_hot_key_are_bounded_and_whole(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"), F.col("id").alias("v")
    )
    lists = groups.bounded_lists(df, ["key"], ["v"], "vs", max_rows=100).cache()
    assert lists.agg(F.max(F.size("vs"))).first()[0] <= 100
    # keys below the bound are one row each, whatever other keys hold
    short = lists.filter("key <> 'hot'").collect()
    assert len(short) == 50 and {(r.Part, len(r.vs)) for r in short} == {(0, 40)}
    assert rows(lists.select("key", F.explode("vs"))) == rows(df)
    hot = lists.filter("key = 'hot'").orderBy("Part").collect()
    assert [(r.Part, len(r.vs)) for r in hot] == [(i, 100) for i in range(10)] and [v for r in hot for v in r.vs] == list(range(1000))


def test_batches_hold_exactly_n_rows(spark):
    routes = spark.range(250).select(
        F.format_string("O%03d", F.col("id")).alias("Origin"), F.lit("D").alias("Dest"), F.lit(1.5).alias("Distance")
    )
    out = writers.insert_batches(routes).orderBy("batch_no").collect()
    assert [(r.batch_no, r.n) for r in out] == [(0, 100), (1, 100), (2, 50)]
    lines = out[0].text.split("\n")
    assert lines[0] == "BEGIN BATCH" and lines[-1] == "APPLY BATCH;"
    assert lines[1] == "INSERT INTO origin_dest_distances(origin, dest, distance) VALUES ('O000', 'D', 1.5);"


def test_last_write_wins(spark):
    first = spark.createDataFrame([("u", 1, 10), ("u", 2, 20), ("v", 1, 30)], "key string, at int, x int")
    later = spark.createDataFrame([("u", 3, 40), ("w", 1, 50)], "key string, at int, x int")
    assert rows(latest.upsert(first, later, ["key"], ["at"])) == [("u", 3, 40), ("v", 1, 30), ("w", 1, 50)]


def test_stored_prediction_texts(spark):
    texts = [
        '{"UUID":"u","Prediction":2,"Origin":"A","Timestamp":"2016-12-25T10:00:00Z"}', '{"UUID":"v","DepDelay":1}',
        # skipped: unreadable delay, null prediction, unreadable time, no id, no message
        '{"UUID":"w","DepDelay":"late"}', '{"UUID":"w","Prediction":null}', '{"UUID":"w","Timestamp":"soon"}',
        '{"Prediction":1}', "not json",
    ]
    out = latest.store_predictions(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, at int"), ["at"])
    got = rows(out.withColumn("timestamp", F.col("timestamp").cast("string")), "uuid", "prediction", "timestamp", "dep_delay")
    assert got == [("u", "2.0", "2016-12-25 10:00:00", 0.0), ("v", "0.0", None, 1.0)]


def test_the_last_to_arrive_counts_whatever_its_time(spark):
    texts = [f'{{"UUID":"u","Prediction":{n},"Timestamp":"2024-01-0{t}T00:00:00Z"}}' for n, t in ((1, 2), (2, 1))]
    for order in (texts, texts[::-1]):
        lines = spark.createDataFrame([(t, i) for i, t in enumerate(order)], "value string, at int")
        last = "2.0" if order is texts else "1.0"
        assert rows(latest.store_predictions(lines, ["at"]), "prediction") == [(last,)]


def test_equal_order_does_not_leave_the_answer_open(spark):
    cells = [("u", 1, "b"), ("u", 1, "a"), ("u", 1, None)]
    for order in (cells, cells[::-1]):
        df = spark.createDataFrame(order, "key string, at int, v string").coalesce(1)
        assert rows(latest.latest_per_key(df, ["key"], ["at"])) == [("u", 1, "b")]


def test_type_suffixes_are_no_numbers(spark):
    forms = spark.createDataFrame([("5",), ("5d",), ("1e3",), ("-2.5f",), ("",)], "DepDelay string")
    got = requests.typed_form(forms, {"DepDelay": "double"}).collect()
    assert [r.DepDelay for r in got] == [5.0, None, 1000.0, None, None]


def test_unknown_and_null_categories_get_minus_one(spark):
    known = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "Carrier string")
    codes = encode.fit_codes(known, ["Carrier"])
    assert rows(codes, "value", "code") == [("a", 0), ("b", 1), ("c", 2)]
    asked = spark.createDataFrame([("a",), ("zz",), (None,)], "Carrier string")
    for small in ({"Carrier"}, set()):
        got = rows(encode.apply_codes(asked, codes, ["Carrier"], small), "Carrier", "Carrier_code")
        assert got == sorted([("a", 0), ("zz", -1), (None, -1)], key=str)


def test_each_vocabulary_is_measured_by_itself(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("Route"), (F.col("id") % 3).cast("string").alias("Carrier"))
    codes = encode.fit_codes(df, ["Route", "Carrier"])
    assert encode.small_columns(codes, max_rows=100) == {"Carrier"}
    indexed = encode.index_columns(spark.createDataFrame([("2", None), ("x", "0")], "Carrier string, Route string"), codes, ["Carrier", "Route"])
    assert rows(indexed, "Carrier_index", "Route_index") == [(2.0, 200.0), (3.0, 0.0)]


def test_broadcast_only_below_the_measured_limit(spark):
    side = spark.range(100)
    assert sizing.is_small(side) and not sizing.is_small(side, max_rows=99)
    assert not sizing.is_small(side, max_bytes=50)
    joined = spark.range(10).join(sizing.broadcast_if_small(side, max_rows=10), "id")
    assert joined.count() == 10


ROUTES = [("A", "B", 100.0)]


def test_missing_distance_is_reported_or_fails(spark):
    table = spark.createDataFrame(ROUTES, "Origin string, Dest string, Distance double")
    asked = spark.createDataFrame([("A", "B"), ("A", "C")], "Origin string, Dest string")
    assert rows(joins.distance_missing(asked, table)) == [("A", "C")]
    assert rows(joins.distance_lookup(asked, table)) == [("A", "B", 100.0), ("A", "C", None)]
    with pytest.raises(Exception, match="no distance for route A-C"):
        joins.distance_strict(asked, table).collect()


def test_request_from_a_form(spark):
    table = spark.createDataFrame([("ATL", "SFO", 2139.0)], "Origin string, Dest string, Distance double")
    forms = spark.createDataFrame(
        [("5", "AA", "2016-12-25", "SFO", "1519", "ATL"), ("soon", "AA", "2016-12-25", "SFO", "1519", "ATL")],
        "DepDelay string, Carrier string, FlightDate string, Dest string, FlightNum string, Origin string",
    )
    got = rows(requests.request_enrich(forms, table), "DepDelay", "Distance", "DayOfYear", "DayOfMonth", "DayOfWeek")
    assert got == sorted([(5.0, 2139.0, 360, 25, 6), (None, 2139.0, 360, 25, 6)], key=str)
    stamped = requests.request_stamped(forms, table).first()
    assert len(stamped.UUID) == 36 and stamped.Timestamp[10] == "T"


def test_engines_are_matched_on_their_last_answers(spark):
    schema = "UUID string, Prediction double, at int"
    a = spark.createDataFrame([("u", 1.0, 1), ("u", 2.0, 2), ("v", 0.0, 1)], schema)
    b = spark.createDataFrame([("u", 3.0, 1), ("w", 1.0, 1)], schema)
    got = rows(joins.engine_match(a, b, ["at"]))
    assert got == [("u", 2.0, 3.0), ("v", 0.0, None), ("w", None, 1.0)]


def test_fleet_lists_and_counts(spark):
    flights = spark.createDataFrame([("AA", "N1"), ("AA", "N1"), ("AA", "N2"), ("BB", "N3")], "Carrier string, TailNum string")
    out = aggregates.airplanes_per_carrier(flights, max_rows=1)
    assert rows(out.select("Carrier", F.explode("TailNumbers"), "FleetCount")) == [("AA", "N1", 2), ("AA", "N2", 2), ("BB", "N3", 1)]
    assert rows(aggregates.fleet_counts(flights)) == [("AA", 2), ("BB", 1)]


FLIGHTS = [("A", "2016-12-25", i) for i in range(20)]


def test_page_past_the_end_reports_no_matches(spark):
    df = spark.createDataFrame(FLIGHTS, "Carrier string, FlightDate string, DepTime int")
    shown, total = serving.paged(df, ["DepTime"], 15, 15)
    assert (shown.count(), total) == (5, 20)
    assert serving.search_total(df, 15, 15).first()[:] == (5, 20)
    assert serving.page(df, ["DepTime"], 30, 15).count() == 0
    assert serving.search_total(df, 30, 15).first()[:] == (0, 0)


@pytest.mark.parametrize("start", [0, 95, 1234, 2995, 3000])
def test_pages_are_cut_from_slices(spark, monkeypatch, start):
    monkeypatch.setattr(serving, "SLICE_ROWS", 40)
    monkeypatch.setattr(serving, "SLICES", 5)
    hot = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") * 7 % 10).cast("string"))
    df = spark.range(3000).select(hot.alias("k"), F.when(F.col("id") < 900, 0.5).otherwise(F.col("id") / 7).alias("v")).repartition(5)
    cells = sorted(((r.k is None, r.k or "", r.v) for r in df.collect()))
    want = [(None if none else k, v) for none, k, v in cells[start : start + 10]]
    shown, total = serving.paged(df, ["k"], start, 10)
    assert [tuple(r) for r in shown.collect()] == want and total == 3000


def test_search_ignores_case_and_empty_arguments(spark):
    df = spark.createDataFrame([("AA", "ATL"), ("aa", "SFO"), ("BB", "ATL")], "Carrier string, Origin string")
    found = serving.matching(df, {"Carrier": "Aa", "Origin": ""}, ["Carrier", "Origin"])
    assert rows(found) == [("AA", "ATL"), ("aa", "SFO")]


def test_links_are_floored_and_hidden(spark):
    pages = spark.createDataFrame([(0, 15, 10), (15, 30, 100)], "start int, end int, total int")
    got = {r.start: r for r in serving.nav_offsets(pages, 15).collect()}
    assert (got[0].prev_bottom, got[0].prev_top, got[0].prev_shown, got[0].next_shown) == (0, 0, False, False)
    assert (got[15].next_bottom, got[15].next_top, got[15].prev_shown, got[15].next_shown) == (30, 45, True, True)


def test_day_range_includes_midnight_text_of_the_next_day(spark):
    stamps = ["2016-12-24T23:59:59", "2016-12-25", "2016-12-25T23:59:59", "2016-12-26", "2016-12-26T00:00:00"]
    df = spark.createDataFrame([(s, 3.0) for s in stamps], "Timestamp string, Prediction double")
    got = rows(serving.predictions_on_day(df, "2016-12-25"), "Timestamp", "label")
    assert got == [("2016-12-25", ""), ("2016-12-25T23:59:59", ""), ("2016-12-26", "")]


VERSIONS = [("m", 1, "Production"), ("m", 2, "None"), ("m", 3, "Staging"), ("m", 4, "Archived"), ("n", 1, "Production")]


def test_promotion_archives_the_previous_version(spark):
    versions = spark.createDataFrame(VERSIONS, "name string, version int, stage string")
    after = registry.promote(versions)
    assert rows(after) == [("m", 1, "Archived"), ("m", 2, "None"), ("m", 3, "Production"), ("m", 4, "Archived"), ("n", 1, "Production")]
    assert rows(registry.production_of(after, "m"), "version") == [(3,)]
    with pytest.raises(LookupError):
        registry.production_of(after, "unknown")


def test_latest_model_reference(spark):
    refs = registry.model_ref_row(spark, "rf", "models/1", 0.5, "r1").unionByName(
        registry.model_ref_row(spark, "rf", "models/2", 0.6, "r2")
    )
    assert registry.require_latest_ref(refs, "rf").run_id == "r2"
    with pytest.raises(LookupError):
        registry.require_latest_ref(refs, "other")


def test_key_split_is_repeatable_and_whole(spark):
    df = spark.range(5000)
    train, test = training.split_by_key(df, ["id"])
    again, _ = training.split_by_key(df.repartition(7), ["id"])
    assert train.count() + test.count() == 5000 and 3800 < train.count() < 4200
    assert rows(train) == rows(again)


def test_chart_share_and_histogram(spark):
    df = spark.createDataFrame([("a", 2), ("b", 8)], "label string, value int")
    assert rows(aggregates.chart_scale(df, "value"), "label", "share") == [("a", 0.25), ("b", 1.0)]
    delays = spark.createDataFrame([(-0.5,), (0.0,), (14.9,), (15.0,), (None,)], "ArrDelay double")
    assert rows(aggregates.delay_histogram(delays)) == [(-15.0, 1), (0.0, 2), (15.0, 1)]


def test_scratch_folder_is_the_session_s(spark):
    from flightlake import session

    first, second = (session.scratch_dir(spark, "x") for _ in range(2))
    shared = spark.conf.get("spark.checkpoint.dir", None)
    application = f"/flightlake/{spark.sparkContext.applicationId}/x-"
    assert application in first and first != second
    assert shared is None or first.startswith(shared)
