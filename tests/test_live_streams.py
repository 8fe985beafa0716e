"""Streams with state: matched answers, batches with an age, running totals."""

from pyspark.sql import functions as F

from flightlake.operators.tables import existing
from flightlake.session import folders
from flightlake.sources import readers, writers
from flightlake.streaming import batching, daily, jobs, matching, totals
from tests.conftest import rows


def _say(spark, topic, *texts):
    writers.write_topic(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1), topic)


def _answer(uuid, time, prediction):
    return f'{{"UUID":"{uuid}","Timestamp":"2024-01-01T{time}","Prediction":{prediction}}}'


def test_matches_come_out_as_answers_arrive(spark, tmp_path):
    first, second, table, state = (str(tmp_path / n) for n in ("first", "second", "table", "state"))

    def go(ones, others):
        _say(spark, first, *ones)
        _say(spark, second, *others)
        # a restart each time: the state comes from the checkpoint
        for query in matching.start_matching(readers.read_topic(spark, first), readers.read_topic(spark, second), table, state, "10 minutes"):
            jobs.drain(query)

    def joined():
        out = spark.read.parquet(f"{table}/matched")
        return rows(out.select("UUID", "first.Prediction", F.col("second.Prediction").alias("p")).where("UUID not like 'clock%'"))

    go([_answer("both", "10:00:00", 1.0), _answer("alone", "10:01:00", 2.0), "not json"], [_answer("both", "10:02:00", 3.0), _answer("other", "10:01:00", 0.0)])
    assert joined() == [("both", 1.0, 3.0)]
    # not yet: the watermark is 10:20 minus ten minutes, and the join waits ten minutes more for a partner
    go([_answer("clock-a", "10:20:00", 0.0)], [_answer("clock-b", "10:20:00", 0.0)])
    assert joined() == [("both", 1.0, 3.0)]
    # the partner of "alone" comes before the watermark has passed
    go([_answer("clock-c", "11:00:00", 0.0)], [_answer("alone", "10:11:00", 3.0), _answer("clock-d", "11:00:00", 0.0)])
    assert joined() == [("alone", 2.0, 3.0), ("both", 1.0, 3.0), ("other", None, 0.0)]
    # too late for the join: kept beside it
    go([_answer("other", "10:01:30", 1.0), _answer("both", "10:00:00", 9.0)], [_answer("late", "09:00:00", 2.0)])
    assert [r for r in joined() if r[0] == "late"] == []
    got = rows(matching.read_matches(spark, table).where("UUID not like 'clock%'"))
    assert got == [("alone", 2.0, 3.0), ("both", 9.0, 3.0), ("late", None, 2.0), ("other", 1.0, 0.0)]


def test_late_answers_are_kept_whatever_the_micro_batches(spark, tmp_path):
    """Read file by file or at once, times rising and falling: no answer is lost."""
    for files in (1, None):
        first, second, table, state = (str(tmp_path / f"{n}-{files}") for n in ("first", "second", "table", "state"))
        want = []
        for i, hour in enumerate((12, 9, 15, 8, 14, 20)):
            _say(spark, first, *[_answer(f"u{i}-{j}", f"{hour:02d}:0{j}:00", 1.0) for j in range(3)])
            _say(spark, second, *[_answer(f"u{i}-{j}", f"{hour:02d}:0{j}:00", 2.0) for j in range(1, 4)])
            want += [(f"u{i}-{j}", 1.0 if j < 3 else None, 2.0 if j else None) for j in range(4)]
        for _ in range(2):
            topics = [readers.read_topic(spark, t, files_per_batch=files) for t in (first, second)]
            for query in matching.start_matching(*topics, table, state, "10 minutes"):
                jobs.drain(query)
            for topic in (first, second):
                _say(spark, topic, _answer(f"clock-{topic[-6:]}", "23:59:00", 0.0))
        assert rows(matching.read_matches(spark, table).where("UUID not like 'clock%'")) == sorted(want, key=str)


def _bins(spark, topic, table, state, size, age):
    parts = F.split("value", ":")
    return batching.start_binning(readers.read_topic(spark, topic), parts[0], F.get(parts, F.lit(1)), table, state, size, age, {"processingTime": "200 milliseconds"})


def _stored(spark, table):
    return rows(batching.insert_texts(spark, table)) if existing(spark, table) is not None else []


def _text(*parts):
    return writers.BATCH_OPEN + "".join(parts) + writers.BATCH_CLOSE


def test_short_batches_are_released_by_their_age(spark, tmp_path):
    topic, table, state = (str(tmp_path / n) for n in ("topic", "table", "state"))
    _say(spark, topic, "x:1", "x:2", "x:3", "x:4", "x:5", "y:1", "no statement")
    # full batches at once; the rest waits
    query = _bins(spark, topic, table, state, 2, 3_600_000)
    jobs.run_until(query, lambda: len(_stored(spark, table)) >= 2)
    assert _stored(spark, table) == [("x", 0, False, 2, _text("1", "2")), ("x", 1, False, 2, _text("3", "4"))]
    # after a restart the waiting rows are still there, and fill up first
    _say(spark, topic, "x:6", "x:7")
    jobs.run_until(_bins(spark, topic, table, state, 2, 500), lambda: len(_stored(spark, table)) >= 4)
    got = _stored(spark, table)
    assert ("x", 2, False, 2, _text("5", "6")) in got and ("x", 3, True, 1, _text("7")) in got


def test_a_lone_row_leaves_after_the_wait(spark, tmp_path):
    topic, table, state = (str(tmp_path / n) for n in ("topic", "table", "state"))
    _say(spark, topic, "a:1")
    jobs.run_until(_bins(spark, topic, table, state, 100, 500), lambda: len(_stored(spark, table)) == 1)
    assert _stored(spark, table) == [("a", 0, True, 1, _text("1"))]


def test_totals_follow_the_rows(spark, tmp_path):
    topic, table, state = (str(tmp_path / n) for n in ("topic", "table", "state"))
    text = "SELECT k, count(*) AS n, max(v) AS top FROM running GROUP BY k"
    schema = spark.createDataFrame([], "k string, n bigint, top int").schema
    seen = []
    for part in ([("a", 1), ("b", 5)], [("a", 7), (None, 2)], [("a", 3)]):
        seen += part
        spark.createDataFrame(part, "k string, v int").write.mode("append").parquet(topic)
        stream = spark.readStream.schema("k string, v int").parquet(topic)
        jobs.drain(totals.start_totals(spark, text, "running", stream, table, state))
        batch = spark.createDataFrame(seen, "k string, v int").groupBy("k").agg(F.count("v"), F.max("v"))
        assert rows(totals.read_totals(spark, table, schema, ["k"])) == rows(batch)
        totals.compact_totals(spark, table, schema, ["k"])
        assert rows(totals.read_totals(spark, table, schema, ["k"])) == rows(batch)


def test_windows_leave_the_state(spark, tmp_path):
    topic, table, state = (str(tmp_path / n) for n in ("topic", "table", "state"))
    text = "SELECT window(at, '1 hour').start AS hour, count(*) AS n FROM timed GROUP BY window(at, '1 hour')"
    schema = spark.createDataFrame([], "hour timestamp, n bigint").schema
    for times in (["10:05", "10:50", "11:10"], ["15:00"], ["10:59", "15:30"]):
        rows_in = spark.createDataFrame([(f"2024-01-01 {t}:00",) for t in times], "at string").select(F.col("at").cast("timestamp"))
        rows_in.coalesce(1).write.mode("append").parquet(topic)
        stream = spark.readStream.schema("at timestamp").parquet(topic)
        jobs.drain(totals.start_totals(spark, text, "timed", stream, table, state, event_time="at", lateness="30 minutes"))
    got = {r["hour"].hour: r["n"] for r in totals.read_totals(spark, table, schema, ["hour"]).collect()}
    assert got == {10: 2, 11: 1, 15: 2}


def test_days_are_put_together_while_they_are_read(spark, tmp_path):
    topic, path, state = (str(tmp_path / n) for n in ("topic", "log", "state"))
    schema = spark.createDataFrame([], "k int, event_date string").schema

    def add(*dated):
        spark.createDataFrame(dated, schema).repartition(3).write.mode("append").parquet(topic)
        jobs.drain(daily.start_days(spark.readStream.schema(schema).parquet(topic), path, state))

    def day(name):
        return rows(daily.read_day(spark, path, name, schema), "k")

    add(*[(i, "2024.01.01") for i in range(20)], (100, "2024.01.02"))
    add((20, "2024.01.01"))
    assert daily.stored_days(spark, path) == ["2024.01.01", "2024.01.02"] and len(day("2024.01.01")) == 21
    before = day("2024.01.01")
    assert daily.compact_day(spark, path, "2024.01.01", schema) == 1 and day("2024.01.01") == before
    files = daily.read_day(spark, path, "2024.01.01", schema).inputFiles()
    assert len(files) == 1 and "upto=1" in files[0]
    assert daily.compact_day(spark, path, "2024.01.01", schema) == 1  # nothing new
    add((21, "2024.01.01"), (101, "2024.01.02"))
    assert len(day("2024.01.01")) == 22 and day("2024.01.02") == [(100,), (101,)]
    # a compaction that was cut short does not count
    (tmp_path / "log-days" / "event_date=2024.01.01" / "upto=2").mkdir()
    assert len(day("2024.01.01")) == 22
    assert daily.compact_day(spark, path, "2024.01.01", schema) == 2 and len(day("2024.01.01")) == 22
    assert sorted(folders(spark, f"{path}/event_date=2024.01.01")) == ["batch_id=2"]
    assert daily.compact_day(spark, path, "2030.01.01", schema) == -1 and day("2030.01.01") == []


def test_compacted_micro_batches_are_removed(spark, tmp_path):
    table = str(tmp_path / "table")
    schema = spark.createDataFrame([], "k string, v int").schema

    def newest():
        return rows(jobs.newest(spark, table, schema, ["k"], []))

    for n in range(6):
        jobs.write_batch(spark.createDataFrame([("a", n), (f"b{n}", n)], schema), table, n)
        if n in (1, 3, 4):
            jobs.compact(spark, table, schema, ["k"], [])
    want = newest()
    assert jobs.tidy(spark, table) == 1 + 4 and newest() == want and len(want) == 7
    assert sorted(folders(spark, table)) == ["batch_id=4", "batch_id=5"] and jobs.tidy(spark, table) == 0


def test_answers_wait_outside_the_heap(spark, tmp_path):
    """The match keeps its state on disk, and the session's own settings are as before."""
    before = {key: spark.conf.get(key, None) for key in matching.STATE}
    first, second, table, state = (str(tmp_path / n) for n in ("first", "second", "table", "state"))
    _say(spark, first, _answer("both", "10:00:00", 1.0), _answer("alone", "10:00:00", 2.0))
    _say(spark, second, _answer("both", "10:01:00", 3.0))
    for query in matching.start_matching(readers.read_topic(spark, first), readers.read_topic(spark, second), table, state, "10 minutes"):
        jobs.drain(query)
    assert {key: spark.conf.get(key, None) for key in matching.STATE} == before
    began = "".join(r["value"] for r in spark.read.text(f"{state}/matched/offsets/0").collect())
    assert "RocksDBStateStoreProvider" in began
    assert rows(matching.read_matches(spark, table)) == [("both", 1.0, 3.0)]
