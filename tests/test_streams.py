"""Streaming jobs: equal to batch, restartable, replayable."""

import pytest
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.functions import messages
from flightlake.operators import latest
from flightlake.plans import views
from flightlake.plans.queries_model import fitted
from flightlake.sources import readers, writers
from flightlake.streaming import jobs
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return fitted(spark, SF)[0]


def _topic(spark, path, *texts):
    writers.write_topic(spark.createDataFrame([(t,) for t in texts], "value string"), path)


def test_scoring_stream_equals_batch(spark, model, tmp_path):
    topic, out, state = (str(tmp_path / n) for n in ("topic", "out", "state"))
    lines = views.request_lines(spark, SF)
    writers.write_topic(lines.repartition(5), topic)
    stream = readers.read_topic(spark, topic, files_per_batch=2)
    jobs.drain(jobs.start_files(jobs.score_lines(stream, model), out, state))
    assert rows(readers.text_lines(spark, out)) == rows(jobs.score_lines(lines, model))


def test_a_broken_line_is_answered_without_id(spark, model):
    lines = spark.createDataFrame([("not json",)], "value string")
    answer = jobs.score_lines(lines, model).first().value
    assert answer.startswith('{"Prediction":') and "UUID" not in answer and "Origin" not in answer


def test_rejecting_batch_answers_and_rejects(spark, model):
    lines = spark.createDataFrame(
        [("not json",), ('{"UUID":"u","Carrier":null,"DepDelay":3}',), ('{"UUID":"v","DepDelay":"x"}',)], "value string"
    )
    good, bad = jobs.score_or_reject(lines, model)
    assert rows(bad) == [("not json", "no JSON object"), ('{"UUID":"v","DepDelay":"x"}', "DepDelay is no number")]
    answer = good.first().value
    assert '"UUID":"u"' in answer and '"Carrier":null' in answer and '"DepDelay":3.0' in answer


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    topic, out, state = (str(tmp_path / n) for n in ("topic", "out", "state"))
    for text in ("a", "b"):
        _topic(spark, topic, text)
        jobs.drain(jobs.start_files(readers.read_topic(spark, topic), out, state))
    assert rows(readers.text_lines(spark, out)) == [("a",), ("b",)]


def test_replayed_batch_is_not_stored_twice(spark, tmp_path):
    table = str(tmp_path / "table")
    batch = spark.createDataFrame([("u", 1.0, "o", "d", "c", 0.0, "2024-01-01T00:00:00")], schemas.PREDICTION)
    jobs.write_batch(batch, table, 0)
    jobs.write_batch(batch, table, 0)
    later = batch.withColumn("Prediction", F.lit(2.0))
    jobs.write_batch(later, table, 1)
    assert jobs.read_batches(spark, table, schemas.PREDICTION).count() == 2
    # same time stamp: the later micro-batch counts
    def newest():
        return rows(jobs.newest(spark, table, schemas.PREDICTION, ["UUID"], ["Timestamp"]), "UUID", "Prediction")

    assert newest() == [("u", 2.0)]
    for _ in range(2):
        assert jobs.compact(spark, table, schemas.PREDICTION, ["UUID"], ["Timestamp"]) == 1
    assert newest() == [("u", 2.0)]
    # an older time in a later micro-batch still counts, before and after compaction
    jobs.write_batch(batch.withColumn("Timestamp", F.lit("2023-01-01T00:00:00")).withColumn("Prediction", F.lit(3.0)), table, 2)
    assert newest() == [("u", 3.0)]
    assert jobs.compact(spark, table, schemas.PREDICTION, ["UUID"], ["Timestamp"]) == 2 and newest() == [("u", 3.0)]


def test_upsert_stream_equals_batch(spark, tmp_path):
    topic, table, state = (str(tmp_path / n) for n in ("topic", "table", "state"))
    answers = views.predictions_a(spark, SF)
    for part in (0, 1):
        own = answers.filter(F.col("Offset") % 2 == part)
        writers.write_topic(messages.emit_json(own, jobs.MESSAGE_COLUMNS).repartition(3), topic)
        jobs.drain(jobs.start_storing(readers.read_topic(spark, topic, files_per_batch=1), table, state))
    batch = latest.store_predictions(messages.emit_json(answers, jobs.MESSAGE_COLUMNS, "Offset"), ["Offset"])
    assert rows(jobs.stored_predictions(spark, table)) == rows(batch)


def test_last_line_of_a_file_counts(spark, tmp_path):
    topic, table, state = (str(tmp_path / n) for n in ("topic", "table", "state"))
    lines = [f'{{"UUID":"u","Prediction":{n},"Timestamp":"2024-01-0{t}T00:00:00"}}' for n, t in ((1, 2), (2, 1), (3, 1))]
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.text(topic)
    jobs.drain(jobs.start_storing(readers.read_topic(spark, topic), table, state))
    assert rows(jobs.stored_predictions(spark, table), "uuid", "prediction") == [("u", "3.0")]


def test_late_and_repeated_answers_are_matched(spark, tmp_path):
    def store(name, *parts):
        topic, table, state = (str(tmp_path / f"{name}-{n}") for n in ("topic", "table", "state"))
        for part in parts:
            _topic(spark, topic, *[f'{{"UUID":"{u}","Prediction":{p}}}' for u, p in part], "not json")
            jobs.drain(jobs.start_answers(readers.read_topic(spark, topic), table, state))
        return table

    first = store("a", [("both", 1.0), ("alone", 2.0)], [("both", 4.0)])
    second = store("b", [("both", 3.0)], [("late", 0.0)])
    got = rows(jobs.matched_answers(spark, first, second))
    assert got == [("alone", 2.0, None), ("both", 4.0, 3.0), ("late", None, 0.0)]


def test_routes_are_reloaded_at_every_trigger(spark, tmp_path):
    feed, table, state = (str(tmp_path / n) for n in ("feed", "table", "state"))
    _topic(spark, feed, '{"Origin":"A","Dest":"B","Distance":5}', '{"Origin":"A"}')
    query = jobs.start_refresh(spark, feed, table, state, {"once": True})
    jobs.drain(query)
    assert rows(spark.read.parquet(table)) == [("A", "B", 5.0)]


def test_console_counts_its_messages(spark, tmp_path, capsys):
    topic, counts = str(tmp_path / "topic"), str(tmp_path / "counts")
    _topic(spark, topic, *[f"message {i}" for i in range(50)])
    jobs.drain(jobs.start_console(readers.read_topic(spark, topic), jobs.DRAIN, rows=2, counts=counts))
    assert capsys.readouterr().out.count("message") == 2
    assert spark.read.parquet(counts).agg(F.sum("messages")).first()[0] == 50


def test_fanout_and_debug_sinks(spark, tmp_path):
    topic = str(tmp_path / "topic")
    _topic(spark, topic, "a", "b")
    seen = []
    sinks = [lambda df, n: seen.append(("x", n, df.count())), lambda df, n: seen.append(("y", n, df.count()))]
    jobs.drain(jobs.start_fanout(readers.read_topic(spark, topic), sinks, str(tmp_path / "state")))
    assert seen == [("x", 0, 2), ("y", 0, 2)]
    jobs.drain(jobs.start_memory(readers.read_topic(spark, topic), "debug_rows"))
    assert rows(spark.table("debug_rows")) == [("a",), ("b",)]


def test_log_rows_of_two_topics(spark, tmp_path):
    asked, answered = str(tmp_path / "asked"), str(tmp_path / "answered")
    _topic(spark, asked, '{"UUID":"u","Distance":5,"Timestamp":"2024-01-01T23:59:59.999999"}')
    _topic(spark, answered, '{"UUID":"u","Prediction":1,"Timestamp":"1704153600000"}')
    got = jobs.index_rows(readers.text_lines(spark, asked), readers.text_lines(spark, answered))
    assert rows(got, "UUID", "Distance", "Prediction", "log_type", "event_date") == [
        ("u", 5.0, None, "flight_prediction", "2024.01.01"), ("u", None, 1.0, "flight_prediction", "2024.01.02"),
    ]


def test_compressed_topic_and_answers_read_back_whole(spark, model, tmp_path):
    topic, out, state = (tmp_path / n for n in ("topic", "out", "state"))
    lines = views.request_lines(spark, SF)
    writers.write_topic(lines, str(topic), compression="gzip")
    jobs.drain(jobs.start_files(jobs.score_lines(readers.read_topic(spark, str(topic)), model), str(out), str(state), compression="gzip"))
    assert rows(readers.text_lines(spark, str(out))) == rows(jobs.score_lines(lines, model))
    for folder in (topic, out):
        names = [f.name for f in folder.glob("part-*")]
        assert names and all(n.endswith(".gz") for n in names)
