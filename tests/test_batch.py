"""The batch jobs from files to answers."""

import pytest
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.functions import messages
from flightlake.operators import registry, tables
from flightlake.plans import batch, views
from flightlake.sources import readers, writers
from flightlake.streaming import jobs
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_from_lines_to_answers(spark, tmp_path):
    source, table, root = (str(tmp_path / n) for n in ("lines", "table", "models"))
    flights = views.flights(spark, SF, *schemas.TRAINING.fieldNames())
    flights.write.option("compression", "bzip2").json(source)
    assert batch.load_flights(spark, source, table) == flights.count()

    with pytest.raises(LookupError):
        batch.load_model(spark, root)
    stored = spark.read.schema(schemas.TRAINING).parquet(table)
    for number in (1, 2):
        done = batch.train_and_register(spark, stored, root, trees=3, depth=4)
        assert done["version"] == number and 0 < done["accuracy"] <= 1
    versions = tables.existing(spark, f"{root}/versions")
    assert rows(versions, "version", "stage") == [(1, "Archived"), (2, "Production")]
    assert registry.production_of(versions, batch.REGISTERED_NAME).first().run_id == done["run_id"]
    assert tables.existing(spark, f"{root}/runs").count() == 2

    topic, answers, state = (str(tmp_path / n) for n in ("topic", "answers", "state"))
    lines = views.request_lines(spark, SF)
    writers.write_topic(lines, topic)
    jobs.drain(batch.score_topic(spark, topic, answers, root, state))
    fitted = batch.load_model(spark, root)
    assert rows(readers.text_lines(spark, answers)) == rows(batch.score_batch(lines, fitted))


def test_last_line_of_a_route_counts(spark, tmp_path):
    source, table = tmp_path / "routes.jsonl", str(tmp_path / "table")
    source.write_text(
        '{"Origin":"A","Dest":"B","Distance":1}\n{"Origin":"A","Dest":"C","Distance":2}\n{"Origin":"A","Dest":"B","Distance":3}\n'
        '{"Origin":"A","Dest":"D"}\nnot json\n'
    )
    assert rows(batch.load_distances(spark, str(source), table)) == [("A", "B", 3.0), ("A", "C", 2.0)]


def test_reports_are_written(spark, tmp_path):
    columns = ("Year", "Month", "TailNum", "Carrier", "FlightDate", "FlightNum", "Origin", "Dest")
    flights = views.flights(spark, SF, *columns)
    batch.build_reports(flights, views.airplanes(spark, SF), str(tmp_path))
    lists = spark.read.parquet(f"{tmp_path}/flights_per_airplane")
    assert lists.agg(F.sum(F.size("Flights"))).first()[0] == flights.count()
    months = spark.read.parquet(f"{tmp_path}/flights_by_month")
    assert months.agg(F.sum("total_flights")).first()[0] == flights.count()


def test_dump_and_daily_sinks(spark, tmp_path):
    days = spark.createDataFrame([("2024-01-01 23:00:00",), ("2024-01-02 01:00:00",)], "ts string")
    writers.write_daily(days.withColumn("ts", F.col("ts").cast("timestamp")), "ts", str(tmp_path / "d"))
    assert sorted(p.name for p in (tmp_path / "d").iterdir() if p.name.startswith("event")) == [
        "event_date=2024.01.01", "event_date=2024.01.02",
    ]
    writers.dump_json(spark.range(2), str(tmp_path / "j"))
    assert rows(messages.parse_json(readers.text_lines(spark, str(tmp_path / "j")), spark.range(0).schema).select("d.id")) == [(0,), (1,)]
