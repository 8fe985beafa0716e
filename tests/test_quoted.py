"""Delimited files with line breaks inside quotes, read in many pieces."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from flightlake.plans import queries_tables
from flightlake.plans.catalog import QUERIES
from flightlake.sources import loads, quoted
from tests.conftest import rows


@pytest.fixture
def small_pieces(spark):
    """Blocks of 128 bytes, so that records, values and quote pairs cross their borders."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "128")
    spark.conf.set(names[1], "0")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _write(folder, name, records, end="\n", lead=""):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(records)
    (folder / name).write_bytes((lead + out.getvalue()).encode())


def test_any_values_in_any_pieces(spark, tmp_path, small_pieces):
    random.seed(5)
    bits = ['"', '""', "\n", "\r\n", ",", "a", "é日", "x" * 200, "\n\n", ' "', "5\" disk", "'"]

    def value():
        return "v" + "".join(random.choice(bits) for _ in range(random.randint(0, 6)))

    files = {f"{n}.csv": [(str(i), value(), value()) for i in range(60)] for n in "abc"}
    for name, records in files.items():
        _write(tmp_path, name, records, random.choice(["\n", "\r\n"]))
    loaded = loads.load_csv(spark, str(tmp_path), loads.schema_from_text("k,a,b"), quoted_newlines=True)
    assert rows(loads.accept(loaded)) == sorted((r for records in files.values() for r in records), key=str)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20


def test_one_value_over_many_pieces(spark, tmp_path, small_pieces):
    text = "\n".join(f'line {i}, with "quotes"' for i in range(300))
    _write(tmp_path, "a.csv", [("1", text), ("2", "b"), ("3", "")], lead='title\n"lead\n""er"""\n')
    loaded = loads.load_csv(spark, str(tmp_path), loads.schema_from_text("k:INTEGER,v"), skip_rows=2, quoted_newlines=True)
    assert rows(loads.accept(loaded)) == [(1, text), (2, "b"), (3, None)]


def test_stray_quotes_do_not_open_values(spark, tmp_path, small_pieces):
    (tmp_path / "a.csv").write_text('1,5" disk\n2,"a ""b""\nc"\n3,12" and 7"\n' + '4,plain\n' * 30)
    loaded = loads.load_csv(spark, str(tmp_path), loads.schema_from_text("k:INTEGER,v"), quoted_newlines=True)
    got = rows(loaded.where("k < 4"), "k", "v")
    assert got == [(1, '5" disk'), (2, 'a "b"\nc'), (3, '12" and 7"')] and loaded.count() == 33


def test_other_signs_and_bad_records(spark, tmp_path, small_pieces):
    (tmp_path / "a.csv").write_text("1|'a|\nb'|x\nbad|'c\n\nd'|y\n\n2|e\n3|'it''s'|z\n")
    loaded = loads.load_csv(spark, str(tmp_path), loads.schema_from_text("k:INTEGER,v,w"), "|", quote="'", quoted_newlines=True)
    good = loaded.where(f"{loads.CORRUPT} is null")
    assert rows(good, "k", "v", "w") == [(1, "a|\nb", "x"), (3, "it's", "z")]
    assert set(rows(loaded.where(f"{loads.CORRUPT} is not null"), loads.CORRUPT)) == {("2|e",), ("bad|'c\n\nd'|y",)}


def test_a_quote_that_is_never_closed_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted, "MOST_RECORD_BYTES", 100)
    (tmp_path / "a.csv").write_text('1,"open\n' + "2,b\n" * 100)
    with pytest.raises(ValueError, match="quote not closed"):
        loads.load_csv(spark, str(tmp_path), loads.schema_from_text("k:INTEGER,v"), quoted_newlines=True)


def test_empty_files_and_other_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("1,a")
    schema = loads.schema_from_text("k:INTEGER,v")
    assert rows(loads.accept(loads.load_csv(spark, str(tmp_path), schema, quoted_newlines=True))) == [(1, "a")]
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "c.csv").write_bytes('h,h\n1,"é\nb"\n'.encode("latin-1"))
    loaded = loads.load_csv(spark, str(tmp_path / "l"), schema, encoding="ISO-8859-1", skip_rows=1, quoted_newlines=True)
    assert rows(loads.accept(loaded)) == [(1, "é\nb")]


def test_a_language_is_written_to_files_of_bounded_size(spark, tmp_path, monkeypatch):
    texts = [(i, f'{i} says "{"abc " * 40}"\nand\r\ngoes, on', "en" if i % 10 else "de") for i in range(400)]
    made = spark.createDataFrame(texts, "doc_id bigint, text string, lang string").withColumn("source", F.lit("src1"))
    made.write.parquet(str(tmp_path / "in/documents.parquet"))
    monkeypatch.setattr(queries_tables, "_FILE_BYTES", 16 * 1024)
    monkeypatch.setattr(queries_tables, "scratch_dir", lambda spark, label: str(tmp_path / label))
    loaded = QUERIES["w_load_csv_quoted_blocks"](spark, str(tmp_path / "in"))
    assert rows(loaded, "doc_id", "lang", "source", "text") == rows(made, "doc_id", "lang", "source", "text")
    sizes = [f.stat().st_size for f in (tmp_path / "csv").rglob("part-*")]
    assert max(sizes) < 2 * 16 * 1024 < sum(sizes) / 2
