"""File-listing operators on hand-made listings."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from flightlake.functions import checksums
from flightlake.operators import manifest
from tests.conftest import rows

OBJECTS = [("a/b/c.txt", 10), ("a/c.txt", 5), ("c.txt", 1), ("x/y/z/w.txt", 0)]


@pytest.fixture
def listing(spark):
    return spark.createDataFrame(OBJECTS, "path string, size bigint")


def test_usage_of_every_folder(listing):
    got = dict(rows(manifest.usage(listing, total=True)))
    assert got == {**dict(OBJECTS), "a/": 15, "a/b/": 10, "x/": 0, "x/y/": 0, "x/y/z/": 0, "total": 16}
    assert dict(rows(manifest.usage(listing, summary_only=True))) == {"a": 15, "x": 0}


def test_excluded_folder_hides_its_objects(listing):
    assert rows(manifest.exclude(listing, ["a/b/"]), "path") == [("a/c.txt",), ("c.txt",), ("x/y/z/w.txt",)]
    assert rows(manifest.exclude(listing, ["*.txt"]), "path") == []
    assert dict(rows(manifest.usage(listing, ["x/*"], total=True)))["total"] == 16
    assert manifest.exclude(listing, []).count() == 4


def test_listing_total(spark, listing):
    total = manifest.listing(listing).filter("path = 'TOTAL'").first()
    assert (total.size, total.objects, total.shown) == (16, 4, "16 B")
    empty = manifest.listing(listing.limit(0)).first()
    assert (empty.size, empty.objects) == (0, 0)


def test_files_and_hashes(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "f.bin").write_bytes(b"hello")
    got = manifest.list_files(spark, str(tmp_path), hashes=True).first()
    assert (got.path, got.size) == ("d/f.bin", 5)
    assert got.md5 == hashlib.md5(b"hello").hexdigest() and got.crc == zlib.crc32(b"hello")


# Published check values of the Castagnoli sum.
KNOWN = [
    (b"123456789", 0xE3069283), (bytes(32), 0x8A9136AA), (b"\xff" * 32, 0x62A8AB43),
    (bytes(range(32)), 0x46DD794E), (bytes(range(31, -1, -1)), 0x113FDB5C), (b"", 0),
]


def test_crc32c_known_values(spark):
    objects = spark.createDataFrame([(content, want) for content, want in KNOWN], "content binary, want bigint")
    got = manifest.hashes(objects, encoding="hex", crc=checksums.crc32c)
    assert all(r.crc == r.want for r in got.collect())
    shown = {r.want: (r.a, r.b) for r in objects.select(
        "want", checksums.crc_text("want").alias("a"), checksums.crc_text("want", "hex").alias("b")
    ).collect()}
    assert shown[0xE3069283] == ("4waSgw==", "E3069283") and shown[0] == ("AAAAAA==", "00000000")
    assert spark.createDataFrame([(None,)], "content binary").select(checksums.crc32c("content")).first()[0] is None


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_crc32c_of_pieces_in_any_order(spark, size):
    texts = [*(k for k, _ in KNOWN), bytes(i * i % 251 for i in range(1000))]
    objects = spark.createDataFrame(list(enumerate(texts)), "id int, content binary")
    whole = rows(objects.select("id", F.octet_length("content").cast("bigint"), checksums.crc32c("content")))
    pieces = manifest.in_pieces(objects, size=size)
    assert pieces.agg(F.max(F.octet_length("content"))).first()[0] <= size
    assert rows(checksums.crc32c_of_pieces(pieces.orderBy(F.desc("start")), "id")) == whole


def test_crc32c_of_pieces_with_one_missing(spark):
    schema = "id int, start bigint, content binary"
    pieces = [(1, 0, b"1234"), (1, 8, b"9"), (2, 0, None), (3, 4, b"56789"), (3, 0, b"1234")]
    got = {r.id: r.crc32c for r in checksums.crc32c_of_pieces(spark.createDataFrame(pieces, schema), "id").collect()}
    assert got == {1: None, 2: None, 3: 0xE3069283}
    # far beyond what one value can hold: only places count, not bytes between them
    far = spark.createDataFrame([(1, 0, b"\x01"), (1, 1 << 40, b"\x01")], schema)
    row = checksums.crc32c_of_pieces(far, "id").first()
    assert row["size"] == (1 << 40) + 1 and row.crc32c is None
    assert checksums.crc32c_of_pieces(far.limit(0), "id").count() == 0


SCHEMA = "path string, size bigint, mtime bigint, md5 string, crc bigint"
SOURCE = [
    ("new", 1, 1, "a", None), ("same", 1, 1, "a", None), ("older", 1, 1, "a", None), ("resized", 2, None, "a", None),
    ("rewritten", 1, None, "b", None), ("untimed", 1, 5, "a", None), ("crc", 1, None, None, 1), ("unknown", 1, None, None, None),
]
TARGET = [
    ("same", 1, 1, "z", None), ("older", 1, 9, "b", None), ("resized", 1, None, "a", None), ("rewritten", 1, None, "a", None),
    ("untimed", 1, None, "a", None), ("crc", 1, None, None, 2), ("unknown", 1, None, None, None), ("extra", 1, 1, "a", None),
]


def _plan(spark, **options):
    source, target = spark.createDataFrame(SOURCE, SCHEMA), spark.createDataFrame(TARGET, SCHEMA)
    return {r.path: r.action for r in manifest.sync_plan(source, target, **options).collect()}


def test_sync_by_time_size_and_hash(spark):
    want = {"new": "copy", "older": "copy", "resized": "copy", "rewritten": "copy", "untimed": "mtime", "crc": "copy"}
    assert _plan(spark) == want
    assert _plan(spark, delete_extras=True) == {**want, "extra": "remove"}
    without_older = {k: v for k, v in want.items() if k != "older"}
    assert _plan(spark, skip_older=True) == without_older
    assert _plan(spark, use_hashes=True) == {**want, "same": "copy"}
    assert _plan(spark, ignore_existing=True) == {"new": "copy", "untimed": "mtime"}
    assert "crc" not in _plan(spark, exclude_patterns=["c*"])


def test_lifecycle_is_strictly_older(spark):
    day = 86400
    df = spark.createDataFrame([("old", 0), ("edge", day), ("untimed", None)], "path string, mtime bigint")
    now = F.timestamp_seconds(F.lit(11 * day))
    got = rows(manifest.lifecycle(df, [("Delete", 10)], now), "path", "action")
    assert got == [("old", "Delete")]
    assert manifest.lifecycle(df, [], now).count() == 0


def test_compose_order_and_limit(spark):
    parts = spark.createDataFrame([("t", i, f"{i:02d}") for i in range(32)][::-1], "target string, pos int, text string")
    assert manifest.compose(parts, "target", "pos", "text").first().text == "".join(f"{i:02d}" for i in range(32))
    with pytest.raises(ValueError, match="more than 32"):
        manifest.compose(parts.union(parts.limit(1)), "target", "pos", "text")
