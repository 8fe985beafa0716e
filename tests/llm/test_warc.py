import gzip
import hashlib
import random

import pytest

from flightlake.llm import warc
from flightlake.session import scratch_dir


def want(rows):
    out = []
    payloads = [(p, (h or "").encode()) for p, _, h in rows]
    for p, body in payloads:
        best = max(q for q, other in payloads if other == body)
        again = len(body) >= 1000 and best != p
        out.append((p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", best if again else None))
    return sorted(out)


def test_round_trip(spark):
    random.seed(2)
    bodies = ["x" * 999, "y" * 1000, "é" * 500, "é" * 499 + "a", "line\r\nWARC/1.1\r\n\r\n http://a 1 2 3 4\n" * 40, "\n\n\r\n" * 300, "", None, "tail\n" * 250]
    rows = [(i, random.choice([f"http://h/{i}", None, "", "http://a b/\n c"]), random.choice(bodies)) for i in range(150)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = sorted(tuple(r) for r in warc.round_trip(pages).collect())
    assert got == want(rows)


def test_legacy_files_of_both_versions(spark, tmp_path):
    body = b"HTTP/1.0 200 OK\r\nX-Page-Id: 7\r\n\r\n\xff\x00raw\n\nbytes"
    one = b"1 0 Crawler\nURL IP-address Archive-date Content-type Archive-length\n\n"
    two = b"2 0 Crawler\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    for name, block, extra in (("a.arc.gz", one, b""), ("b.arc.gz", two, b" 200 - - 0 b.arc.gz")):
        head = b"filedesc://%s 0.0.0.0 19990101 text/plain%s %d\n" % (name.encode(), extra, len(block)) + block
        record = b"http://old site/x 1.2.3.4 19990102030405 text/html%s %d\n" % (extra, len(body)) + body + b"\n"
        no_http = b"dns:x 1.2.3.4 19990102030405 text/dns%s 3\nabc\n" % extra
        (tmp_path / name).write_bytes(gzip.compress(head + record + no_http))
    out = scratch_dir(spark, "converted")
    warc.convert(spark, str(tmp_path), out)
    rows = warc.read_warc(spark, out).collect()
    assert len(rows) == 4 and len({r["record_id"] for r in rows}) == 4
    pages = [r for r in rows if r["page_id"] == 7]
    assert {r["payload_digest"] for r in pages} == {hashlib.sha1(b"\xff\x00raw\n\nbytes").hexdigest()}
    assert {(r["uri"], r["date"]) for r in pages} == {("http://old site/x", "1999-01-02T03:04:05Z")}
    assert {r["payload_bytes"] for r in rows if r["page_id"] is None} == {3}


def test_broken_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.arc_records(warc.Lines(iter([b"http://a 1 2 3 4\n"]))))
    start = [b"filedesc://a 0.0.0.0 2000 text/plain 4\n", b"1 0\n"]
    with pytest.raises(ValueError):
        list(warc.arc_records(warc.Lines(iter([*start, b"not a header\n"]))))
    with pytest.raises(ValueError):
        list(warc.arc_records(warc.Lines(iter([*start, b"http://a 1.1.1.1 2000 text/html 99\n", b"short\n"]))))


def test_null_ids_repeats_and_empty_tables(spark):
    rows = [(None, "u", "z" * 2000), (1, "u", "z" * 2000), (1, "u", "z" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS record_type")
    got = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()), key=str)
    assert got == [(0, "revisit", 1), (1, "response", None), (1, "revisit", 1)]
    assert warc.round_trip(pages.limit(0)).count() == 0
