"""Legacy ARC archives, and their conversion to WARC.

An ARC file begins with a version block that names the fields of its header
lines: five in version 1, ten in version 2.  A record is a header line and as
many bytes as the line declares.  The converter reads both, and makes for each
record what WARC wants besides: a record id (a name-based UUID of file name and
position, so a repeated task makes the same), an ISO date, a type, block and
payload digests.  Of records with equal payloads of at least ``REVISIT_BYTES``
bytes one is kept as response (largest page id, then latest position); others
become revisits that refer to it.

Archives are written by Spark's text writer (gzip, one file per task, a record
per row; bytes pass through unchanged) and read line by line, so a task holds one
record at a time and any file system that Spark knows will do.

Null html is an empty payload; a null url is written as ``about:blank`` and
blanks in urls are percent-encoded; null page ids stay null and count as the
smallest; repeated rows make one record each.  An empty table gives archives
without page records and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm.arrow import slices
from flightlake.operators.sizing import broadcast_if_small
from flightlake.session import materialize, scratch_dir

REVISIT_BYTES = 1000
BATCH_BYTES = 4 << 20
ARC_DATE = "20240101000000"
PAGE_HEADER = "X-Page-Id"

# Header fields of both ARC versions and names of the WARC format (fixed values).
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SPACE = uuid.UUID("5ad1c7f0-5f0e-4d0b-9a53-6f2f3c1b7e11")


# -- writing archives ---------------------------------------------------------


def _raw_strings(values: list[bytes]) -> pa.Array:
    """Bytes as a string column, unchecked: the text writer passes them on as they are."""
    return pa.array(values, pa.binary()).view(pa.string())


def _write(records: DataFrame, path: str) -> None:
    records.write.option("compression", "gzip").option("lineSep", "\n").option("zlib.compress.level", "BEST_SPEED").text(path)


def _url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else "about:blank"


def _http(page_id: int | None, size: int) -> bytes:
    page = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{page}Content-Length: {size}\r\n\r\n".encode()


def _arc_writer(date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        version = "12"[task % 2]
        name = f"pages-{task:08d}.arc.gz"
        block = f"{version} 0 flightlake\n{ARC_FIELDS[version]}\n".encode()
        extra = "" if version == "1" else f" 200 - - 0 {name}"
        first = f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(block)}\n".encode() + block
        yield pa.RecordBatch.from_arrays([_raw_strings([first])], names=["value"])
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                payload = (html or "").encode()
                content = _http(page_id, len(payload)) + payload
                rows.append(f"{_url(url)} 0.0.0.0 {date} text/html{extra} {len(content)}\n".encode() + content)
            yield pa.RecordBatch.from_arrays([_raw_strings(rows)], names=["value"])

    return write


def write_arc(pages: DataFrame, path: str, date: str = ARC_DATE) -> None:
    """Pages (page_id, url, html) as ARC files; odd tasks write version 2, even ones version 1."""
    _write(pages.select("page_id", "url", "html").mapInArrow(_arc_writer(date), "value string"), path)


# -- reading archives ---------------------------------------------------------


class Lines:
    """Lines of one archive file, read as bytes of any count."""

    def __init__(self, lines: Iterator[bytes]):
        self._lines = lines
        self._rest = b""
        self.position = 0

    def line(self) -> bytes | None:
        """The next line with its break, or None at the end."""
        line = self._rest or next(self._lines, None)
        if line is None:
            return None
        self._rest = b""
        self.position += len(line)
        return line

    def take(self, count: int) -> bytes:
        parts, have = [], 0
        while have < count:
            line = self._rest or next(self._lines, None)
            if line is None:
                raise ValueError(f"archive ends {count - have} bytes early")
            self._rest = line[count - have :]
            parts.append(line[: count - have])
            have += len(parts[-1])
        self.position += have
        return b"".join(parts)


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Lines]]:
    def rows():
        for batch in batches:
            values = batch.column("value").view(pa.binary()).to_pylist()
            for file, value in zip(batch.column("file").to_pylist(), values):
                yield file, value + b"\n"

    for file, lines in groupby(rows(), key=lambda row: row[0]):
        yield file.rpartition("/")[2], Lines(line for _, line in lines)


def _lines_of(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"))


def arc_records(lines: Lines) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, header fields, content) of each record after the version block."""
    names = None
    while (at := lines.position, head := lines.line())[1] is not None:
        text = head.decode("utf-8", "surrogateescape").rstrip("\r\n")
        if not text:
            continue  # the break between records
        if names is None:
            if not text.startswith("filedesc:"):
                raise ValueError("an ARC file must begin with a version block")
            block = lines.take(int(text.rpartition(" ")[2])).decode("utf-8", "replace").split("\n")
            version = block[0].split(" ")[0]
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version!r}")
            # the block names the fields; older writers leave the line out
            names = (block[1].strip() if len(block) > 1 and block[1].strip() else ARC_FIELDS[version]).split(" ")
            continue
        # a legacy url may hold blanks, the fields after it cannot
        values = text.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"no ARC header line at byte {at}: {text[:80]!r}")
        yield at, dict(zip(names, values)), lines.take(int(values[-1]))


def warc_records(lines: Lines) -> Iterator[tuple[dict[str, str], bytes]]:
    while (head := lines.line()) is not None:
        if head.strip() == b"":
            continue
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {head[:80]!r}")
        fields = {}
        while (line := lines.line()) not in (b"\r\n", b"\n", None):
            name, _, value = line.decode("utf-8", "surrogateescape").rstrip("\r\n").partition(":")
            fields[name.lower()] = value.strip()
        yield fields, lines.take(int(fields["content-length"]))


def _batched(rows: Iterator[tuple], schema: pa.Schema, size=lambda row: 0) -> Iterator[pa.RecordBatch]:
    """Rows in batches of up to a thousand and about ``BATCH_BYTES``."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if len(held) == 1000 or total >= BATCH_BYTES:
            yield _batch(held, schema)
            held, total = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(schema, zip(*rows))
    return pa.RecordBatch.from_arrays(
        # bytes for a string column go unchecked
        [_raw_strings(list(v)) if f.type == pa.string() and isinstance(v[0], bytes) else pa.array(v, f.type) for f, v in columns],
        schema=schema,
    )


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header and payload; without a header everything is payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, mark, payload = block.partition(b"\r\n\r\n")
    return head + mark, payload


def _http_number(head: bytes, name: str) -> int | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*(-?\d+)[ \t]*\r?$", head)
    return int(found[1]) if found else None


def _iso(date: str) -> str:
    """A 14-digit (or shorter) ARC date as WARC writes it."""
    digits = (re.sub(r"\D", "", date) + "00000101000000"[len(re.sub(r"\D", "", date)) :])[:14]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def _clean(url: str) -> str:
    """A legacy url with bytes that are not UTF-8 percent-encoded."""
    return re.sub("[\udc80-\udcff]", lambda m: f"%{ord(m.group()) - 0xDC00:02X}", url)


def _record_id(file: str, position: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{file}#{position}')}>"


# -- the converter ------------------------------------------------------------

_DIGESTS = "record_id string, page_id long, size long, digest string, position long, file string, uri string, date string"
_CONTENTS = "record_id string, uri string, date string, ip string, content binary"
_READ = "record_id string, page_id long, uri string, date string, payload_bytes long, payload_digest string, record_type string, original string"


def _schema(text: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in text.split(", "))])


def _digester(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for file, lines in _files(batches):
            for at, fields, content in arc_records(lines):
                head, payload = _split_http(content)
                uri = _clean(fields["URL"])
                digest = hashlib.sha1(payload).hexdigest()
                yield _record_id(file, at), _http_number(head, PAGE_HEADER), len(payload), digest, at, file, uri, _iso(fields["Archive-date"])

    yield from _batched(rows(), _schema(_DIGESTS))


def _warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record; the text writer adds the last line feed."""
    sha = base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines = [WARC_VERSION, *(f"{k}: {v}" for k, v in fields), f"WARC-Block-Digest: sha1:{sha}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block + b"\r\n\r"


def _converter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for file, lines in _files(batches):
            for at, fields, content in arc_records(lines):
                uri = _clean(fields["URL"])
                yield _record_id(file, at), uri, _iso(fields["Archive-date"]), fields["IP-address"], content

    yield from _batched(rows(), _schema(_CONTENTS), lambda row: len(row[-1]))


def _warc_writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    name = f"converted-{task:08d}.warc.gz"

    def rows():
        info = b"software: flightlake\r\nformat: WARC File Format 1.1\r\n"
        yield (_warc_record([
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(name, -1)), ("WARC-Date", _iso(ARC_DATE)),
            ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
        ], info),)
        for batch in batches:
            for part in slices(iter([batch]), "content"):
                for row in part.to_pylist():
                    yield (_page_record(row),)

    yield from _batched(rows(), _schema("value string"), lambda row: len(row[0]))


def _page_record(row: dict) -> bytes:
    head, payload = _split_http(row["content"])
    revisit = row["original"] is not None
    fields = [("WARC-Type", "revisit" if revisit else "response")]
    if revisit:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", row["original"]),
            ("WARC-Refers-To-Target-URI", row["original_uri"]), ("WARC-Refers-To-Date", row["original_date"]),
        ]
    sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields += [
        ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"]), ("WARC-Target-URI", row["uri"]), ("WARC-IP-Address", row["ip"]),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha}"),
    ]
    return _warc_record(fields, head if revisit else row["content"])


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = REVISIT_BYTES) -> None:
    """Read ARC files and write the equivalent WARC files."""
    seen = materialize(_lines_of(spark, arc_path).mapInArrow(_digester, _DIGESTS), "digests")
    order = F.struct(F.coalesce("page_id", F.lit(-(2**63))).alias("p"), "file", "position", "record_id", "uri", "date")
    large = seen.where(F.col("size") >= least)
    kept = large.groupBy("digest", "size").agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    revisits = (
        large.join(kept, ["digest", "size"]).where("record_id <> best.record_id")
        .select("record_id", F.col("best.record_id").alias("original"), F.col("best.uri").alias("original_uri"), F.col("best.date").alias("original_date"))
    )
    records = _lines_of(spark, arc_path).mapInArrow(_converter, "record_id string, uri string, date string, ip string, content binary")
    told = records.join(broadcast_if_small(materialize(revisits, "revisits")), "record_id", "left")
    _write(told.mapInArrow(_warc_writer, "value string"), warc_path)


def _warc_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for _, lines in _files(batches):
            for fields, block in warc_records(lines):
                if fields["warc-type"] not in ("response", "revisit"):
                    continue
                head, payload = _split_http(block)
                digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                size = len(payload)
                if fields["warc-type"] == "revisit":
                    size = _http_number(head, "Content-Length")
                elif hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                yield (
                    fields["warc-record-id"], _http_number(head, PAGE_HEADER), fields["warc-target-uri"], fields["warc-date"],
                    size, digest, fields["warc-type"], fields.get("warc-refers-to"),
                )

    yield from _batched(rows(), _schema(_READ))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record, with what its payload was."""
    return _lines_of(spark, path).mapInArrow(_warc_reader, _READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the WARC records read back."""
    spark = pages.sparkSession
    arc, warc = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc)
    records = materialize(read_warc(spark, warc), "records")
    targets = records.where("record_type = 'response'").select(F.col("record_id").alias("original"), F.col("page_id").alias("refers_to"))
    plain = records.where("original IS NULL").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    told = records.where("original IS NOT NULL").join(targets, "original").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return plain.union(told)
