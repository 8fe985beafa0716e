"""Rows in compressed blocks, and an exchange of packed keys between them.

Looking for what documents share takes three steps here:

* ``to_blocks`` packs rows (all columns) into blocks of about a megabyte of
  text, compressed, written once;
* every block sends the sorted distinct keys of what it holds, split into
  buckets by key range, as one binary value per (block, bucket);
* a bucket sees a key at most once per block, finds out which keys several
  blocks hold, and answers each block with one bit per key that it had sent.

So a key that a third of all rows hold costs one entry per block, not one per
row, no group of rows ever meets in one task, and what is shuffled is eight to
sixteen bytes per distinct key of a block.  The number of buckets grows with the
text, which bounds the memory of a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.arrow import slices, text_lengths
from flightlake.session import materialize

BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20

BLOCKS = "block bigint, raw bigint, data binary"


# What a block holds of the rows that were cut for it.
Turn = Callable[[pa.RecordBatch], pa.RecordBatch]


def _pack(text: str, size: int, turn: Turn | None):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        task = TaskContext.get().partitionId()
        number = 0
        for batch in slices(batches, text, size):
            data = squeeze.compress(stream_bytes(turn(batch) if turn else batch))
            raw = int(text_lengths(batch.column(text)).sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + number], pa.int64()), pa.array([raw], pa.int64()), pa.array([data], pa.binary())],
                names=["block", "raw", "data"],
            )
            number += 1

    return pack


def stream_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def as_blocks(df: DataFrame, text: str, size: int | None = None, turn: Turn | None = None) -> DataFrame:
    """The rows of ``df`` (or what ``turn`` makes of them) as compressed blocks, made anew whenever they are read."""
    return df.mapInArrow(_pack(text, size or BLOCK_BYTES, turn), BLOCKS)


def to_blocks(df: DataFrame, text: str, turn: Turn | None = None) -> DataFrame:
    """The rows of ``df`` (or what ``turn`` makes of them) as a written table of compressed blocks."""
    return materialize(as_blocks(df, text, turn=turn), "blocks")


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one; blocks are large, so a batch of them is not copied whole."""
    for i in range(batch.num_rows):
        yield {c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}
        pa.default_memory_pool().release_unused()


def open_block(data: bytes) -> pa.RecordBatch:
    stream = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data))
    table = stream.read_all().combine_chunks()
    batches = table.to_batches()
    return batches[0] if batches else pa.RecordBatch.from_pylist([], schema=table.schema)


def bucket_count(blocks: DataFrame) -> int:
    total = blocks.agg(F.sum("raw")).first()[0] or 0
    return max(1, math.ceil(total / BUCKET_BYTES))


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin in sorted 64-bit ``keys``, and the total."""
    bounds = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]]).astype(np.int64)


def emitted(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names
        )


KEYS = "bucket int, block bigint, size int, keys binary, twice binary"
KEY_NAMES = ["bucket", "block", "size", "keys", "twice"]
BITS = "bucket int, block bigint, bits binary"
KEY_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
_BIT_TYPES = [pa.int32(), pa.int64(), pa.binary()]

# A key of 128 bits; the first half decides the bucket.
WIDE = np.dtype([("a", "<u8"), ("b", "<u8")])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, which occur more than once, index of each key's entry)."""
    if keys.dtype == WIDE:
        order = np.lexsort((keys["b"], keys["a"]))
    else:
        order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    head = np.ones(len(keys), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    index = np.empty(len(keys), np.int64)
    index[order] = np.cumsum(head) - 1
    counts = np.diff(np.append(np.flatnonzero(head), len(keys)))
    return ordered[head], counts > 1, index


def _squeezed(keys: np.ndarray) -> bytes:
    """Sorted distinct keys: the first, then 32-bit steps; plain where a step is longer."""
    if keys.dtype == WIDE:
        return keys.tobytes()
    steps = np.diff(keys)
    if len(steps) < 2 or steps.max() >> np.uint64(32):
        return keys.tobytes()
    return keys[:1].tobytes() + steps.astype("<u4").tobytes()


def _spread(raw: bytes, count: int, kind: np.dtype) -> np.ndarray:
    if len(raw) == count * kind.itemsize:
        return np.frombuffer(raw, kind)
    steps = np.frombuffer(raw, "<u4", offset=8)
    return np.cumsum(np.concatenate([np.frombuffer(raw, "<u8", 1), steps.astype(np.uint64)]), dtype=np.uint64)


def key_rows(block: int, keys: np.ndarray, twice: np.ndarray, buckets: int) -> list[tuple]:
    """Rows of KEYS for one block's sorted distinct keys."""
    edges = bucket_edges(keys["a"] if keys.dtype == WIDE else keys, buckets).tolist()
    return [
        (k, block, b - a, _squeezed(keys[a:b]), np.packbits(twice[a:b]).tobytes())
        for k, (a, b) in enumerate(zip(edges, edges[1:]))
        if b > a
    ]


def _shared(kind: np.dtype):
    def find(table: pa.Table) -> pa.Table:
        sizes = table.column("size").to_pylist()
        parts = [_spread(k, n, kind) for k, n in zip(table.column("keys").to_pylist(), sizes)]
        marks = [
            np.unpackbits(np.frombuffer(t, np.uint8), count=len(p)).astype(bool)
            for t, p in zip(table.column("twice").to_pylist(), parts)
        ]
        _, twice, index = distinct(np.concatenate(parts))
        np.logical_or.at(twice, index, np.concatenate(marks))
        found = twice[index]
        rows = []
        at = 0
        bucket = table.column("bucket")[0].as_py()
        for block, part in zip(table.column("block").to_pylist(), parts):
            bits = found[at : at + len(part)]
            at += len(part)
            if bits.any():
                rows.append((bucket, block, np.packbits(bits).tobytes()))
        return pa.Table.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(_BIT_TYPES)], names=["bucket", "block", "bits"]
        )

    return find


def shared_keys(keys: DataFrame, wide: bool = False) -> DataFrame:
    """Per (bucket, block) one bit per key sent: held more than once in the corpus."""
    kind = WIDE if wide else np.dtype("<u8")
    return keys.groupBy("bucket").applyInArrow(_shared(kind), BITS)


def answers(bits: DataFrame, name: str) -> DataFrame:
    """One row per block: its buckets' bits, which a block's own keys bound."""
    return bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))


def read_bits(answer: list[dict] | None, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bits of a block's sorted distinct keys, put together from its answer."""
    out = np.zeros(len(keys), bool)
    if answer:
        edges = bucket_edges(keys["a"] if keys.dtype == WIDE else keys, buckets)
        for part in answer:
            a, b = edges[part["bucket"]], edges[part["bucket"] + 1]
            out[a:b] = np.unpackbits(np.frombuffer(part["bits"], np.uint8), count=b - a).astype(bool)
    return out
