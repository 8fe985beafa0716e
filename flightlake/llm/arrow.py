"""Arrow batches inside tasks: bounded slices of rows and raw views of text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that a task turns into numpy arrays at once.  The arrays take
# about 40 times as much, so this bounds a Python worker's memory; a single
# longer text is worked on alone.
SLICE_BYTES = 1 << 20


def text_lengths(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes per row; null counts as empty."""
    offsets = utf8_view(texts)[1]
    return np.diff(offsets)


def utf8_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array, without copies; null is empty."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, bounds, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    if bounds is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(bounds, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``size`` bytes of ``text``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        total = np.cumsum(text_lengths(batch.column(text)))
        begin = 0
        while begin < batch.num_rows:
            base = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, base + size, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def strings(texts: pa.Array) -> list[str]:
    """Python strings; null is empty."""
    return [t or "" for t in texts.to_pylist()]


def packed_rows(arrays: list[np.ndarray]) -> pa.Array:
    """One binary value per numpy array, holding its little-endian bytes."""
    return pa.array([a.tobytes() for a in arrays], pa.binary())
