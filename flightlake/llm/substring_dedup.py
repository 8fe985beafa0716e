"""Removal of word sequences that occur more than once, by seed and extend.

Seeds: hashes of ``width // 2 + 1`` consecutive words, thinned by winnowing: of
each run of consecutive hashes that a window of ``width`` words holds, the
smallest is an anchor (the rightmost on ties).  Equal windows choose equal
anchors, so only windows whose anchor occurs again can repeat.  Extension: each
occurrence of a repeated anchor is extended to the left and right through the
windows that chose it, and these windows (128-bit hashes) are looked for in the
whole corpus.  Overlapping windows that were found again make up the maximal
repeats, which are at least ``width`` words long; their words go.  Anchors and
windows meet by ``blocks``: never as pairs, and a passage that very many
documents hold costs one entry per block.

Words are maximal runs without space and 0x09-0x0D, unchanged.  Null text has no
words; texts shorter than the width lose nothing; repeated rows repeat each
other; an empty table gives an empty result.  Other columns are kept; a column
with the name of a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm import blocks as B
from flightlake.llm import words as W
from flightlake.llm.arrow import utf8_view
from flightlake.session import materialize

WIDTH = 35

RESULT = ["n_words", "n_removed", "kept_text", "repeats"]


class Text:
    """Words of a block's texts, the windows of ``width`` words and their anchors."""

    def __init__(self, rows: pa.RecordBatch, column: str, width: int):
        self.data, self.offsets = utf8_view(rows.column(column))
        self.words = W.find_words(self.data, self.offsets)
        self.hashes = W.word_hashes(self.data, self.words)
        self.width = width
        self.starts = W.window_starts(self.words.first, width)
        self.places = self._places()  # gram that each window chose
        self.anchors = self.grams[self.places]

    def _places(self) -> np.ndarray:
        size = self.width // 2 + 1
        run = self.width - size + 1
        if not len(self.starts):
            self.grams = np.zeros(0, np.uint64)
            return np.zeros(0, np.int64)
        every = np.arange(len(self.hashes) - size + 1)
        self.grams = W.window_hashes(self.hashes, every, size)
        least = (self.grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - every.astype(np.uint64))
        span = 1
        while span * 2 <= run:
            least = np.minimum(least[: len(least) - span], least[span:])
            span *= 2
        rest = run - span
        if rest:
            least = np.minimum(least[: len(least) - rest], least[rest:])
        return (np.uint64(0xFFFFFFFF) - (least[self.starts] & np.uint64(0xFFFFFFFF))).astype(np.int64)

    def window_keys(self, chosen: np.ndarray) -> np.ndarray:
        keys = np.empty(int(chosen.sum()), B.WIDE)
        starts = self.starts[chosen]
        keys["a"] = W.window_hashes(self.hashes, starts, self.width)
        second = W.word_hashes(self.data, self.words, 1)
        keys["b"] = W.window_hashes(second, starts, self.width, 1)
        return keys

    def anchor_bits(self, answer, buckets: int) -> np.ndarray:
        """Which windows have an anchor that occurs elsewhere too."""
        keys, _, index = B.distinct(self.anchors)
        return B.read_bits(answer, keys, buckets)[index] if len(keys) else np.zeros(0, bool)


def _anchor_keys(column: str, width: int, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in B.rows_of(batch):
                text = Text(B.open_block(row["data"]), column, width)
                keys, _, index = B.distinct(text.anchors)
                moved = np.diff(text.places, prepend=-1) != 0
                twice = np.bincount(index[moved], minlength=len(keys)) > 1
                yield from B.emitted(B.key_rows(row["block"], keys, twice, buckets), B.KEY_NAMES, B.KEY_TYPES)

    return send


def _window_keys(column: str, width: int, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in B.rows_of(batch):
                text = Text(B.open_block(row["data"]), column, width)
                chosen = text.anchor_bits(row["anchors"], buckets)
                keys, twice, _ = B.distinct(text.window_keys(chosen))
                yield from B.emitted(B.key_rows(row["block"], keys, twice, buckets), B.KEY_NAMES, B.KEY_TYPES)

    return send


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _remover(column: str, width: int, buckets: int, names: list[str], schema: pa.Schema):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in B.rows_of(batch):
                rows = B.open_block(row["data"])
                text = Text(rows, column, width)
                chosen = text.anchor_bits(row["anchors"], buckets)
                keys, _, index = B.distinct(text.window_keys(chosen))
                again = B.read_bits(row["windows"], keys, buckets)[index] if len(keys) else np.zeros(0, bool)
                first, begins, ends = text.words.first, text.words.begins, text.words.ends
                gone = W.covered(text.starts[chosen][again], width, len(begins))
                kept = np.flatnonzero(~gone)
                size = ends[kept] - begins[kept] + 1
                padded = np.append(text.data, np.uint8(32))
                joined = padded[W.ranges(begins[kept], size)]
                after = np.cumsum(size)
                joined[after - 1] = 32
                bound = np.concatenate([[0], after])[np.searchsorted(kept, first)]
                raw = joined.tobytes()
                total = np.concatenate([[0], np.cumsum(gone)])
                texts, repeats = [], []
                for i, (a, b) in enumerate(zip(bound[:-1].tolist(), bound[1:].tolist())):
                    texts.append(raw[a : b - 1].decode() if b > a else "")
                    lo, hi = first[i], first[i + 1]
                    left, right = _runs(gone[lo:hi]) if total[hi] > total[lo] else ((), ())
                    repeats.append([{"first": int(x), "words": int(y - x)} for x, y in zip(left, right)])
                made = dict(zip(RESULT, (
                    pa.array(np.diff(first), pa.int64()), pa.array(total[first[1:]] - total[first[:-1]], pa.int64()),
                    pa.array(texts, pa.string()), pa.array(repeats, schema.field("repeats").type),
                )))
                yield pa.RecordBatch.from_arrays(
                    [made[n] if n in made else rows.column(n) for n in names], names=names
                )

    return remove


def remove_repeats(docs: DataFrame, width: int = WIDTH, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with their number of words and of words removed, what
    is left (words joined by one space) and the maximal repeats as word spans."""
    stored = B.to_blocks(docs, text_column)
    buckets = B.bucket_count(stored)
    anchors = B.shared_keys(stored.mapInArrow(_anchor_keys(text_column, width, buckets), B.KEYS))
    anchors = materialize(B.answers(anchors, "anchors"), "anchors")
    seeded = stored.join(anchors, "block", "left")
    windows = B.shared_keys(seeded.mapInArrow(_window_keys(text_column, width, buckets), B.KEYS), wide=True)
    both = anchors.join(B.answers(windows, "windows"), "block", "left")
    names = [c for c in docs.columns if c not in RESULT] + RESULT
    kinds = {f.name: f for f in docs.schema.fields}
    repeat = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("words", T.LongType())]))
    new = dict(zip(RESULT, (T.LongType(), T.LongType(), T.StringType(), repeat)))
    schema = T.StructType([T.StructField(n, new[n]) if n in new else kinds[n] for n in names])
    plain = pa.schema([("repeats", pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())])))])
    return stored.join(both, "block", "left").mapInArrow(_remover(text_column, width, buckets, names, plain), schema)


def digest(cleaned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of what is left."""
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
