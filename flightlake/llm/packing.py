"""Packing documents into fixed windows by best-fit decreasing.

A document is its token ids and an end id.  Documents longer than a window are
first cut into full windows; what is left of each is packed by best-fit
decreasing: pieces in order of falling length, each into the open window with
the least room that still holds it.  A segment tree indexed by remaining room
finds that window.

Rows: pieces are numbered as they are written and dealt to groups by a hash of
that number, about ``GROUP_PIECES`` to a group, whatever share of the rows has the
same id or none.  Each group is packed by itself, so the memory of a task is
bounded and at most a few windows per group stay part empty.  Token
ids never leave the task that made them; only piece lengths are shuffled.

Null text counts as empty (a document of the end id alone), repeated rows are
packed each on their own, ties in length go by doc_id, start and number, an empty table
gives an empty result, and other columns of the input are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm import bpe
from flightlake.llm.arrow import slices, strings
from flightlake.session import materialize

WINDOW = 2048
END_ID = 1
GROUP_PIECES = 100_000

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"


def _cutter(tokenizer: str, window: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(tokenizer)
        for batch in slices(batches, "text"):
            ids, bounds = encoder.encode(strings(batch.column("text")))
            rows: list[tuple] = []
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id)).astype("<u4")
                for start in range(0, len(own), window):
                    piece = own[start : start + window]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(own)))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return cut


class RoomTree:
    """How many open windows there are for each remaining room, as a segment tree."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def tightest(self, length: int) -> int:
        """The least room of at least ``length`` that some open window has, or -1."""
        count = self.count
        node = length + self.size
        while not count[node]:
            while node & 1:  # a right child: go up until there is something to the right
                node >>= 1
            if node <= 1:
                return -1
            node += 1
        while node < self.size:
            node *= 2
            if not count[node]:
                node += 1
        return node - self.size

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, window: int, offset: int) -> None:
        self.open[room].append((window, offset))
        self._change(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._change(room, -1)
        return self.open[room].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """(window, offset) of each piece; ``lengths`` must fall or stay equal."""
    tree = RoomTree(window)
    windows: list[int] = []
    offsets: list[int] = []
    opened = 0
    for length in lengths:
        room = tree.tightest(length)
        if room < 0:
            number, offset, room = opened, 0, window
            opened += 1
        else:
            number, offset = tree.take(room)
        windows.append(number)
        offsets.append(offset)
        if room > length:
            tree.put(room - length, number, offset + length)
    return windows, offsets


def _packer(window: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "piece"], ascending=[False, True, True, True])
        windows, offsets = best_fit(rows["length"].tolist(), window)
        group = int(rows["pack_group"].iloc[0])
        rows["sequence_id"] = np.asarray(windows, np.int64) + (group << 32)
        rows["offset"] = np.asarray(offsets, np.int64)
        return rows.drop(columns=["piece", "pack_group"])

    return pack


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: where it begins in its document and where it lies in its sequence."""
    tokenizer = tokenizer or bpe.tokenizer_path()
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    cut = slim.mapInArrow(_cutter(tokenizer, window, end_id), PIECES)
    pieces = materialize(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(pieces.count() / GROUP_PIECES))
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInPandas(_packer(window), PACKED)
