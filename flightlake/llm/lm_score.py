"""Scoring documents by cross-entropy difference of two matched n-gram models.

Both models are bigram models over the ids of one public tokenizer, so they
share their vocabulary; both smooth alike, with Dirichlet weight ``PRIOR`` towards
their own unigrams (add one).  The target model is counted on the documents
chosen as target, the background model on all documents, with counts scaled to
the target's size.  The score of a document is the mean over its tokens of the
target's loss minus the background's (nats; low is like the target).  A document
is left out of the counts that it is scored with.

Counts come from every document, each encoded once: its ids are written, in blocks.
Each block of documents sends its distinct bigrams with their counts, packed, to buckets by a hash of the bigram; a bucket
adds them up and answers each block with the totals of the bigrams that it
sent.  The vocabulary bounds the unigram counts, which are collected; bigrams
grow with the corpus and stay distributed.

Null text and texts without tokens have no losses (null); repeated rows count
each; a null id is never a target; without any target document its model is
the uniform prior.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm import blocks as B
from flightlake.llm import bpe
from flightlake.llm.arrow import strings
from flightlake.llm.words import mix
from flightlake.operators.sizing import broadcast_if_small
from flightlake.session import materialize

START = 50256  # the id before a document's first
VOCABULARY = 50257
PRIOR = 100.0

RESULT = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, score double"


# -- packed integers ----------------------------------------------------------


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Integers below 2**32 (as steps if they rise), byte by byte, compressed."""
    small = (np.diff(values, prepend=values[:1] * 0) if rising else values).astype("<u4")
    planes = small.view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(raw: bytes, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    values = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
    return np.cumsum(values) if rising else values


# -- tokens of a block --------------------------------------------------------


def _ids(path: str) -> B.Turn:
    """Rows of text become their doc_id and the ids of the text."""

    def turn(rows: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = bpe.encoder(path).encode(strings(rows.column("text")))
        lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(ids, pa.uint32()).cast(pa.uint16()))
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), lists], names=["doc_id", "ids"])

    return turn


class Tokens:
    """Ids of a block's texts, each with the id before it."""

    def __init__(self, lists: pa.LargeListArray):
        self.bounds = lists.offsets.to_numpy()
        self.ids = lists.values.to_numpy().astype(np.int64)
        self.before = np.empty_like(self.ids)
        self.before[1:] = self.ids[:-1]
        count = np.diff(self.bounds)
        self.before[self.bounds[:-1][count > 0]] = START
        self.text = np.repeat(np.arange(len(count)), count)
        self.key = self.before << 16 | self.ids


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where values are in rising order, and where each distinct one begins in it, with the total.

    Values and places share 64 bits: up to 2**32 places of values below 2**32.
    """
    shift = np.uint64(len(values).bit_length())
    packed = values.astype(np.uint64) << shift | np.arange(len(values), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    packed >>= shift
    head = np.ones(len(values) + 1, bool)
    np.not_equal(packed[1:], packed[:-1], out=head[1:-1])
    return order, np.flatnonzero(head) if len(values) else np.zeros(1, np.int64)


def _index(order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The number of each place's distinct value."""
    index = np.empty(len(order), np.int64)
    index[order] = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return index


def _bucketed(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of distinct keys by bucket, then key, and where each bucket begins."""
    bucket = mix(keys.astype(np.uint64)) % np.uint64(buckets)
    order = np.argsort(bucket << np.uint64(32) | keys.astype(np.uint64))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


_SENT = "bucket int, block bigint, keys binary, target binary, every binary"
_TOTAL = "bucket int, block bigint, target binary, every binary"


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.RecordBatch]]:
    for batch in batches:
        for row in B.rows_of(batch):
            yield row, B.open_block(row["data"])


def _in_target(row: dict, count: int) -> np.ndarray:
    flags = np.zeros(count, bool)
    flags[row["chosen"] or []] = True
    return flags


def _send(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, rows in _opened(batches):
            tokens = Tokens(rows.column("ids"))
            chosen = _in_target(row, rows.num_rows)[tokens.text]
            place, begin = runs(tokens.key)
            keys, every = tokens.key[place[begin[:-1]]], np.diff(begin)
            target = np.diff(np.concatenate([[0], np.cumsum(chosen[place])])[begin])
            order, first = _bucketed(keys, buckets)
            out = []
            for bucket, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist())):
                if b > a:
                    part = order[a:b]
                    out.append((bucket, row["block"], pack(keys[part], True), pack(target[part]), pack(every[part])))
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield from B.emitted(out, ["bucket", "block", "keys", "target", "every"], kinds)

    return send


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    parts = [unpack(k, True) for k in table.column("keys").to_pylist()]
    sent = np.concatenate(parts)
    order, first = runs(sent)
    keys, index = sent[order[first[:-1]]], _index(order, first)
    totals = []
    for name in ("target", "every"):
        own = np.concatenate([unpack(v) for v in table.column(name).to_pylist()])
        totals.append(np.bincount(index, weights=own, minlength=len(keys)).astype(np.int64))
    return keys, index, *totals, [len(p) for p in parts]


def _totals(table: pa.Table) -> pa.Table:
    """Each block's bigrams with the corpus's counts."""
    _, index, target, every, sizes = _summed(table)
    rows, at = [], 0
    for bucket, block, size in zip(table.column("bucket").to_pylist(), table.column("block").to_pylist(), sizes):
        own = index[at : at + size]
        rows.append((bucket, block, pack(target[own]), pack(every[own])))
        at += size
    kinds = pa.int32(), pa.int64(), pa.binary(), pa.binary()
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "block", "target", "every"])


_ONES = "id int, target bigint, every bigint, target_before bigint, every_before bigint"


def _ones(table: pa.Table) -> pa.Table:
    """Counts of the ids in a bucket's bigrams, as second and as first of the two."""
    keys, _, target, every, _ = _summed(table)
    columns = [np.bincount(i, weights=c, minlength=VOCABULARY).astype(np.int64) for i in (keys & 0xFFFF, keys >> 16) for c in (target, every)]
    some = np.flatnonzero(sum(columns))
    return pa.Table.from_arrays(
        [pa.array(some, pa.int32()), *(pa.array(c[some]) for c in columns)],
        names=[f.split(" ")[0] for f in _ONES.split(", ")],
    )


# -- losses -------------------------------------------------------------------


def losses(pair: np.ndarray, context: np.ndarray, one: np.ndarray, total: float) -> np.ndarray:
    """Negative log probabilities of tokens from counts of the pair, its first id and its second id."""
    unigram = (one + 1.0) / (total + VOCABULARY)
    return -np.log((pair + PRIOR * unigram) / (context + PRIOR))


def _own_counts(text: np.ndarray, values: np.ndarray, most: int) -> np.ndarray:
    """How often each token's value, below ``most``, occurs in its own text."""
    order, first = runs(text * most + values)
    times = np.diff(first)
    out = np.empty(len(order))
    out[order] = np.repeat(times, times)
    return out


def _score(buckets: int, ones: dict[str, np.ndarray]):
    sizes = {m: float(ones[m].sum()) for m in ("target", "every")}
    scale = sizes["target"] / sizes["every"] if sizes["target"] else 1.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, rows in _opened(batches):
            tokens = Tokens(rows.column("ids"))
            place, begin = runs(tokens.key)
            keys, index = tokens.key[place[begin[:-1]]], _index(place, begin)
            order, first = _bucketed(keys, buckets)
            chosen = _in_target(row, rows.num_rows)[tokens.text]
            own_pair = _own_counts(tokens.text, index, len(keys))
            own_before, own_one = (_own_counts(tokens.text, v, VOCABULARY) for v in (tokens.before, tokens.ids))
            length = np.diff(tokens.bounds)[tokens.text]
            sums = []
            for model, share, size in (("target", 1.0, sizes["target"]), ("every", scale, sizes["every"])):
                pair = np.zeros(len(keys))
                for part in row["totals"] or []:
                    pair[order[first[part["bucket"]] : first[part["bucket"] + 1]]] = unpack(part[model])
                out = chosen if model == "target" else np.ones(len(chosen), bool)
                loss = losses(
                    (pair[index] - own_pair * out) * share,
                    (ones[f"{model}_before"][tokens.before] - own_before * out) * share,
                    (ones[model][tokens.ids] - own_one * out) * share,
                    (size - length * out) * share,
                )
                sums.append(np.bincount(tokens.text, weights=loss, minlength=rows.num_rows))
            n = np.diff(tokens.bounds)
            none = n == 0
            mean = [s / np.maximum(n, 1) for s in sums]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n, pa.int64()), *(pa.array(m, mask=none) for m in (*mean, mean[0] - mean[1]))],
                names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
            )

    return score


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, rows in _opened(batches):
        ids = rows.column("doc_id")
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([row["block"]] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int32())], names=["doc_id", "block", "row"]
        )


def score(docs: DataFrame, target: DataFrame, tokenizer: str | None = None, text_column: str = "text") -> DataFrame:
    """Losses per token of every document; ``target`` holds the doc_ids of the target documents."""
    path = tokenizer or bpe.tokenizer_path()
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    stored = B.to_blocks(slim, "text", _ids(path))
    buckets = B.bucket_count(stored)
    places = stored.mapInArrow(_places, "doc_id bigint, block bigint, row int")
    wanted = target.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    chosen = materialize(places.join(wanted, "doc_id").groupBy("block").agg(F.collect_list("row").alias("chosen")), "chosen")
    told = stored.join(broadcast_if_small(chosen), "block", "left")

    sent = told.select("block", "data", "chosen").mapInArrow(_send(buckets), _SENT)
    grouped = materialize(sent, "bigrams").groupBy("bucket")
    counted = grouped.applyInArrow(_ones, _ONES).groupBy("id").agg(*(F.sum(c).alias(c) for c in ("target", "every", "target_before", "every_before")))
    ones = {c: np.zeros(VOCABULARY) for c in ("target", "every", "target_before", "every_before")}
    for r in counted.collect():  # at most one row per vocabulary id
        for c in ones:
            ones[c][r["id"]] = r[c]
    totals = grouped.applyInArrow(_totals, _TOTAL).groupBy("block").agg(F.collect_list(F.struct("bucket", "target", "every")).alias("totals"))
    return told.select("block", "data", "chosen").join(totals, "block", "left").mapInArrow(_score(buckets, ones), RESULT)
