"""BPE encoding with content-defined chunk reuse, and decoding.

Texts are cut where a rolling hash of the last ``ROLL`` code points hits a fixed
residue, so equal passages are cut alike wherever they stand.  Chunks (told
apart by 128-bit hashes) that occur more than once in the corpus are encoded
once, by the block of documents that owns the chunk, and go to the documents
that hold them as ids; other texts are encoded where they are.

A cut may fall inside a word, so ids on both sides of a join are not yet those of
the whole text.  Joins are repaired: the stretch around a cut is widened, across
further chunks if need be, to the nearest places where text ends and white space
begins.  No piece of the tokenizer reaches across such a place from either side,
so the encodings left and right of the stretch agree with the whole text's, and
the stretch itself is encoded anew.

Null text counts as empty (no ids); repeated rows are encoded each (through the
chunks they share); an empty table gives an empty result.  Other columns are
kept; columns named ``ids`` or ``decoded`` are replaced.  The input is read three
times and must give the same rows in the same order each time, as a table does;
a mismatch raises an error.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm import blocks as B
from flightlake.llm import bpe
from flightlake.llm.arrow import strings
from flightlake.llm.words import ranges, rolling_hash, spans_hash
from flightlake.operators.sizing import broadcast_if_small
from flightlake.session import materialize

ROLL = 16
MEAN = 512  # code points between cuts, on average
LEAST, MOST = 128, 4096
BLOCK_BYTES = 1 << 19

_BASES = (0xC2B2AE3D27D4EB4F | 1, 0x165667B19E3779F9 | 1)


# -- chunks of a block --------------------------------------------------------


class Chunks:
    """Texts that lie one after the other, cut into chunks."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.joined = "".join(texts)
        self.codes = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        self.offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=self.offsets[1:])
        values = self.codes.astype(np.uint64) + np.uint64(0x2545)
        values *= np.uint64(0xBF58476D1CE4E5B9)
        values ^= values >> np.uint64(29)
        rolled = rolling_hash(values, ROLL, _BASES[0])
        places = np.flatnonzero(rolled < np.uint64((1 << 64) // (MEAN - LEAST))) + ROLL
        self.begins, self.first = self._cut(places.tolist())
        self.ends = np.append(self.begins[1:], len(values)) if len(self.begins) else np.zeros(0, np.int64)
        self.keys = np.empty(len(self.begins), B.WIDE)
        self.keys["a"] = spans_hash(values, self.begins, self.ends, _BASES[0])
        self.keys["b"] = spans_hash(values, self.begins, self.ends, _BASES[1])

    def _cut(self, places: list[int]) -> tuple[np.ndarray, np.ndarray]:
        begins, first = [], [0]
        for start, end in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            at = start
            while at < end:
                begins.append(at)
                # a hash that reaches before the text would depend on its neighbour
                k = bisect_left(places, max(at + LEAST, start + ROLL))
                at = min(places[k] if k < len(places) else end, at + MOST, end)
            first.append(len(begins))
        return np.array(begins, np.int64), np.array(first, np.int64)


def safe_places(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Positions where white space follows something else: no piece reaches across."""
    blank = kinds[codes] <= bpe.SPACE
    return np.flatnonzero(blank[1:] & ~blank[:-1]) + 1


class Assembler:
    """Encodes texts from known chunks, fresh chunks and repaired joins."""

    def __init__(self, path: str):
        self.encoder = bpe.encoder(path)
        vocabulary = self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        letters = _byte_letters()
        special = {t.content for t in self.encoder.tokenizer.get_added_tokens_decoder().values()}
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.tokens[number] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.sizes = np.array([len(t) for t in self.tokens])
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.begin = np.cumsum(self.sizes) - self.sizes

    def encode(self, chunks: Chunks, rows: list[int], known: dict[bytes, np.ndarray]) -> list[np.ndarray]:
        """The ids of the chosen texts."""
        safe = safe_places(chunks.codes, self.encoder.kinds)
        keys = [k.tobytes() for k in chunks.keys]
        fresh: dict[bytes, int] = {}
        stretches: list[tuple[int, int]] = []
        plans: list[list[tuple[int, int, int]]] = []  # (chunk or -1, begin, end)
        for row in rows:
            plan = []
            start, end = int(chunks.offsets[row]), int(chunks.offsets[row + 1])
            a, b = int(chunks.first[row]), int(chunks.first[row + 1])
            if not any(keys[c] in known for c in range(a, b)):
                if end > start:
                    plan.append((-1, start, end))  # nothing to reuse
                plans.append(plan)
                continue
            joins: list[list[int]] = []
            for cut in chunks.begins[a + 1 : b].tolist():
                k = int(np.searchsorted(safe, cut, "right"))
                left = max(start, int(safe[k - 1])) if k else start
                k = int(np.searchsorted(safe, cut))
                right = min(end, int(safe[k])) if k < len(safe) else end
                if joins and left < joins[-1][1]:
                    joins[-1][1] = max(joins[-1][1], right)
                elif left < right:
                    joins.append([left, right])
            cursor, c = start, a
            for left, right in [*joins, (end, end)]:
                while cursor < left:
                    while chunks.ends[c] <= cursor:
                        c += 1
                    until = min(left, int(chunks.ends[c]))
                    plan.append((c, cursor, until))
                    if keys[c] not in known:
                        fresh.setdefault(keys[c], c)
                    cursor = until
                if left < right:
                    plan.append((-1, left, right))
                    cursor = right
            plans.append(plan)
        for plan in plans:
            stretches += [(x, y) for c, x, y in plan if c < 0]
        own = list(fresh.values())
        wanted = [chunks.joined[int(chunks.begins[c]) : int(chunks.ends[c])] for c in own]
        wanted += [chunks.joined[x:y] for x, y in stretches]
        ids, bounds = self.encoder.encode(wanted)
        parts = [ids[x:y] for x, y in zip(bounds, bounds[1:])]
        known = known | dict(zip(fresh, parts))
        stretch = iter(parts[len(own) :])
        width = 1 + (chunks.codes >= 0x80) + (chunks.codes >= 0x800) + (chunks.codes >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width)])
        out = []
        for plan in plans:
            pieces = [next(stretch) if c < 0 else self._inside(known[keys[c]], place, int(chunks.begins[c]), int(chunks.ends[c]), x, y) for c, x, y in plan]
            out.append(np.concatenate(pieces) if pieces else np.zeros(0, np.uint32))
        return out

    def _inside(self, ids: np.ndarray, place: np.ndarray, begin: int, end: int, x: int, y: int) -> np.ndarray:
        """Ids of the part [x, y) of a chunk [begin, end); its edges are edges of ids."""
        if (x, y) == (begin, end):
            return ids
        after = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        want = place[[x, y]] - place[begin]
        a, b = np.searchsorted(after, want)
        if after[a] != want[0] or after[b] != want[1]:
            raise ValueError("a chunk's ids do not meet a safe place")
        return ids[a:b]

    def decode(self, ids: np.ndarray) -> str:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids.tolist()]).decode("utf-8", "replace")

    def decode_texts(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts of ids that lie one text after the other."""
        size = self.sizes[ids]
        data = self.bytes[ranges(self.begin[ids], size)]
        offsets = np.concatenate([[0], np.cumsum(size)])[bounds]
        heads = data[offsets[offsets < len(data)]]
        try:
            data.tobytes().decode()
        except UnicodeDecodeError:
            valid = False
        else:
            valid = not (heads & 0xC0 == 0x80).any()  # no code point across two texts
        if not valid or len(data) >> 31:
            return pa.array([self.decode(ids[a:b]) for a, b in zip(bounds, bounds[1:])], pa.string())
        return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)})
    return letters


_assemblers: dict[str, Assembler] = {}


def assembler(path: str) -> Assembler:
    if path not in _assemblers:
        _assemblers[path] = Assembler(path)
    return _assemblers[path]


# -- chunks of the corpus -----------------------------------------------------


def _opened(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[int, pa.RecordBatch, Chunks, list]]:
    """(block, rows, chunks, states) of each block."""
    for batch in batches:
        for row in B.rows_of(batch):
            rows = B.open_block(row["data"])
            yield row["block"], rows, Chunks(strings(rows.column(text))), row.get("states") or []


def _send_keys(text: str, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, chunks, _ in _opened(batches, text):
            keys, twice, _ = B.distinct(chunks.keys)
            yield from B.emitted(B.key_rows(block, keys, twice, buckets), B.KEY_NAMES, B.KEY_TYPES)

    return send


def _owners(table: pa.Table) -> pa.Table:
    """Per (bucket, block) a byte per key: 0 held once, 1 shared and owned here, 2 shared."""
    order = np.argsort(table.column("block").to_numpy(), kind="stable")
    keys = [np.frombuffer(table.column("keys")[int(i)].as_py(), B.WIDE) for i in order]
    twice = [np.unpackbits(np.frombuffer(table.column("twice")[int(i)].as_py(), np.uint8), count=len(k)) for i, k in zip(order, keys)]
    every, many, index = B.distinct(np.concatenate(keys))
    shared = many.copy()
    np.logical_or.at(shared, index, np.concatenate(twice).astype(bool))
    first = np.full(len(every), len(index))
    np.minimum.at(first, index, np.arange(len(index)))
    state = np.where(shared[index], np.where(first[index] == np.arange(len(index)), 1, 2), 0).astype(np.uint8)
    rows, at = [], 0
    bucket = table.column("bucket")[0].as_py()
    for i, k in zip(order.tolist(), keys):
        rows.append((bucket, table.column("block")[i].as_py(), state[at : at + len(k)].tobytes()))
        at += len(k)
    columns = list(zip(*rows))
    kinds = pa.int32(), pa.int64(), pa.binary()
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "block", "bits"])


def _states(answer: list[dict], chunks: Chunks, buckets: int) -> np.ndarray:
    keys, _, index = B.distinct(chunks.keys)
    out = np.zeros(len(keys), np.uint8)
    edges = B.bucket_edges(keys["a"], buckets)
    total = 0
    for part in answer or []:
        a, b = edges[part["bucket"]], edges[part["bucket"] + 1]
        state = np.frombuffer(part["bits"], np.uint8)
        total += len(state)
        if len(state) != b - a:
            break
        out[a:b] = state
    if total != len(keys):
        raise ValueError("the documents changed between two readings; write them to a table first")
    return out[index]


_ROWS = "kind int, bucket int, block long, keys binary, sizes binary, data binary"
_ROW_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
_ROW_NAMES = ["kind", "bucket", "block", "keys", "sizes", "data"]
WORDS, WANTED, WAITING, HELD = range(4)


def _squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _own_chunks(path: str, text: str, buckets: int):
    """Encoded chunks that the block owns, and its documents that hold shared chunks with the keys
    they want; for later, a bit per document that holds any."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = assembler(path)
        for block, batch, chunks, states in _opened(batches, text):
            state = _states(states, chunks, buckets)
            keys, _, index = B.distinct(chunks.keys)
            place = np.full(len(keys), -1)
            place[index[state == 1]] = np.flatnonzero(state == 1)
            own = np.flatnonzero(place >= 0)
            ids, bounds = tool.encoder.encode([chunks.joined[int(chunks.begins[c]) : int(chunks.ends[c])] for c in place[own]])
            rows = []
            edges = np.searchsorted(own, B.bucket_edges(keys["a"], buckets))
            for bucket, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
                if b > a:
                    sizes = np.diff(bounds[a : b + 1]).astype("<u4")
                    data = _squeeze(ids[bounds[a] : bounds[b]].astype("<u4").tobytes())
                    rows.append((WORDS, bucket, block, keys[own[a:b]].tobytes(), sizes.tobytes(), data))
            shared = np.zeros(len(keys), bool)
            shared[index[state > 0]] = True
            wanted = np.flatnonzero(shared)
            edges = np.searchsorted(wanted, B.bucket_edges(keys["a"], buckets))
            for bucket, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
                if b > a:
                    rows.append((WANTED, bucket, block, keys[wanted[a:b]].tobytes(), None, None))
            held = _holders(state, chunks.first)
            rows.append((HELD, None, block, np.packbits(held).tobytes(), None, None))
            if held.any():
                rows.append((WAITING, None, block, None, None, _squeeze(B.stream_bytes(batch.filter(pa.array(held))))))
            yield from B.emitted(rows, _ROW_NAMES, _ROW_TYPES)

    return send


def _holders(state: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which documents hold a shared chunk."""
    total = np.concatenate([[0], np.cumsum(state > 0)])
    return total[first[1:]] > total[first[:-1]]


_ANSWER = "block long, keys binary, sizes binary, data binary"


def _answer(table: pa.Table) -> pa.Table:
    """Hands the encoded chunks of a bucket to the blocks that want them."""
    known: dict[bytes, np.ndarray] = {}
    wanted = []
    for row in table.to_pylist():
        if row["kind"] == WORDS:
            known.update(_unpack(row))
        else:
            wanted.append(row)
    rows = []
    for row in wanted:
        ids = [known[k.tobytes()] for k in np.frombuffer(row["keys"], B.WIDE)]
        sizes = np.array([len(i) for i in ids], "<u4")
        rows.append((row["block"], row["keys"], sizes.tobytes(), _squeeze(np.concatenate(ids).astype("<u4").tobytes())))
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = pa.int64(), pa.binary(), pa.binary(), pa.binary()
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "keys", "sizes", "data"])


def _unpack(row: dict) -> dict[bytes, np.ndarray]:
    keys = np.frombuffer(row["keys"], B.WIDE)
    sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
    ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), "<u4")
    after = np.cumsum(sizes)
    return {k.tobytes(): ids[b - n : b] for k, n, b in zip(keys, sizes.tolist(), after.tolist())}


def _result(batch: pa.RecordBatch, columns: list[str], ids: np.ndarray, bounds: np.ndarray, tool: Assembler) -> pa.RecordBatch:
    made = {
        "ids": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32))),
        "decoded": tool.decode_texts(ids, bounds),
    }
    return pa.RecordBatch.from_arrays([made.get(c) if c in made else batch.column(c) for c in columns], names=columns)


def _alone(path: str, text: str, columns: list[str]):
    """Documents without a shared chunk: nothing of them is cut or hashed again."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = assembler(path)
        for batch in batches:
            for row in B.rows_of(batch):
                rows = B.open_block(row["data"])
                if len(row["held"]) != (rows.num_rows + 7) // 8:
                    raise ValueError("the documents changed between two readings; write them to a table first")
                held = np.unpackbits(np.frombuffer(row["held"], np.uint8), count=rows.num_rows)
                if held.all():
                    continue
                chosen = rows.take(pa.array(np.flatnonzero(held == 0)))
                ids, bounds = tool.encoder.encode(strings(chosen.column(text)))
                yield _result(chosen, columns, ids, bounds, tool)

    return encode


def _together(path: str, text: str, columns: list[str]):
    """Documents that hold shared chunks, with the ids of these."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = assembler(path)
        for batch in batches:
            for row in B.rows_of(batch):
                rows = B.open_block(row["data"])
                known: dict[bytes, np.ndarray] = {}
                for part in row["answer"]:
                    known.update(_unpack(part))
                chunks = Chunks(strings(rows.column(text)))
                parts = tool.encode(chunks, list(range(rows.num_rows)), known)
                bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                yield _result(rows, columns, np.concatenate(parts), bounds, tool)

    return encode


def encode(docs: DataFrame, tokenizer: str | None = None, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``ids`` and the text ``decoded`` from them."""
    path = tokenizer or bpe.tokenizer_path()
    blocks = B.as_blocks(docs, text_column, BLOCK_BYTES)
    buckets = B.bucket_count(docs.select(F.octet_length(text_column).alias("raw")))
    keys = blocks.mapInArrow(_send_keys(text_column, buckets), B.KEYS)
    owners = keys.groupBy("bucket").applyInArrow(_owners, B.BITS)
    states = materialize(B.answers(owners, "states"), "states")
    # The states are a byte per chunk; beyond the limit the blocks are shuffled to them.
    told = blocks.join(broadcast_if_small(states), "block", "left").select("block", "data", "states")
    sent = materialize(told.mapInArrow(_own_chunks(path, text_column, buckets), _ROWS), "chunks")
    given = sent.where(F.col("kind") < WAITING).groupBy("bucket").applyInArrow(_answer, _ANSWER)
    answers = given.groupBy("block").agg(F.collect_list(F.struct("keys", "sizes", "data")).alias("answer"))
    waiting = sent.where(F.col("kind") == WAITING).select("block", "data").join(answers, "block")

    columns = [c for c in docs.columns if c not in ("ids", "decoded")] + ["ids", "decoded"]
    new = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    schema = T.StructType([docs.schema[c] for c in columns[:-2]] + new)
    held = sent.where(F.col("kind") == HELD).select("block", F.col("keys").alias("held"))
    known = blocks.join(broadcast_if_small(held), "block").select("data", "held")
    alone = known.mapInArrow(_alone(path, text_column, columns), schema)
    return alone.unionByName(waiting.mapInArrow(_together(path, text_column, columns), schema))


def digest(encoded: DataFrame) -> DataFrame:
    """doc_id, the number of ids, and the SHA-256 of ids and decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
