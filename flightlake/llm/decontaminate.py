"""Benchmark text in training documents, found by a generalised suffix automaton.

Texts are lower-cased (A-Z only); words are runs of digits, letters a-z and
characters beyond ASCII.  A window is ``width`` consecutive words of an item, or a
shorter item as a whole; a document word inside any occurrence of a window is hit.

The automaton of the items has a state per class of word sequences that end at the
same places.  A document's words are streamed through it; at each word it knows the
longest sequence of some item that ends there, and following its suffix links, the
window that ends there and with it the items.  A word that no item has sends it back
to the start, so only runs of item words at least as long as the shortest window are
streamed at all.

Items are cut into pieces of at most ``PIECE_WORDS`` words that overlap by
``width - 1`` (no window is lost), and pieces dealt to automata of at most
``AUTOMATON_BYTES`` plus a piece of text.  An automaton is sent to all tasks, and
every document is streamed through every one of them: with the usual benchmarks
there is one, otherwise each is a pass whose findings are written with the
documents.  So nothing that is broadcast or collected grows with either table, and
texts are never shuffled.  A single window longer than the bound is kept whole.

Null text has no words; an empty or null item has no window; rows with equal item
ids count as one item, and a null id is an item named by the empty text.  Repeated
documents are judged one by one; an empty table gives an empty result.  Other
columns are kept; a column with the name of a result column is replaced.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm import words as W
from flightlake.llm.arrow import slices, utf8_view
from flightlake.operators.numbering import number_rows
from flightlake.session import materialize

WIDTH = 10
AUTOMATON_BYTES = 1 << 20
PIECE_WORDS = 4096
# Spans of at least so many words are cut out of a text; where more than this
# share of the words is hit, nothing of the text is left.
SPAN_WORDS = 10
COVERAGE = 0.5

RESULT = ["n_words", "longest", "items", "spans"]
_SPAN = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
_KINDS = {
    "n_words": T.LongType(),
    "longest": T.LongType(),
    "items": T.ArrayType(T.StringType()),
    "spans": T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("words", T.LongType())])),
}

# Bytes of words (A-Z in lower case), and a space for all others.
_NORMAL = np.full(256, 32, np.uint8)
for _a, _b, _up in ((0x30, 0x39, 0), (0x61, 0x7A, 0), (0x80, 0xFF, 0), (0x41, 0x5A, 32)):
    _NORMAL[_a : _b + 1] = np.arange(_a, _b + 1) + _up


class Automaton:
    """Generalised suffix automaton over sequences of word numbers."""

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]

    def _state(self, size: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _exact(self, origin: int, word: int) -> int:
        """The state whose longest sequence is that of ``origin`` and ``word``;
        split off from the present target where that holds longer ones too."""
        target = self.step[origin][word]
        size = self.size[origin] + 1
        if self.size[target] == size:
            return target
        part = self._state(size, dict(self.step[target]), self.link[target])
        self.link[target] = part
        while origin >= 0 and self.step[origin].get(word) == target:
            self.step[origin][word] = part
            origin = self.link[origin]
        return part

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            if word in self.step[last]:  # an earlier item holds this beginning
                last = self._exact(last, word)
                continue
            new = self._state(self.size[last] + 1, {}, 0)
            origin = last
            while origin >= 0 and word not in self.step[origin]:
                self.step[origin][word] = new
                origin = self.link[origin]
            if origin >= 0:
                self.link[new] = self._exact(origin, word)
            last = new

    def stream(self, sequence: list[int]) -> tuple[list[int], list[int]]:
        """Per word the state and length of the longest known sequence that ends there."""
        states, sizes = [], []
        state = size = 0
        step, link, longest = self.step, self.link, self.size
        for word in sequence:
            after = step[state].get(word)
            while after is None and state:
                state = link[state]
                size = longest[state]
                after = step[state].get(word)
            if after is None:
                size = 0
            else:
                state, size = after, size + 1
            states.append(state)
            sizes.append(size)
        return states, sizes


class Items:
    """The automaton of some items' pieces, and which windows end in its states."""

    def __init__(self, pieces: tuple[tuple[str, str], ...], width: int):
        self.width = width
        self.names = sorted({item for item, _ in pieces})
        number = {name: i for i, name in enumerate(self.names)}
        self.words: dict[bytes, int] = {}
        sequences = []
        for item, text in pieces:
            sequences.append((number[item], [self.words.setdefault(w, len(self.words)) for w in text.encode().split(b" ")]))
        self.automaton = auto = Automaton()
        for _, sequence in sequences:
            auto.add(sequence)
        self.shortest = min((min(len(s), width) for _, s in sequences), default=width)
        self._climb()
        self.full: dict[int, set[int]] = {}  # state of a window of ``width`` words: its items
        self.short: dict[int, list[tuple[int, int]]] = {}  # state: (words, item) of items that end there
        for item, sequence in sequences:
            states, _ = auto.stream(sequence)
            if len(sequence) < width:
                state = states[-1]
                while auto.size[auto.link[state]] >= len(sequence):
                    state = auto.link[state]
                self.short.setdefault(state, []).append((len(sequence), item))
            for state in states[width - 1 :]:
                self.full.setdefault(self.window[state], set()).add(item)
        self.above = [-1] * len(auto.size)  # nearest state up the links that ends a short item
        if self.short:
            for state in self.order[1:]:
                up = auto.link[state]
                self.above[state] = up if up in self.short else self.above[up]
        table = np.frombuffer(b" ".join(self.words), np.uint8) if self.words else np.zeros(0, np.uint8)
        found = W.find_words(table, np.array([0, len(table)]))
        self.hashes = np.unique(W.word_hashes(table, found)) if self.words else np.zeros(0, np.uint64)

    def _climb(self) -> None:
        """The state of the last ``width`` words, for each state that is that long."""
        auto = self.automaton
        self.order = np.argsort(auto.size, kind="stable").tolist()
        self.window = [-1] * len(auto.size)
        for state in self.order[1:]:
            if auto.size[state] >= self.width:
                up = auto.link[state]
                self.window[state] = self.window[up] if auto.size[up] >= self.width else state

    def find(self, sequence: list[int], begins: list[int], ends: list[int], items: set[int], base: int) -> int:
        """Add hit word ranges and items of a run of words; returns the longest match."""
        states, sizes = self.automaton.stream(sequence)
        for place, (state, size) in enumerate(zip(states, sizes)):
            if size >= self.width:
                items |= self.full[self.window[state]]
                begins.append(base + place + 1 - self.width)
                ends.append(base + place + 1)
            if self.short:
                for words, item in self.short.get(state, ()):
                    if words <= size:
                        items.add(item)
                        begins.append(base + place + 1 - words)
                        ends.append(base + place + 1)
                up = self.above[state]
                while up >= 0:
                    for words, item in self.short[up]:
                        items.add(item)
                        begins.append(base + place + 1 - words)
                        ends.append(base + place + 1)
                    up = self.above[up]
        return max(sizes)


@functools.lru_cache(maxsize=1)
def _items(pieces: tuple[tuple[str, str], ...], width: int) -> Items:
    """One automaton per Python worker, kept from task to task."""
    return Items(pieces, width)


def _words(texts: pa.Array) -> tuple[np.ndarray, W.Words]:
    data, offsets = utf8_view(texts)
    normal = _NORMAL[data]
    return normal, W.find_words(normal, offsets)


def _spans(hit: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return [{"first": int(a), "words": int(b - a)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


def _finder(pieces: tuple[tuple[str, str], ...], width: int, column: str, names: list[str], again: bool):
    """Adds what one automaton finds to the rows, and to what earlier ones found."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _items(pieces, width)
        for batch in slices(batches, column):
            data, words = _words(batch.column(column))
            count = len(words.begins)
            first = words.first
            is_known = np.isin(W.word_hashes(data, words), known.hashes) if count else np.zeros(0, bool)
            # runs of known words, cut where a text ends
            edge = np.zeros(count + 1, bool)
            edge[first] = True
            change = np.flatnonzero(edge[:-1] | np.diff(is_known, prepend=False)) if count else np.zeros(0, np.int64)
            stop = np.append(change[1:], count)
            good = is_known[change] & (stop - change >= known.shortest) if count else np.zeros(0, bool)
            change, stop = change[good], stop[good]
            row_of = np.searchsorted(first, change, "right") - 1
            raw = data.tobytes() if len(change) else b""
            begins: list[int] = []
            ends: list[int] = []
            items: dict[int, set[int]] = {}
            longest = np.zeros(batch.num_rows, np.int64)
            for a, b, row in zip(change.tolist(), stop.tolist(), row_of.tolist()):
                sequence = [known.words.get(raw[x:y], -1) for x, y in zip(words.begins[a:b].tolist(), words.ends[a:b].tolist())]
                found: set[int] = set()
                longest[row] = max(longest[row], known.find(sequence, begins, ends, found, a))
                if found:
                    items.setdefault(row, set()).update(found)
            depth = np.zeros(count + 1, np.int64)
            np.add.at(depth, np.array(begins, np.int64), 1)
            np.add.at(depth, np.array(ends, np.int64), -1)
            hit = np.cumsum(depth[:-1]) > 0
            named = [{known.names[i] for i in items.get(row, ())} for row in range(batch.num_rows)]
            if again:
                for row, (names_before, spans) in enumerate(zip(batch.column("items").to_pylist(), batch.column("spans").to_pylist())):
                    named[row].update(names_before)
                    for span in spans:
                        hit[first[row] + span["first"] : first[row] + span["first"] + span["words"]] = True
                longest = np.maximum(longest, batch.column("longest").to_numpy(zero_copy_only=False))
            total = np.concatenate([[0], np.cumsum(hit)])[first]
            spans = [_spans(hit[a:b]) if y > x else [] for a, b, x, y in zip(first[:-1], first[1:], total[:-1], total[1:])]
            made = {
                "n_words": pa.array(np.diff(first), pa.int64()),
                "longest": pa.array(longest, pa.int64()),
                "items": pa.array([sorted(n) for n in named], pa.list_(pa.string())),
                "spans": pa.array(spans, _SPAN),
            }
            yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(n) for n in names], names=names)

    return find


def _piecer(width: int, most: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, words = _words(batch.column("text"))
            raw = data.tobytes()
            for row, item in enumerate(batch.column("item").to_pylist()):
                a, b = int(words.first[row]), int(words.first[row + 1])
                starts = range(a, max(a + 1, b - width + 1), max(1, most - width + 1)) if b > a else ()
                texts = [b" ".join(raw[words.begins[i] : words.ends[i]] for i in range(s, min(b, s + most))).decode() for s in starts]
                if texts:
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(texts), pa.string()), pa.array(texts, pa.string())], names=["item", "piece"])

    return cut


def _automata(items: DataFrame, id_column: str, text_column: str, width: int) -> Iterator[tuple[tuple[str, str], ...]]:
    """Pieces of all items in parts of a bounded size; one empty part if there are none."""
    texts = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"), F.col(text_column).alias("text"))
    pieces = materialize(texts.mapInArrow(_piecer(width, max(PIECE_WORDS, width)), "item string, piece string").distinct(), "pieces")
    total = pieces.agg(F.coalesce(F.sum(F.octet_length("item") + F.octet_length("piece") + 2), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / AUTOMATON_BYTES))
    if parts > 1:
        # dealt in the order of their sizes, so parts differ by one piece at most
        dealt = number_rows(pieces.withColumn("bytes", F.octet_length("piece")), ["bytes", "item", "piece"], unique=True)
        pieces = materialize(dealt.withColumn("part", (F.col("row_no") - 1) % parts), "pieces")
    for part in range(parts):
        chosen = pieces.where(F.col("part") == part) if parts > 1 else pieces
        yield tuple(sorted((r["item"], r["piece"]) for r in chosen.select("item", "piece").collect()))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    text_column: str = "text",
    id_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with their number of words, the longest sequence of words
    that an item has too, the items with occurring windows and the hit words as spans."""
    kept = [f for f in docs.schema.fields if f.name.lower() not in RESULT]
    schema = T.StructType([*kept, *[T.StructField(n, _KINDS[n]) for n in RESULT]])
    names = schema.fieldNames()
    found = docs.select(*[F.col(f"`{f.name}`") for f in kept])
    for number, pieces in enumerate(_automata(items, id_column, item_text, width)):
        if number:
            found = materialize(found, "searched")
        found = found.mapInArrow(_finder(pieces, width, text_column, names, number > 0), schema)
    return found


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["words"])


def _cutter(column: str, names: list[str], least: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            _, offsets = utf8_view(batch.column(column))
            _, words = _words(batch.column(column))
            texts = batch.column(column).to_pylist()
            for row, spans in enumerate(batch.column("spans").to_pylist()):
                gone = [s for s in spans if s["words"] >= least]
                if gone:
                    raw, base, at, left = texts[row].encode(), int(offsets[row]), 0, []
                    for span in gone:
                        a = int(words.first[row]) + span["first"]
                        left.append(raw[at : words.begins[a] - base])
                        at = words.ends[a + span["words"] - 1] - base
                    texts[row] = b"".join([*left, raw[at:]]).decode()
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == column else batch.column(n) for n in names], names=names)

    return cut


def remove_items(
    docs: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    span_words: int = SPAN_WORDS,
    coverage: float = COVERAGE,
    text_column: str = "text",
    id_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Like :func:`find_items`, but the text has lost its hit spans of at least
    ``span_words`` words, and all of it (empty text) where more than the share
    ``coverage`` of its words is hit.  Other texts stay as they are."""
    found = find_items(docs, items, width, text_column, id_column, item_text)
    cut = found.mapInArrow(_cutter(text_column, found.columns, span_words), found.schema)
    covered = hit_words(F.col("spans")) > coverage * F.col("n_words")
    return cut.withColumn(text_column, F.when(covered, "").otherwise(F.col(text_column)))


def digest(found: DataFrame) -> DataFrame:
    """Per document the counts of words, hit words and items, and the items' digest."""
    n_hit = hit_words(F.col("spans"))
    items = F.sort_array("items")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
