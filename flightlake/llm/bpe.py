"""Byte-level BPE over many texts at once.

The tokenizer first cuts a text into pieces (words with their space, runs of
digits, ...) and then merges bytes inside each piece, so a piece's ids depend
on nothing else.  The cuts of a whole slice of texts are found with numpy over
code points, and the tokenizers library encodes each distinct piece once per
worker.  Texts that hold the special token, or a code point that this Python's
Unicode tables do not know, go to the library as they are.
"""

from __future__ import annotations

import os
import sys
import unicodedata

import numpy as np

from flightlake.llm.words import spans_hash

TOKENIZER = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"
# Distinct pieces that a worker remembers; beyond it those go that were not met again.
KEPT_PIECES = 500_000
# Pieces given to the library at once; its results are much larger than their ids.
LIBRARY_PIECES = 4096
# Pieces that share one result of the library, as the words of one text.
TOGETHER = 512

BLANK, SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(6)
# Endings that are a piece of their own after an apostrophe (fixed values).
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")

_BASE = 0xA24BAED4963EE407 | 1


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def code_point_classes() -> np.ndarray:
    """Class of every code point, as the pre-tokenizer's pattern tells them apart."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))
        if kind[0] == "L":
            table[code] = LETTER
        elif kind[0] == "N":
            table[code] = NUMBER
        elif kind == "Cn":
            table[code] = UNKNOWN
    # White space of the Unicode standard (fixed values).
    table[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = BLANK
    table[0x2000:0x200B] = BLANK
    table[32] = SPACE
    return table


def piece_starts(codes: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts that lie one after the other."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    blank = kinds <= SPACE
    head = np.zeros(n + 1, bool)  # first code point of a text, or the end of all
    head[offsets] = True
    before = np.empty(n, np.uint8)
    before[0], before[1:] = OTHER, kinds[:-1]
    # White space: a run begins a piece, and so does its last one if a text goes on.
    last = np.zeros(n, bool)
    last[:-1] = ~blank[1:] & ~head[1:-1]
    start = np.where(blank, (before > SPACE) | last, ((before > SPACE) & (before != kinds)) | (before == BLANK))
    start |= head[:-1]
    # Apostrophes that begin a piece and an ending.
    marks = np.flatnonzero(start & (codes == 39))
    if len(marks):
        text_end = offsets[np.searchsorted(offsets, marks, "right")]
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        one, two = padded[marks + 1], padded[marks + 2]
        size = np.where(np.isin(one, [ord(c) for c in ONE_LETTER]) & (marks + 1 < text_end), 2, 0)
        for pair in TWO_LETTERS:
            size[(one == ord(pair[0])) & (two == ord(pair[1])) & (marks + 2 < text_end)] = 3
        marks, size, text_end = marks[size > 0], size[size > 0], text_end[size > 0]
        start[marks + 1] = False
        after = marks + size
        inside = after < text_end
        after = after[inside]
        start[after[kinds[after] == LETTER]] = True
    return np.flatnonzero(start)


class PieceEncoder:
    """Encodes slices of texts; keeps the ids of pieces it has met."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.kinds = code_point_classes()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes per id
        self.sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.calls = 0  # texts and pieces given to the library
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)  # met in a later slice than the first
        self.ids = np.zeros(0, np.uint32)

    def _make_room(self, wanted: int) -> None:
        """Forget pieces that no later slice held, or all if the others leave no room."""
        kept = np.flatnonzero(self.again)
        if len(kept) > KEPT_PIECES // 2 or len(kept) + wanted > KEPT_PIECES:
            return self._forget()
        count = self.count[kept]
        begin = np.cumsum(count) - count
        self.ids = self.ids[np.arange(count.sum()) + np.repeat(self.begin[kept] - begin, count)]
        self.keys, self.begin, self.count = self.keys[kept], begin, count
        self.again = np.zeros(len(kept), bool)

    def _library(self, texts: list[str]) -> list[list[int]]:
        self.calls += len(texts)
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of pieces in one array, how many each has); the library takes each piece as a word of its own."""
        groups = [pieces[a : a + TOGETHER] for a in range(0, len(pieces), TOGETHER)]
        parts, counts = [], []
        for group, got in zip(groups, self.tokenizer.encode_batch_fast(groups, is_pretokenized=True, add_special_tokens=False)):
            ids = np.array(got.ids, np.uint32)
            byte = np.cumsum(self.sizes[ids])
            end = np.cumsum([len(p.encode()) for p in group])
            if len(ids) and byte[-1] == end[-1]:
                self.calls += len(group)
                last = np.searchsorted(byte, end) + 1
                parts.append(ids)
                counts.append(np.diff(last, prepend=0))
            else:  # a vocabulary that lacks bytes
                each = self._library(group)
                parts.append(np.array([i for e in each for i in e], np.uint32))
                counts.append(np.array([len(e) for e in each]))
        return np.concatenate(parts), np.concatenate(counts)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        parts, counts = zip(*(self._pieces(pieces[a : a + LIBRARY_PIECES]) for a in range(0, len(pieces), LIBRARY_PIECES)))
        count = np.concatenate(counts)
        begin = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, *parts])
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.again = np.concatenate([self.again, np.zeros(len(count), bool)])[order]

    def _known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where distinct keys are or would be, which are not there)."""
        at = np.searchsorted(self.keys, keys)
        new = at == len(self.keys)
        new[~new] = self.keys[at[~new]] != keys[~new]
        return at, new

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, where each text's ids begin and the total)."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=offsets[1:])
        kinds = self.kinds[codes]
        whole = set(np.unique(np.searchsorted(offsets, np.flatnonzero(kinds == UNKNOWN), "right") - 1).tolist())
        if SPECIAL in joined:
            whole.update(i for i, t in enumerate(texts) if SPECIAL in t)
        if whole:
            kept = ["" if i in whole else t for i, t in enumerate(texts)]
            ids, bounds = self.encode(kept)
            chosen = sorted(whole)
            other = dict(zip(chosen, self._library([texts[i] for i in chosen])))
            parts = [
                np.asarray(other[i], np.uint32) if i in whole else ids[bounds[i] : bounds[i + 1]]
                for i in range(len(texts))
            ]
            bounds = np.zeros(len(texts) + 1, np.int64)
            np.cumsum([len(p) for p in parts], out=bounds[1:])
            return np.concatenate(parts), bounds
        starts = piece_starts(codes, kinds, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        ends = np.append(starts[1:], len(codes))
        values = codes.astype(np.uint64) + np.uint64(0x51ED)
        values *= np.uint64(0xBF58476D1CE4E5B9)
        values ^= values >> np.uint64(31)
        hashes = spans_hash(values, starts, ends, _BASE)
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        at, new = self._known(keys)
        if new.any() and len(self.keys) + int(new.sum()) > KEPT_PIECES:
            self._make_room(len(keys))
            at, new = self._known(keys)
        self.again[at[~new]] = True
        if new.any():
            pick = where[new]
            self._learn(keys[new], [joined[a:b] for a, b in zip(starts[pick].tolist(), ends[pick].tolist())])
            at = np.searchsorted(self.keys, keys)
        at = at[back]
        count = self.count[at]
        total = np.cumsum(count)
        ids = self.ids[np.arange(total[-1]) + np.repeat(self.begin[at] - (total - count), count)]
        first_piece = np.searchsorted(starts, offsets)
        return ids, np.concatenate([[0], total])[first_piece]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
