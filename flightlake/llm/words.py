"""Words, windows of words and their hashes, as numpy over UTF-8 bytes.

A word is a maximal run of bytes other than space and 0x09-0x0D.  All hashes
are polynomial sums modulo 2**64, taken as differences of prefix sums, so each
costs the same for any window length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.default_rng(20240607)
_BYTE = _random.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = [0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1]
# Powers that are remembered: those below this, and those of its multiples.
_TABLE = 1 << 16
_powers: dict[tuple[int, int], np.ndarray] = {}


def _table(base: int, step: int, count: int) -> np.ndarray:
    """base**(i * step) modulo 2**64 for i below ``count``; a negative step gives powers of the inverse."""
    known = _powers.get((base, step))
    if known is None or len(known) < count:
        terms = np.full(max(count, _TABLE if abs(step) == 1 else 64), pow(base, step, 1 << 64), np.uint64)
        terms[0] = 1
        known = _powers[base, step] = np.multiply.accumulate(terms)
    return known[:count]


def powers(base: int, count: int) -> np.ndarray:
    """base**i modulo 2**64 for i below ``count``; a long row of them is made anew each time, not kept."""
    low = _table(base, 1, min(count, _TABLE))
    if count <= _TABLE:
        return low
    high = _table(base, _TABLE, -(-count // _TABLE))
    return np.multiply.outer(high, low).ravel()[:count]


def inverse_powers_at(base: int, places: np.ndarray) -> np.ndarray:
    """The inverse of base**i modulo 2**64 for each i of ``places``."""
    h = _table(base, -1, _TABLE)[places & (_TABLE - 1)]
    above = int(places.max(initial=0)) // _TABLE
    if above:
        h *= _table(base, -_TABLE, above + 1)[places // _TABLE]
    return h


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def spans_hash(values: np.ndarray, begins: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[begin:end]`` for each span."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, powers(base, len(values)), out=prefix[1:])
    np.cumsum(prefix[1:], out=prefix[1:])
    h = prefix[ends] - prefix[begins]
    if len(h):
        h *= inverse_powers_at(base, begins)
    return mix(h + (ends - begins).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def rolling_hash(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of ``values[i:i + width]`` for each i; only its upper bits depend on all of the values' bits."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    h, size = values, 1
    for bit in bin(width)[3:]:
        h = h[:-size] + h[size:] * np.uint64(pow(base, size, 1 << 64))
        size *= 2
        if bit == "1":
            h = values[: len(values) - size] + h[1:] * np.uint64(base)
            size += 1
    return h


@dataclass
class Words:
    """Words of several texts that lie one after the other."""

    begins: np.ndarray  # byte where each word begins
    ends: np.ndarray  # byte after each word
    first: np.ndarray  # index of each text's first word, and the total at the end


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    word = IS_WORD[data]
    n = len(data)
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    if n:
        before[1:] = word[:-1]
        after[:-1] = word[1:]
        inner = offsets[:-1][offsets[:-1] < n]
        before[inner] = False
        edges = offsets[1:][offsets[1:] > 0] - 1
        after[edges] = False
    begins = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return Words(begins, ends, np.searchsorted(begins, offsets))


def word_hashes(data: np.ndarray, words: Words, seed: int = 0) -> np.ndarray:
    return spans_hash(_BYTE[seed][data], words.begins, words.ends, _BASE[seed])


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Index of the first word of each window of ``width`` words inside one text."""
    ok = np.zeros(int(first[-1]), bool)
    counts = np.maximum(np.diff(first) - width + 1, 0)
    return _ranges(first[:-1], counts) if len(ok) else np.zeros(0, np.int64)


def _ranges(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... (count of them) for each pair, in one array."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(begins - (ends - counts), counts)


ranges = _ranges


def window_hashes(hashes: np.ndarray, starts: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``width`` words from each start."""
    return spans_hash(hashes, starts, starts + width, _BASE[seed] ^ 0x5A5A5A5A)


def covered(starts: np.ndarray, width: int, count: int) -> np.ndarray:
    """Which of ``count`` words lie in a window of ``width`` words from one of ``starts``."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0
