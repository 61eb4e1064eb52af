"""Distinct word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import encoded

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (runs of non-blank bytes, A-Z in lower case) and the words per text."""
    data, offsets = encoded(column)
    texts = len(offsets) - 1
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(texts, np.int64)
    solid = ~_BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    begins[cuts] |= solid[cuts]  # a word doesn't run on into the next text
    starts = np.flatnonzero(begins)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(texts, np.int64)
    lengths = np.diff(starts, append=len(data), prepend=0)
    lengths[0] = starts[0]
    place = np.arange(len(data)) - np.repeat(np.append(0, starts), lengths)
    powers = np.full(int(place.max()) + 1, _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    values = (_LOWER[data].astype(np.uint64) + _U(1)) * powers[place]
    values[~solid] = 0
    hashes = mixed(np.add.reduceat(values, starts))
    return hashes, np.diff(np.searchsorted(starts, offsets)).astype(np.int64)


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text, end to end, and the offsets of the texts in them.

    A text of fewer than ``width`` words has its whole sequence as one shingle; one without
    words has none.
    """
    hashes, counts = words(column)
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    full = np.maximum(counts - width + 1, 0)
    begin = np.repeat(ends - counts, full) + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
    code = np.full(len(begin), _U(width))
    for k in range(width):
        code = mixed(code * _U(0xD6E8FEB86659FD93) + hashes[begin + k])
    texts = np.repeat(np.arange(len(counts)), full)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for i, t in enumerate(short):
            value = np.full(1, _U(counts[t]))
            for h in hashes[ends[t] - counts[t] : ends[t]]:
                value = mixed(value * _U(0xD6E8FEB86659FD93) + h)
            extra[i] = value[0]
        code, texts = np.concatenate([code, extra]), np.concatenate([texts, short])
    order = np.lexsort((code, texts))
    code, texts = code[order], texts[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (texts[1:] != texts[:-1])
    code, texts = code[new], texts[new]
    return code, np.searchsorted(texts, np.arange(len(counts) + 1))
