"""Words of many texts at once, as an Arrow array of their exact bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .common import encoded

BLANKS = b"\x09\x0a\x0b\x0c\x0d\x20"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


@dataclass
class Words:
    """The words of a column end to end: their bytes, offsets and places in the data."""

    data: np.ndarray  # bytes of the texts
    offsets: np.ndarray  # n + 1 text offsets
    solid: np.ndarray  # bytes that belong to words
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # the byte after each word
    counts: np.ndarray  # words of each text

    def strings(self) -> pa.Array:
        lengths = np.append(0, np.cumsum(self.ends - self.starts))
        packed = np.ascontiguousarray(self.data[self.solid])
        return pa.LargeStringArray.from_buffers(len(self.starts), pa.py_buffer(lengths), pa.py_buffer(packed))

    def ids(self) -> np.ndarray:
        """A number for each word, the same for equal words of this column only."""
        return self.strings().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def joined(self) -> pa.Array:
        """Each text's words joined by one blank."""
        keep = self.solid.copy()
        last = np.zeros(len(self.starts), bool)
        last[np.cumsum(self.counts)[self.counts > 0] - 1] = True
        gaps = self.ends[~last]
        keep[gaps] = True
        data = self.data.copy()
        data[gaps] = 32
        sizes = np.append(0, np.cumsum(keep))[self.offsets]
        return pa.LargeStringArray.from_buffers(
            len(self.counts), pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[keep]))
        )


def split(column: pa.Array, apart: bytes = BLANKS, lower: bool = False) -> Words:
    """Words are the longest runs of bytes outside ``apart`` (ASCII); ``lower`` turns A-Z down."""
    data, offsets = encoded(column)
    solid = ~byte_table(apart)[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]  # a word doesn't run on into the next text
    begins[cuts] |= solid[cuts]
    ends[cuts - 1] |= solid[cuts - 1]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, offsets)).astype(np.int64)
    return Words(_LOWER[data] if lower else data, offsets, solid, starts, np.flatnonzero(ends) + 1, counts)
