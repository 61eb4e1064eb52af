"""Packing by minimum bin slack: documents into token windows of one capacity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import slices
from .tokens import Encoder, default_vocabulary

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def fill_windows(counts: dict[int, int], capacity: int) -> Iterator[tuple[tuple[tuple[int, int], ...], int]]:
    """Windows for a multiset of lengths: ((length, how many), ...), number of such windows.

    Minimum bin slack: the longest length left opens a window; a bitset of reachable sums over
    the lengths left (counts in binary parts) finds the fill closest to the capacity, and
    backtracking through the kept bitsets gives the counts. A fill is used as often as the
    multiset allows.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("a length is outside 1..capacity")
    order = sorted(left, reverse=True)
    first = 0
    while first < len(order):
        longest = order[first]
        if left[longest] == 0:
            first += 1
            continue
        room = capacity - longest
        within, full = (1 << (room + 1)) - 1, 1 << room
        sums, steps = 1, []
        for n in order[first:]:
            if n > room:
                continue
            spare = min(left[n] - (n == longest), room // n)
            part = 1
            while spare > 0 and not sums & full:
                take = min(part, spare)
                steps.append((sums, n, take))
                sums |= (sums << (n * take)) & within
                spare -= take
                part *= 2
            if sums & full:
                break
        at = sums.bit_length() - 1
        used = {longest: 1}
        for before, n, take in reversed(steps):
            if not before >> at & 1:
                used[n] = used.get(n, 0) + take
                at -= n * take
        times = min(left[n] // c for n, c in used.items())
        for n, c in used.items():
            left[n] -= c * times
        yield tuple(used.items()), times


class _Windows:
    """Pieces of one task: whole windows at once, shorter pieces when a block is full."""

    def __init__(self, capacity: int, block_tokens: int, first_id: int):
        self.capacity, self.block_tokens, self.next_id = capacity, block_tokens, first_id
        self.rows: list[tuple] = []
        self.waiting: dict[int, list[tuple]] = {}
        self.tokens = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        raw, total, size = ids.tobytes(), len(ids), self.capacity
        for start in range(0, total - size + 1, size):
            piece = raw[4 * start : 4 * (start + size)]
            self.rows.append((doc_id, start, size, piece, total, self.next_id, 0))
            self.next_id += 1
        if rest := total % size:
            piece = (doc_id, total - rest, rest, raw[4 * (total - rest) :], total)
            self.waiting.setdefault(rest, []).append(piece)
            self.tokens += rest
            if self.tokens >= self.block_tokens:
                self.close()

    def close(self) -> None:
        counts = {n: len(pieces) for n, pieces in self.waiting.items()}
        for used, times in fill_windows(counts, self.capacity):
            for _ in range(times):
                offset = 0
                for n, count in used:
                    for _ in range(count):
                        self.rows.append((*self.waiting[n].pop(), self.next_id, offset))
                        offset += n
                self.next_id += 1
        self.waiting, self.tokens = {}, 0

    def drain(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * 7
        self.rows = []
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024,
    end_id: int = 0, vocabulary: str | None = None, block_tokens: int = 8_000_000,
) -> DataFrame:
    """Cut every document's ids into pieces and place the pieces in windows of ``capacity`` ids.

    A document is its token ids and ``end_id``; a null or empty text is ``end_id`` alone. Whole
    windows are filled by one document; what is left of it waits in a block of about
    ``block_tokens`` ids, which minimum bin slack packs. Blocks belong to a task, so nothing is
    shuffled, memory is bounded by the block, and only the last windows of a block have padding.
    Window numbers start at the partition number times 2**33, so a task that is run again gives
    the same rows. Equal rows and equal ids are documents of their own; a null id stays null;
    an empty table gives no rows; other columns are ignored.

    Returns ``doc_id, start, length, ids`` (little-endian unsigned 32-bit), ``doc_tokens,
    sequence_id, offset``.
    """
    path = vocabulary or default_vocabulary()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        windows = _Windows(capacity, block_tokens, TaskContext.get().partitionId() << 33)
        for batch in slices(batches, "text", 4_000_000):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts, end_id)):
                windows.add(doc, ids)
            if windows.rows:
                yield windows.drain()
        windows.close()
        yield windows.drain()

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(place, PIECES)
