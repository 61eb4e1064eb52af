"""Benchmark decontamination: which short test items stand inside which long documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

_WORD = re.compile(r"\w+")
_PAIRS = "doc_id long, item_id long, shared long, item_shingles long"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    """Pseudo-random order of shingle codes: the hash whose minima make the sketches."""
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Block:
    """Some items, as sketches to search with and whole shingle sets to verify by.

    Shingles are coded exactly: the first two words by their place among the items' word pairs,
    then that code and the next word by their place, and so on. A document shingle that no item
    has gets no code.

    Items are partitioned by size. Of the ``n`` shingles of an item a document with containment
    ``t`` or more lacks ``(1 - t) * n`` at most, so the sketch of a partition has one minimum
    more than its largest item may lack: a document that contains the item shows at least one
    of them. A document with fewer shingles than ``t`` times the smallest item of a partition is
    not searched for it.
    """

    def __init__(self, items: list[tuple[int, list[str]]], width: int, threshold: float):
        self.width, self.threshold = width, threshold
        self.words = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.ids = [item for item, _ in items]
        self.levels: list[np.ndarray] = []
        flat = self._flat([ws for _, ws in items])
        codes, owner = self._codes(*flat, learn=True)
        self.sets = [np.unique(codes[owner == k]) for k in range(len(items))]
        sizes = np.array([len(s) for s in self.sets], np.int64)
        rows = []
        self.partition = np.frexp(np.maximum(sizes, 1))[1]
        self.least = {}
        for part in np.unique(self.partition[sizes > 0]):
            members = np.flatnonzero((self.partition == part) & (sizes > 0))
            minima = int(np.floor((1 - threshold) * sizes[members].max() + 1e-9)) + 1
            self.least[int(part)] = threshold * sizes[members].min()
            for k in members:
                own = self.sets[k]
                own = own[np.argsort(_mixed(own), kind="stable")[:minima]]
                rows.append(np.stack([own, np.full(len(own), k)]))
        both = np.concatenate(rows, axis=1) if rows else np.zeros((2, 0), np.int64)
        both = both[:, np.lexsort(both[::-1])]
        self.minima, self.owners = both[0], both[1]

    def _flat(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of all texts, -1 for other words and between texts, and each place's text."""
        parts, owner = [], []
        find = self.words.get
        for k, words in enumerate(texts):
            parts.append(np.fromiter((find(w, -1) for w in words), np.int64, len(words)))
            parts.append(np.array([-1], np.int64))
            owner.append(np.full(len(words) + 1, k))
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(parts), np.concatenate(owner)

    def _codes(self, ids: np.ndarray, owner: np.ndarray, learn: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the shingles that items have, and their texts."""
        count = len(self.words) + 1
        at = np.flatnonzero(ids[: len(ids) - self.width + 1] >= 0) if len(ids) >= self.width else np.zeros(0, np.int64)
        code = ids[at]
        for level in range(1, self.width):
            step = ids[at + level]
            at, code, step = at[step >= 0], code[step >= 0], step[step >= 0]
            pair = code * count + step
            if learn:
                self.levels.append(np.unique(pair))
            known = self.levels[level - 1]
            place = np.searchsorted(known, pair)
            there = place < len(known)
            there[there] = known[place[there]] == pair[there]
            at, code = at[there], place[there]
        return code, owner[at]

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        """(row, item id, shingles shared, shingles of the item) at the threshold or above."""
        words = [words_of(t) for t in texts]
        codes, owner = self._codes(*self._flat(words))
        first = np.searchsorted(self.minima, codes, "left")
        hits = np.searchsorted(self.minima, codes, "right") - first
        row = np.repeat(owner, hits)
        item = self.owners[np.repeat(first, hits) + np.arange(len(row)) - np.repeat(np.cumsum(hits) - hits, hits)]
        for r, k in np.unique(np.stack([row, item]), axis=1).T if len(row) else ():
            if len(words[r]) - self.width + 1 < self.least[int(self.partition[k])]:
                continue
            begin, end = np.searchsorted(owner, r, "left"), np.searchsorted(owner, r, "right")
            shared = int(np.isin(self.sets[k], codes[begin:end]).sum())
            if shared >= self.threshold * len(self.sets[k]) - 1e-9:
                yield int(r), self.ids[k], shared, len(self.sets[k])


def blocks_of(
    items: DataFrame, item_id: str, text: str, width: int, threshold: float, block_words: int
) -> Iterator[Block]:
    """Items in blocks of about ``block_words`` words, so that what travels to the tasks is
    bounded whatever the size of the benchmark: a larger one takes more passes."""
    rows = items.select(F.col(item_id).cast("long"), F.col(text).cast("string")).where(F.col(item_id).isNotNull())
    waiting, size = [], 0
    for item, body in rows.distinct().toLocalIterator():
        words = words_of(body)
        waiting.append((item, words))
        size += len(words)
        if size >= block_words:
            yield Block(waiting, width, threshold)
            waiting, size = [], 0
    if waiting:
        yield Block(waiting, width, threshold)


def find_items(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", width: int = 5, threshold: float = 0.8,
    block_words: int = 500_000,
) -> DataFrame:
    """``doc_id, item_id, shared, item_shingles``: items of which a document has ``threshold``
    or more of the distinct ``width``-word shingles.

    Words are runs of letters, digits and underscores in lower case. Documents are searched in
    one pass for each block of items, without a shuffle; candidates are verified on the whole
    shingle sets. Items of fewer than ``width`` words have no shingle and match nothing, as do
    null or empty texts; items without an id are not searched, equal rows of ``items`` count
    once; every row of ``docs`` is searched alone, with its id as it is, so repeated rows give
    repeated results. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = None
    for block in blocks_of(items, item_id, item_text, width, threshold, block_words):

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", 2_000_000):
                hits = list(block.search(batch.column("text").to_pylist()))
                ids = batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64()))
                rest = [pa.array([h[k] for h in hits], pa.int64()) for k in (1, 2, 3)]
                yield pa.record_batch([ids, *rest], ["doc_id", "item_id", "shared", "item_shingles"])

        part = rows.mapInArrow(run, _PAIRS)
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], _PAIRS)


def remove_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = 5, threshold: float = 0.8, block_words: int = 500_000,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns; see ``find_items``."""
    kept = docs
    for block in blocks_of(items, item_id, item_text, width, threshold, block_words):

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text, 2_000_000):
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in block.search(batch.column(text).to_pylist())]] = False
                yield batch.filter(pa.array(keep))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
