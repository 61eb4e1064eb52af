"""Repeated substrings by distributed prefix doubling over sampled text positions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, encoded, release, settle, settle_for_now, slices
from .shingles import mixed

#: Bytes of the first rank; ranks of twice and more follow from pairs of it.
FIRST = 32
#: Positions that are handled at a time, so that the arrays stay in the processor's cache.
BLOCK = 1 << 17
_U = np.uint64


def _ranks(data: np.ndarray) -> np.ndarray:
    """A 64-bit rank of the ``FIRST`` bytes at each position, by doubling from one byte."""
    rank = (data.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15)
    size = 1
    while size < FIRST:
        rank = _pair(rank[:-size], rank[size:])
        size *= 2
    return rank


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The rank of two neighbouring pieces from their ranks."""
    both = first * _U(0xD6E8FEB86659FD93) + (second ^ (second >> _U(29)))
    return (both ^ (both >> _U(32))) * _U(0xFF51AFD7ED558CCD)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def _sample(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Sampled positions of the texts that lie end to end in ``data``.

    Each window of ``length`` bytes inside one text picks the place of its least first rank, the
    first of equal ones; so equal windows pick the same place in them. Windows in a row with one
    pick are a sample: text, first window, number of windows, rank of the picked ``FIRST``
    bytes, and rank of all bytes that these windows cover.
    """
    parts = []
    width = length - FIRST + 1
    far = length - 2 * FIRST  # the offset at which a second pair ends with the window
    for start in range(0, len(data) - length + 1, BLOCK):
        piece = data[start : start + BLOCK + length - 1]
        if len(piece) < length:
            break
        rank = _ranks(piece)
        at = np.arange(len(rank), dtype=np.uint64)
        pick = (_least((rank >> _U(20) << _U(20)) | at, width) & _U((1 << 20) - 1)).astype(np.int64)
        window = np.arange(len(pick))
        text = np.searchsorted(offsets, window + start, "right") - 1
        whole = window + start + length <= offsets[text + 1]
        window, pick, text = window[whole], pick[whole], text[whole]
        if len(window) == 0:
            continue
        new = np.ones(len(window), bool)
        new[1:] = (pick[1:] != pick[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(window)) - 1
        low, high = window[begin], window[last]
        double = _pair(rank[:-FIRST], rank[FIRST:])
        cover = _pair(_pair(double[low], double[low + far]), _pair(double[high], double[high + far]))
        cover = _pair(cover, (high - low).astype(np.uint64) * _U(0x632BE59BD9B4E019))
        parts.append((text[begin], low + start - offsets[text[begin]], high - low + 1, rank[pick[begin]], cover))
    if not parts:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def sampled(rows: DataFrame, length: int) -> DataFrame:
    """Samples of all texts. ``repeat`` marks those whose bytes a sample of the same text has
    shown before: they need no search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            data, offsets = encoded(batch.column("text"))
            text, low, count, rank, cover = _sample(data, offsets, length)
            order = np.lexsort((low, cover, rank, text))
            repeat = np.zeros(len(order), bool)
            if len(order):
                a, b = order[1:], order[:-1]
                repeat[a] = (text[a] == text[b]) & (rank[a] == rank[b]) & (cover[a] == cover[b])
            ids = batch.column("doc_id").take(pa.array(text))
            yield pa.record_batch(
                [_signed(rank), _signed(cover), ids, pa.array(low), pa.array(count, pa.int32()), pa.array(repeat)],
                ["rank", "next", "doc_id", "low", "count", "repeat"],
            )

    return rows.mapInArrow(run, "rank long, next long, doc_id long, low long, count int, repeat boolean")


def reranked(pairs: DataFrame) -> DataFrame:
    """Sort (rank, rank at the grown offset, position) and tell apart what has come before.

    Partitions are ranges of the whole sort key, so equal pairs, however many, are spread over
    partitions. Returned are the rows that aren't alone: ``state`` 0 for a pair that stands
    earlier too, 1 for the first of its pair among others of its rank, 2 for the first row of a
    partition, whose predecessor is in another one, and 3, once more, for its last row.
    """
    keys = ["rank", "next", "doc_id", "low"]
    ordered = pairs.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last row
        waiting = None  # the first row of the open rank, until another pair of it comes
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = np.stack([batch.column(k).to_numpy() for k in [*keys, "count"]])
            if before is not None:
                rows = np.concatenate([before, rows], axis=1)
            same_rank = rows[0, 1:] == rows[0, :-1]
            same_pair = same_rank & (rows[1, 1:] == rows[1, :-1])
            twin = same_pair & (rows[2, 1:] == rows[2, :-1]) & (rows[3, 1:] == rows[3, :-1])
            state = np.full(rows.shape[1], -1)
            if before is None:
                state[0] = 2
            now = state[1:]
            now[same_pair & ~twin] = 0
            now[same_rank & ~same_pair] = 1
            group = np.concatenate([[0], np.cumsum(~same_rank)])
            mixed_groups = np.unique(group[1:][same_rank & ~same_pair])
            opens = np.concatenate([[-1], np.flatnonzero(~same_rank) + 1]).astype(np.int64)
            extra = [waiting] if waiting is not None and len(mixed_groups) and mixed_groups[0] == 0 else []
            opener = opens[mixed_groups[mixed_groups > 0]]
            state[opener] = 1
            if group[-1]:
                at = opens[group[-1]]
                waiting = None if state[at] == 1 else rows[:, at : at + 1]
            elif len(mixed_groups) or before is None:
                waiting = None
            chosen = state >= 0
            out, states = rows[:, chosen], state[chosen]
            if extra:
                out, states = np.concatenate([*extra, out], axis=1), np.concatenate([np.ones(len(extra), int), states])
            before = rows[:, -1:]
            yield _stated(out, states)
        if waiting is not None:
            yield _stated(waiting, np.ones(1, int))
        if before is not None:
            yield _stated(before, np.full(1, 3))

    return ordered.mapInArrow(run, "rank long, next long, doc_id long, low long, count int, state int")


def _stated(rows: np.ndarray, state: np.ndarray) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()]
    return pa.record_batch(
        [*[pa.array(x, k) for x, k in zip(rows, kinds)], pa.array(state, pa.int32())],
        ["rank", "next", "doc_id", "low", "count", "state"],
    )


def windows(rows: DataFrame, unclear: DataFrame, length: int) -> DataFrame:
    """(rank, rank at the grown offset) of every window of the unclear samples."""
    spots = unclear.groupBy("doc_id").agg(F.collect_list(F.struct("low", "count")).alias("spots"))
    far = length - 2 * FIRST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            data, offsets = encoded(batch.column("text"))
            spots = batch.column("spots")
            each = np.diff(spots.offsets.to_numpy())
            flat = spots.flatten()
            text = np.repeat(np.arange(batch.num_rows), each)
            low = flat.field("low").to_numpy() + offsets[text]
            count = flat.field("count").to_numpy().astype(np.int64)
            at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            text = np.repeat(text, count)
            at, where = np.unique(at, return_index=True)
            text = text[where]
            first, second = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
            for start in range(0, len(data), BLOCK):
                a, b = np.searchsorted(at, [start, start + BLOCK])
                if a == b:
                    continue
                piece = data[start : start + BLOCK + length]
                rank = _ranks(piece)
                double = _pair(rank[:-FIRST], rank[FIRST:])
                first[a:b], second[a:b] = double[at[a:b] - start], double[at[a:b] - start + far]
            both = mixed(_pair(first, second))
            ids = batch.column("doc_id").take(pa.array(text))
            yield pa.record_batch(
                [_signed(both), _signed(first >> _U(33)), ids, pa.array(at - offsets[text])],
                ["rank", "next", "doc_id", "low"],
            )

    joined = rows.join(spots, "doc_id").select("doc_id", "text", "spots")
    return joined.mapInArrow(run, "rank long, next long, doc_id long, low long").withColumn("count", F.lit(1))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """``doc_id, low, count``: windows (first, how many in a row) of ``length`` bytes that start
    earlier as well.

    Round one sorts pairs of the rank of a sample's picked bytes and of all bytes its windows
    cover. Alone in its rank, a sample's windows are unique; a pair met before has windows met
    before. Only the first of each pair in a rank with several goes on: round two sorts the
    pairs of its single windows, which are the threshold's length.
    """
    if length < 2 * FIRST or length > 4 * FIRST:
        raise ValueError(f"length has to be {2 * FIRST} to {4 * FIRST} bytes")
    spark = docs.sparkSession
    rows = _rows(docs, doc_id, text).where(F.col("doc_id").isNotNull())
    samples, at_samples = settle_for_now(sampled(rows, length), "samples")
    one = settle(
        reranked(samples.where("not repeat").drop("repeat")).select("doc_id", "low", "count", "state"), "round-one"
    )
    own = settle(samples.where("repeat").select("doc_id", "low", "count"), "own-repeats")
    release(spark)
    discard(spark, at_samples)
    two = settle(reranked(windows(rows, one.where("state in (1, 2)"), length)), "round-two")
    release(spark)
    # the first row of a partition is met before if the last one of an earlier partition equals it
    edge = two.where("state = 2")
    earlier = two.where("state = 3").select("rank", "next", F.col("doc_id").alias("other"), F.col("low").alias("there"))
    edge = edge.join(earlier, ["rank", "next"]).where("other < doc_id or other = doc_id and there < low")
    met = two.where("state = 0").select("doc_id", "low", "count").union(edge.select("doc_id", "low", "count").distinct())
    return one.where("state = 0").select("doc_id", "low", "count").union(own).union(met)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row of ``docs``.

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes covers it that also
    starts earlier: in a document with a smaller id, or in the same one before. Strings are
    judged on the input; ``spans`` are the maximal removed runs, ``kept`` the bytes left, end to
    end. Matches never cross documents. A null text is empty; a document without an id keeps
    all and repeats nothing; rows that share an id are taken for one document, so an equal row
    isn't a repeat of its twin; an empty table gives no rows; other columns are not read.
    """
    found = repeats(docs, doc_id, text, length)
    packed = found.groupBy("doc_id").agg(F.collect_list(F.col("low") * 128 + F.col("count")).alias("marks"))
    spot = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4_000_000):
            data, offsets = encoded(batch.column("text"))
            marks = batch.column("marks")
            spans, kept = [], []
            for i in range(batch.num_rows):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                if not marks[i].is_valid:
                    spans.append([])
                    kept.append(raw)
                    continue
                mark = np.unique(marks[i].values.to_numpy())
                start = mark >> 7
                end = np.maximum.accumulate(start + (mark & 127) - 1 + length)
                new = np.append(True, start[1:] > end[:-1])
                first = start[new]
                last = end[np.append(np.flatnonzero(new)[1:], len(end)) - 1]
                spans.append([{"start": a, "end": b} for a, b in zip(first.tolist(), last.tolist())])
                edges = [0, *np.stack([first, last], axis=1).ravel().tolist(), len(raw)]
                kept.append(b"".join(raw[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)))
            yield pa.record_batch(
                [
                    batch.column("doc_id"), pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(spans, pa.list_(spot)), pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    joined = _rows(docs, doc_id, text).join(packed, "doc_id", "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(
        run, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    )


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
