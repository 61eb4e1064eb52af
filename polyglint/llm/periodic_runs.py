"""Runs of a repeating word sequence, found in tiles of each octave of periods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, slices
from .shingles import mixed
from .words import split

#: A run takes this many periods, and this many words, at least. The tiles below rest on it.
EXPONENT, SHORTEST = 4, 6
#: Words of a tile's core at least, and in periods' lower bounds, for octaves of longer periods.
CORE, CORE_PERIODS = 512, 8
_TILE = "octave int, start long, bounds array<int>, words array<int>"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _reach(low: int) -> int:
    """Words that must repeat behind a boundary, for periods of ``low`` to ``2 * low - 1``.

    A run of period q has (EXPONENT - 1) * q words or more that equal the word q further on, one
    after another. Boundaries stand ``low`` apart, so one of them has 2 * low such words behind
    it; period 1 has SHORTEST - 1 of them.
    """
    return 4 if low == 1 else 2 * low


def _blocks(codes: np.ndarray, low: int) -> np.ndarray:
    """Codes of twice as many words: those from each place and those ``low`` places on."""
    out = codes.copy()
    out[:-low] = mixed(codes[:-low] * _MULTIPLIER + codes[low:])
    return out


def _boundaries(ids: np.ndarray, codes: np.ndarray, low: int, starts: np.ndarray, counts: np.ndarray):
    """Boundaries (places, owners) where a run of this octave may pass.

    Codes only rule out; equal words always pass. A boundary inside a stretch of shorter period
    is left out: there, by Fine and Wilf, no period of this octave is a smallest one.
    """
    reach = _reach(low)
    per = np.maximum((counts - reach - low) // low + 1, 0)
    owner = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    places = starts[owner] + nth * low
    ends = starts[owner] + counts[owner]
    passing = np.zeros(len(places), bool)
    rows = max(1, 2_000_000 // low)
    for at in range(0, len(places), rows):
        here = places[at : at + rows, None]
        there = here + np.arange(low, 2 * low)
        inside = there + reach <= ends[at : at + rows, None]
        there = np.where(inside, there, here)
        passing[at : at + rows] = ((codes[there] == codes[here]) & inside).any(axis=1)
    found = np.flatnonzero(passing)
    if low > 1:
        keep = np.ones(len(found), bool)
        for i, b in enumerate(found):
            here, stop = places[b], ends[b]
            shorter = here + np.arange(1, low)
            shorter = shorter[shorter + reach <= stop]
            for d in shorter[codes[shorter] == codes[here]]:
                if np.array_equal(ids[here : here + reach], ids[d : d + reach]):
                    keep[i] = False
                    break
        found = found[keep]
    return places[found], owner[found]


def _tiles(ids: np.ndarray, counts: np.ndarray) -> list[list[dict]]:
    """For each text the tiles, of all octaves, that some run may pass through."""
    tiles: list[list[dict]] = [[] for _ in counts]
    starts = np.cumsum(counts) - counts
    words = mixed(ids.astype(np.uint64) + np.uint64(1))
    pairs = _blocks(words, 1)
    codes, low = _blocks(pairs, 2), 1  # four words for period 1
    while True:
        live = np.flatnonzero(counts >= max(EXPONENT * low, SHORTEST))
        if len(live) == 0:
            return tiles
        places, owners = _boundaries(ids, codes, low, starts[live], counts[live])
        owners = live[owners]
        core = max(CORE, CORE_PERIODS * low)
        inner = places - starts[owners]
        heads = np.flatnonzero(np.diff(owners, prepend=-1) | np.diff(inner // core, prepend=-1))
        for first, stop in zip(heads, np.append(heads[1:], len(places))):
            doc = owners[first]
            base = inner[first] // core * core
            begin = max(0, base - low)
            end = min(counts[doc], base + core + _reach(low) + 3 * low)
            tiles[doc].append({
                "octave": low, "start": int(begin), "bounds": (inner[first:stop] - begin).tolist(),
                "words": ids[starts[doc] + begin : starts[doc] + end].astype(np.int32),
            })
        # codes hold 4, then 4, 8, 16, ... words
        codes = codes if low == 1 else _blocks(codes, 2 * low)
        low *= 2


def z_values(x: list[int], stop: int) -> list[int]:
    """Length of the longest common prefix of ``x`` and ``x[i:]``, for i below ``stop``."""
    n = len(x)
    z = [n] + [0] * (stop - 1)
    left = right = 0
    for i in range(1, min(stop, n)):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _solve(low: int, start: int, bounds: list[int], words: list[int]) -> Iterator[tuple[int, int, int]]:
    """(period, from, to): stretches of places whose word recurs a period on, as seen from a
    tile's boundaries, joined within the tile. Both ends are places of the text."""
    reach = _reach(low)
    seen: dict[int, list[list[int]]] = {}
    for b in bounds:
        ahead = words[b : b + reach + 3 * low]
        forward = z_values(ahead, 2 * low)
        periods = [q for q in range(low, min(2 * low, len(ahead))) if forward[q] >= reach]
        if not periods:
            continue
        back = words[max(0, b - low) : b][::-1]
        # the text before b, then, backwards too, what ends at b + 2 * low - 1
        tail = words[max(0, b - low) : b + 2 * low - 1][::-1]
        z = z_values([*back, -1, *tail], len(back) + 1 + len(tail))
        reached = b + 2 * low - 1 if b + 2 * low - 1 <= len(words) else len(words)
        for q in periods:
            lo = b - z[len(back) + 1 + reached - (b + q)] if back else b
            hi = b + min(forward[q], reach + low)
            known = seen.setdefault(q, [])
            if known and lo <= known[-1][1]:
                known[-1][0], known[-1][1] = min(lo, known[-1][0]), max(hi, known[-1][1])
            else:
                known.append([lo, hi])
    for q, stretches in seen.items():
        for lo, hi in stretches:
            yield q, start + lo, start + hi


def _tile_up(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, n_words, words`` (joined by blanks) and the tiles, none for most texts."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = pa.list_(pa.struct([
        ("octave", pa.int32()), ("start", pa.int64()), ("bounds", pa.list_(pa.int32())), ("words", pa.list_(pa.int32())),
    ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4_000_000):
            found = split(batch.column("text"))
            tiles = pa.array(_tiles(found.ids(), found.counts), schema)
            columns = [batch.column("doc_id"), pa.array(found.counts), found.joined().cast(pa.string()), tiles]
            yield pa.record_batch(columns, ["doc_id", "n_words", "words", "tiles"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, words string, tiles array<struct<{_as_fields(_TILE)}>>")


def _as_fields(ddl: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (part.split(" ", 1) for part in ddl.split(", ")))


def _stretches(tiles: DataFrame) -> DataFrame:
    """``row, period, lo, hi`` of every tile, each solved by itself wherever Spark puts it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for tile in batch.to_pylist():
                out += [(tile["row"], *s) for s in _solve(tile["octave"], tile["start"], tile["bounds"], tile["words"])]
            columns = zip(*out) if out else [[], [], [], []]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["row", "period", "lo", "hi"])

    spread = tiles.repartition("row", "octave", "start")
    return spread.mapInArrow(run, "row long, period long, lo long, hi long")


def _stitch(stretches: DataFrame) -> DataFrame:
    """``row, runs``: stretches of a period that overlap are one; those long enough are runs.
    Of equal stretches the smallest period counts, the others are its multiples."""
    order = Window.partitionBy("row", "period").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = stretches.withColumn("begins", F.coalesce(F.col("lo") > before, F.lit(True)).cast("int"))
    parts = parts.withColumn("part", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = parts.groupBy("row", "period", "part").agg(F.min("lo").alias("start"), F.max("hi").alias("hi"))
    whole = whole.withColumn("length", F.col("hi") - F.col("start") + F.col("period"))
    whole = whole.where((F.col("length") >= EXPONENT * F.col("period")) & (F.col("length") >= SHORTEST))
    runs = whole.groupBy("row", "start", "length").agg(F.min("period").alias("period"))
    return runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))


def _collapse(found: DataFrame) -> DataFrame:
    """Drop what any run repeats: its words after the first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words", 4_000_000):
            texts = []
            for text, runs in zip(batch.column("words").to_pylist(), batch.column("runs").to_pylist()):
                if runs:
                    words = text.split(" ")
                    gone = np.zeros(len(words), bool)
                    for r in runs:
                        gone[r["start"] + r["period"] : r["start"] + r["length"]] = True
                    text = " ".join([words[i] for i in np.flatnonzero(~gone)])
                texts.append(text)
            at = batch.schema.get_field_index("words")
            yield batch.set_column(at, "words", pa.array(texts, pa.string()))

    return found.mapInArrow(run, found.schema)


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    Words are runs of bytes other than blanks and line breaks, numbered from 0. A run is a stretch
    of words with smallest period q (words q apart are equal), of EXPONENT * q and SHORTEST words
    at least, that no neighbour extends. ``runs`` holds (start, length, period) by start, then
    period; ``collapsed`` is the words that no run covers after its first period, one blank apart.

    For each octave of periods a text is cut into overlapping tiles. A tile is kept if words recur
    at one of its boundaries, which every run of that octave does somewhere; kept tiles are dealt
    over the cluster, solved one by one by Z-functions to both sides of each boundary, and the
    stretches found are put together by text and period. Texts without such a tile take no part
    in any shuffle.

    Null or empty texts have no words, no runs and an empty ``collapsed``; rows that repeat an id,
    or have none, are judged each by itself; an empty table gives no rows; other columns aren't
    read. A text of any length is cut by the same rule.
    """
    tiled = _tile_up(docs, doc_id, text)
    # the key of a row is fixed by writing it
    held = settle(tiled.where(F.size("tiles") > 0).withColumn("row", F.monotonically_increasing_id()), "tiled")
    stretches = _stretches(held.select("row", F.inline("tiles")))
    joined = held.drop("tiles").join(_stitch(stretches), "row", "left")
    none = F.array().cast("array<struct<start: bigint, length: bigint, period: bigint>>")
    joined = joined.select("doc_id", "n_words", F.coalesce("runs", none).alias("runs"), "words")
    plain = tiled.where(F.size("tiles") == 0).select("doc_id", "n_words", none.alias("runs"), "words")
    return _collapse(joined).union(plain).withColumnRenamed("words", "collapsed")
