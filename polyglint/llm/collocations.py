"""Phrases whose words keep company, mined by a sample's proposals and its negative border."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shingles
from .common import encoded, settle, slices
from .shingles import mixed
from .words import byte_table, split

LONGEST = 5
#: Bits for each phrase that a filter is made for, and for a whole filter at most (8 MB).
PHRASE_BITS, FILTER_BITS = 64, 1 << 26
#: Share of the rows that the proposals come from, and how far below the sought frequency a
#: phrase of the sample may stay.
SAMPLE, SLACK = 0.125, 0.5
#: Phrases that take part in a larger share of all words than this are looked up by broadcast:
#: at most LONGEST times its inverse, of which there can't be more.
HOT_SHARE = 1e-4
SLICE = 2_000_000
_CUTS = b".,;:!?\n\x0b\x0c\r"
_CUT = re.compile(rb"[.,;:!?\x0A-\x0D]")
_STEP = np.uint64(0xD6E8FEB86659FD93)
_COUNTED = "lang string, phrase string, k int, code long, n long"


# --- which phrases a pass counts ---------------------------------------------------------------


def _held(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Which codes the filter holds. It may hold some that were never put in, always the same."""
    place = codes & np.uint64(len(bits) * 64 - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def filter_of(phrases: DataFrame, bits: np.ndarray | None = None) -> np.ndarray:
    """A filter with the codes of ``phrases``, or-ed together by Spark word by word; ``bits`` is
    one to add them to."""
    if bits is None:
        size = 1 << max(12, int(phrases.count() * PHRASE_BITS - 1).bit_length())
        bits = np.zeros(min(size, FILTER_BITS) // 64, np.uint64)
    place = F.col("code").bitwiseAND(len(bits) * 64 - 1)
    words = phrases.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(code & 63 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = bits.copy()
    out[found.column("word").to_numpy()] |= found.column("bits").to_numpy().view(np.uint64)
    return out


@dataclass
class Gate:
    """A pass counts a phrase if the filter ``now`` holds what is left of it without its last
    word and without its first, unless ``before`` does too: those have been counted. Without a
    filter it counts all phrases of its lengths."""

    lengths: tuple[int, ...]
    now: np.ndarray | None = None
    before: np.ndarray | None = None
    #: hold phrases against their pairs of words rather than against phrases one shorter
    pairs: bool = False
    #: count only phrases that this filter holds themselves
    only: np.ndarray | None = None


def _passes(bits: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    inside = _held(bits, shorter)
    return inside[:-1] & inside[1:]


# --- counting within a task ----------------------------------------------------------------------


def _segments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Texts and languages in slices; a text longer than a slice is cut where no phrase passes."""
    for batch in slices(batches, "text", size):
        texts, langs = batch.column("text"), batch.column("lang")
        if batch.num_rows > 1 or len(encoded(texts)[0]) <= size:
            yield texts, langs
            continue
        raw, at = encoded(texts)[0].tobytes(), 0
        while at < len(raw):
            cut = _CUT.search(raw, at + size)
            end = cut.end() if cut else len(raw)
            yield pa.array([raw[at:end].decode()], pa.large_string()), langs
            at = end


def _languages(langs: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    coded = langs.cast(pa.string()).dictionary_encode()
    salts = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in coded.dictionary.to_pylist()]
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, np.array(salts, np.uint64)


def _grouped(codes: np.ndarray, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First place and size of each group of equal ``ids``; codes sort, ids decide."""
    _, first, group, sizes = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
    if all(np.array_equal(x, x[first][group]) for x in ids):
        return first, sizes
    order = np.lexsort(ids)
    new = np.zeros(len(order), bool)
    new[0] = True
    for x in ids:
        new[1:] |= np.diff(x[order]) != 0
    begins = np.flatnonzero(new)
    return order[begins], np.diff(begins, append=len(order))


def _count(texts: pa.Array, langs: pa.Array, gate: Gate, spelt: bool) -> Iterator[pa.RecordBatch]:
    found = split(texts, b" \t" + _CUTS, lower=True)
    if len(found.starts) == 0:
        return
    coded = found.strings().dictionary_encode()
    ids, dictionary = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    word_codes = shingles.words(dictionary)[0][ids]
    owners = found.owners()
    lang, lang_names, salts = _languages(langs)
    lang = lang[owners].astype(np.int64)
    # words of a piece share the number of cuts before them, and the text
    piece = np.searchsorted(np.flatnonzero(byte_table(_CUTS)[found.data]), found.starts) + owners
    names = ["lang", "phrase", "k", "code", "n"]

    def rows(k: int, codes: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        if not spelt:
            found, sizes = np.unique(codes[places], return_counts=True)
            return pa.record_batch([pa.array(found.view(np.int64)), pa.array(sizes.astype(np.int64))], names[3:])
        parts = [ids[places + t] for t in range(k)]
        first, sizes = _grouped(codes[places], [lang[places], *parts])
        heads = places[first]
        words = [dictionary.take(pa.array(ids[heads + t])) for t in range(k)]
        phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if k > 1 else words[0]
        return pa.record_batch([
            lang_names.take(pa.array(lang[heads])), phrase.cast(pa.string()), pa.array(np.full(len(heads), k, np.int32)),
            pa.array(codes[heads].view(np.int64)), pa.array(sizes.astype(np.int64)),
        ], names)

    if spelt and 1 in gate.lengths:
        totals = np.bincount(lang, minlength=len(lang_names))
        zeros = np.zeros(len(totals), np.int64)
        yield pa.record_batch([
            lang_names, pa.array([""] * len(totals), pa.string()), pa.array(zeros.astype(np.int32)), pa.array(zeros), pa.array(totals),
        ], names)
    codes = mixed(salts[lang] + word_codes)
    paired = None
    for k in range(1, max(gate.lengths) + 1):
        shorter = codes
        if k > 1:
            if len(shorter) < 2:
                return
            codes = mixed(shorter[:-1] * _STEP + word_codes[k - 1 :])
        if k not in gate.lengths:
            if k == 2 and gate.pairs:
                paired = _held(gate.now, codes)
            continue
        here = piece[: len(codes)] == piece[k - 1 :]
        if k > 1 and gate.now is not None:
            if gate.pairs:
                for t in range(k - 1):
                    here &= paired[t : t + len(here)]
            else:
                here &= _passes(gate.now, shorter)
                if gate.before is not None:
                    here &= ~_passes(gate.before, shorter)
        if gate.only is not None:
            here &= _held(gate.only, codes)
        places = np.flatnonzero(here)
        if len(places):
            yield rows(k, codes, places)


def _counted(docs: DataFrame, gate: Gate, least: int, spelt: bool) -> DataFrame:
    shared, size = docs.sparkSession.sparkContext.broadcast(gate), SLICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs in _segments(batches, size):
            yield from _count(texts, langs, shared.value, spelt)
            pa.default_memory_pool().release_unused()

    parts = docs.mapInArrow(run, _COUNTED if spelt else "code long, n long")
    sums = parts.groupBy([c for c in parts.columns if c != "n"]).agg(F.sum("n").alias("n"))
    enough = F.col("n") >= least
    found = settle(sums.where(enough | (F.col("k") == 0) if spelt else enough), "counted-phrases")
    shared.destroy()
    return found


def count_codes(docs: DataFrame, gate: Gate, least: int) -> DataFrame:
    """``code, n`` of what the gate lets pass, met ``least`` times or more. Phrases may share a
    code, so a count may be too large, never too small."""
    return _counted(docs, gate, least, False)


def count_phrases(docs: DataFrame, gate: Gate, least: int) -> DataFrame:
    """``lang, phrase, k, code, n`` of the phrases that the gate lets pass, counted exactly, those
    met ``least`` times or more; where single words are counted, also a row of length 0 with the
    number of all words of each language."""
    return _counted(docs, gate, least, True)


# --- passes over the corpus --------------------------------------------------------------------


def frequent_phrases(docs: DataFrame, min_count: int, longest: int = LONGEST) -> DataFrame:
    """``lang, phrase, k, code, n`` of all phrases of 1 to ``longest`` words met ``min_count``
    times or more, and the totals as phrases of length 0.

    A sample proposes phrases at a lowered threshold. A full pass counts the proposals and their
    negative border, which are the phrases both of whose shorter parts are proposed. Where the
    border holds a frequent phrase the proposals have failed: it joins them, and a further pass
    counts the border that this adds, until no pass finds one. The first pass adds up codes, which
    are short, before phrases whose codes come often enough are spelt out and counted exactly;
    what failures add is little and spelt out at once.
    """
    drawn = settle(docs.sample(SAMPLE, seed=42), "collocation-sample")
    least = max(2, int(min_count * SAMPLE * SLACK))
    bits = filter_of(count_codes(drawn, Gate((1, 2)), least))
    if longest > 3:
        bits = filter_of(count_codes(drawn, Gate(tuple(range(3, longest)), bits, pairs=True), least), bits)
    gate = Gate(tuple(range(1, longest + 1)), bits)
    likely = filter_of(count_codes(docs, gate, min_count))
    found = counted = count_phrases(docs, replace(gate, only=likely), min_count)
    while True:
        failed = settle(_outside(counted.where(F.col("k").between(1, longest - 1)), gate.now), "border-failures")
        if failed.isEmpty():
            return found
        gate = Gate(tuple(range(2, longest + 1)), filter_of(failed, gate.now), before=gate.now)
        counted = count_phrases(docs, gate, min_count)
        found = found.union(counted)


def _outside(phrases: DataFrame, bits: np.ndarray) -> DataFrame:
    """Those that the filter doesn't hold."""
    shared = phrases.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(~_held(shared.value, codes)))

    return phrases.mapInArrow(run, phrases.schema)


# --- scores --------------------------------------------------------------------------------------


def cut_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) in decimals of 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    over = wide(a) * wide(n) * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", over, wide(left) * wide(right))


def _looked_up(rows: DataFrame, key: str, counts: DataFrame, hot: DataFrame, out: str) -> DataFrame:
    """Add the count of the phrase in ``key``. Phrases that stand in very many others meet a
    bounded broadcast; each of the rest is in few, so no key of the shuffled join is hot."""
    own = lambda df: df.select("lang", F.col("phrase").alias(key), F.col("n").alias(out))
    near = rows.join(F.broadcast(own(hot)), ["lang", key])
    far = rows.join(F.broadcast(own(hot)), ["lang", key], "left_anti").join(own(counts), ["lang", key])
    return near.unionByName(far)


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 100, top: int = 2000,
    percent: int = 100, longest: int = LONGEST,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    A-Z are lower-cased, texts cut into pieces at punctuation and line breaks, pieces into words at
    blanks and tabs. A candidate is a phrase of 2 to ``longest`` words within a piece that occurs
    ``min_count`` times or more. Each cut in two scores 1000 * a * n over the product of the
    parts' counts, rounded down; the lowest counts, of equal ones the first. Candidates that lie
    in a longer one with ``percent`` of their occurrences or more are dropped: the next longer
    ones decide, as counts fall with length. Order: score and a falling, then the phrase.

    A null language is ``und``, a null or empty text has no words; repeated rows count each time;
    an empty table gives no rows; other columns aren't read; a text of any length is counted whole.
    """
    if longest < 2 or min_count < 1:
        raise ValueError("phrases of two words or more that occur at all are needed")
    rows = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    found = frequent_phrases(rows, min_count, longest)
    totals = found.where("k = 0").groupBy("lang").agg(F.sum("n").alias("total"))
    found = found.where("k > 0")
    least = totals.agg(F.coalesce(F.sum("total"), F.lit(0)) * HOT_SHARE).first()[0]
    hot = found.where(F.col("n") > least)
    candidates = found.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))
    words = F.split("phrase", " ")
    parts = candidates.where("k > 2").withColumn("w", words).select(
        "lang", "a", F.explode(F.array(F.array_join(F.expr("slice(w, 1, k - 1)"), " "), F.array_join(F.expr("slice(w, 2, k - 1)"), " "))).alias("phrase")
    )
    around = parts.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = candidates.join(around, ["lang", "phrase"], "left")
    kept = kept.where(F.col("around").isNull() | (100 * F.col("around") < percent * F.col("a")))
    kept = settle(kept.join(totals.withColumnRenamed("total", "n"), "lang").drop("around"), "candidates")
    cuts = kept.withColumn("w", words).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "n", "cut", F.array_join(F.expr("slice(w, 1, cut)"), " ").alias("first"),
        F.array_join(F.expr("slice(w, cut + 1, k - cut)"), " ").alias("rest"),
    )
    cuts = _looked_up(_looked_up(cuts, "first", found, hot, "l"), "rest", found, hot, "r")
    scored = cuts.withColumn("score", cut_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    lowest = lowest.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each of 64 parts of a language, then of those
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    near = lowest.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = near.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
