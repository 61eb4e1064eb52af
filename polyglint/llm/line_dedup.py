"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only."""

from __future__ import annotations

import json
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, settle

#: Edits between near lines at most, and the characters of the shorter line that allow for each
#: edit after the first.
THRESHOLD = 1
CHARS_PER_EDIT = 20
#: Segments of lines that one edit is allowed for: first two, one of which has to match; keys that
#: more than ``FEW`` lines share are looked at again in finer segments. Lines that t edits are
#: allowed for have t + 1, t + 2 and t + 3 segments at these levels; 1, 2 and 3 have to match.
LEVELS = (2, 8, 32)
FEW = 32
#: Bits of the bitmap that tells lines without a candidate before their texts are moved (16 MB).
BITS = 1 << 27


def lines_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20) -> DataFrame:
    """``doc_id, line_no, line, id``: the trimmed lines of ``min_chars`` code points or more.

    ``id`` is a 128-bit hash of the line, so that lines are compared without moving them.
    """
    lines = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.posexplode(lines).alias("line_no", "line"))
    rows = bind(rows.withColumnRenamed("line", "raw"), {"line": F.btrim("raw", F.lit(" \t\r\x0b\x0c"))}).drop("raw")
    rows = rows.where(F.char_length("line") >= min_chars)
    return rows.withColumn("id", F.struct(F.xxhash64("line"), F.xxhash64("line", F.lit(1))))


def _edits(length: Column, threshold: int, chars_per_edit: int) -> Column:
    """Edits allowed between a line of ``length`` and one as long or longer."""
    return F.greatest(F.lit(1), F.least(F.lit(threshold), F.floor(length / chars_per_edit).cast("int")))


def shapes(edits: int, need: int) -> list[tuple[int, int, list[int], list[int]]]:
    """``edits, delta, segments, shifts``: which of the ``edits + need`` segments of a line are
    looked for how far from their places in a line longer by ``delta``.

    ``edits`` leave ``need`` segments whole. Shifts differ by insertions and deletions alone, so
    their ups and downs from 0 to ``delta`` are no more than the edits. For one segment those
    before and behind it bound them further: the first segment that is whole with as many edits
    before it as segments exists, as there is one segment more than edits.
    """
    found = []
    for delta in range(edits + 1):
        for chosen in combinations(range(edits + need), need):
            for shifts in product(range(-edits, edits + 1), repeat=need):
                path = (0, *shifts, delta)
                if sum(abs(b - a) for a, b in zip(path, path[1:])) > edits:
                    continue
                if need == 1 and (abs(shifts[0]) > chosen[0] or abs(delta - shifts[0]) > edits - chosen[0]):
                    continue
                found.append((edits, delta, list(chosen), list(shifts)))
    return found


def _wide_keys(lines: DataFrame, need: int, threshold: int, chars_per_edit: int) -> DataFrame:
    """``id, key, probe`` as ``_keys``, of the lines that two edits or more are allowed for."""
    table = json.dumps([
        dict(zip(("t", "delta", "at", "shift"), x)) for t in range(2, threshold + 1) for x in shapes(t, need)
    ])
    shape = F.explode(F.from_json(F.lit(table), "array<struct<t int, delta int, at array<int>, shift array<int>>>"))
    rows = bind(lines.select("id", "line"), {"n": F.char_length("line")}).where(F.col("n") >= 2 * chars_per_edit)
    rows = rows.withColumn("x", shape)
    length, segments = F.col("n") - F.col("x.delta"), F.col("x.t") + need
    rows = rows.where(F.col("x.t") == _edits(length, threshold, chars_per_edit))
    begin = lambda i: F.floor(length * i / segments).cast("int")
    pieces = F.transform("x.at", lambda i, k: F.when(
        begin(i) + F.get("x.shift", k) >= 0,
        F.substring("line", begin(i) + F.get("x.shift", k) + 1, begin(i + 1) - begin(i)),
    ))
    key = F.xxhash64(F.lit(-need), length, "x.t", "x.at", pieces)
    moved = F.exists("x.shift", lambda s: s != 0)
    return rows.select("id", key.alias("key"), ((F.col("x.delta") > 0) | moved).alias("probe"))


def _keys(lines: DataFrame, segments: int, threshold: int, chars_per_edit: int) -> DataFrame:
    """``id, key, probe``: for each segment, all of the line but that segment.

    Index keys stand for the line's own length; probe keys for lines shorter by one, whose
    segments behind the edit lie one place further on here. With two segments a key is one
    whole segment; an edit touches one segment, so two lines within one edit share a key.
    """
    places = F.explode(F.sequence(F.lit(0), F.lit(segments - 1)))
    shifts = F.explode(F.array(F.lit(0), F.lit(1)))
    rows = bind(lines, {"n": F.char_length("line")}).withColumn("i", places).withColumn("shift", shifts)
    n, length = F.col("n"), F.col("n") - F.col("shift")
    if threshold > 1:
        rows = rows.where(_edits(length, threshold, chars_per_edit) == 1)
    begin = F.floor(length * F.col("i") / segments).cast("int")
    end = F.floor(length * (F.col("i") + 1) / segments).cast("int") + F.col("shift")
    key = F.xxhash64(
        F.lit(segments), length, "i", F.substring("line", F.lit(1), begin), F.substring("line", end + 1, n - end)
    )
    return rows.select("id", key.alias("key"), (F.col("shift") > 0).alias("probe"))


def candidates(
    lines: DataFrame, threshold: int = THRESHOLD, chars_per_edit: int = CHARS_PER_EDIT
) -> DataFrame:
    """``a, b``: ids of different lines that share a key, each pair once.

    A key with many lines isn't joined with itself: those lines get keys of finer segments,
    which the pairs within the threshold share as well. What still meets at the last level
    differs in a thirty-second of its length alone, or shares three segments.
    """
    found = None
    for need, level in enumerate(LEVELS, 1):
        keys = _keys(lines, level, threshold, chars_per_edit)
        if threshold > 1:
            keys = keys.union(_wide_keys(lines, need, threshold, chars_per_edit))
        several = keys.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        several = settle(several.where("least < most").select("key"), "line-keys")
        members = settle(keys.join(several, "key").distinct(), "line-members")
        sizes = members.groupBy("key").agg(F.count("*").alias("size"))
        last = level == LEVELS[-1]
        few = sizes if last else sizes.where(F.col("size") <= FEW)
        few = members.join(few.select("key"), "key")
        own, other = few.where("not probe").alias("own"), few.alias("other")
        pairs = own.join(
            other,
            (F.col("own.key") == F.col("other.key")) & (F.col("own.id") != F.col("other.id"))
            & (F.col("other.probe") | (F.col("own.id") < F.col("other.id"))),
        ).select(
            F.least("own.id", "other.id").alias("a"), F.greatest("own.id", "other.id").alias("b")
        )
        pairs = settle(pairs.distinct(), "line-pairs")
        found = pairs if found is None else found.union(pairs)
        if last:
            break
        hot = members.join(sizes.where(F.col("size") > FEW).select("key"), "key").select("id").distinct()
        hot = settle(hot, "hot-lines")
        if hot.isEmpty():
            break
        lines = settle(_texts(lines, hot), "hot-texts")
    return found.distinct()


def _texts(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """The lines of ``ids``; merged at every size, as ids grow with the lines."""
    lines = _likely(lines, ids)
    return lines.join(ids.hint("merge"), "id").groupBy("id").agg(F.any_value("line").alias("line"))


def _likely(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, line`` of all lines of ``ids``, and of others only where their bits are the same.

    The bitmap has BITS bits however many ids there are, so lines are left out where they stand.
    """
    spot = F.pmod(F.xxhash64("id"), F.lit(BITS))
    place = [F.bitmap_bucket_number(spot).alias("bucket"), F.bitmap_bit_position(spot).alias("bit")]
    marks = ids.select(*place).repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    asked = lines.select("id", "line", *place).join(F.broadcast(marks), "bucket")
    byte = "int(conv(hex(substring(bits, int(bit div 8) + 1, 1)), 16, 10))"
    return asked.where(f"shiftright({byte}, int(bit % 8)) % 2 = 1").select("id", "line")


def near_lines(
    lines: DataFrame, threshold: int = THRESHOLD, chars_per_edit: int = CHARS_PER_EDIT
) -> DataFrame:
    """``id, other``: different lines within the edits allowed for the shorter, in both directions.

    Candidates are verified by Spark's edit distance with a threshold, which fills the band of
    the matrix alone.
    """
    pairs = settle(candidates(lines, threshold, chars_per_edit), "line-candidates")
    ids = settle(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "candidate-ids")
    texts = settle(_texts(lines, ids), "candidate-texts")
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
    edits = F.levenshtein("line_a", "line_b", threshold)
    shorter = F.least(F.char_length("line_a"), F.char_length("line_b"))
    close = both.where((edits >= 0) & (edits <= _edits(shorter, threshold, chars_per_edit))).select("a", "b")
    close = settle(close, "line-links")
    return close.select(F.col("a").alias("id"), F.col("b").alias("other")).union(close.select("b", "a"))


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20,
    threshold: int = THRESHOLD, chars_per_edit: int = CHARS_PER_EDIT, min_exact_chars: int | None = None,
) -> DataFrame:
    """``doc_id, drop, n_exact, n_near, n_links`` of the documents with a line met before.

    A line is met before if an equal line, or a near one, stands at an earlier place (smaller
    document, or the same and a smaller line number). Lines are near within one edit, or within
    one for each ``chars_per_edit`` code points of the shorter, up to ``threshold``. ``drop`` has
    the numbers of such lines; ``n_links`` counts the different lines near to one of the
    document's. Lines of fewer than ``min_chars`` code points are near to none, and those of fewer
    than ``min_exact_chars`` (``min_chars`` if not given; blank lines in any case) are not compared.
    """
    if threshold < 1 or chars_per_edit < 1:
        raise ValueError("threshold and chars_per_edit have to be 1 or more")
    least = min_chars if min_exact_chars is None else max(1, min(min_exact_chars, min_chars))
    lines = lines_of(docs, doc_id, text, least).where(F.col("doc_id").isNotNull())
    links = near_lines(lines.where(F.char_length("line") >= min_chars), threshold, chars_per_edit)
    places = lines.groupBy("id").agg(
        F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n"),
    )
    linked = links.groupBy("id").agg(F.count("*").alias("links"))
    marked = places.join(linked, "id", "left").where("n > 1 or links is not null")
    marked = settle(marked, "marked-lines")
    earliest = links.join(marked.select(F.col("id").alias("other"), F.col("first").alias("there")), "other")
    earliest = earliest.groupBy("id").agg(F.min("there").alias("near_first"))
    marked = settle(marked.join(earliest, "id", "left"), "judged-lines")
    met = lines.drop("line").join(marked, "id")
    place = F.struct("doc_id", "line_no")
    exact = F.col("first") < place
    near = F.coalesce(F.col("near_first") < place, F.lit(False))
    return met.groupBy("doc_id").agg(
        F.collect_set(F.when(exact | near, F.col("line_no"))).alias("drop"),
        F.count_if(exact).alias("n_exact"), F.count_if(near & ~exact).alias("n_near"),
        F.coalesce(F.sum("links"), F.lit(0)).alias("n_links"),
    )


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20,
    threshold: int = THRESHOLD, chars_per_edit: int = CHARS_PER_EDIT, min_exact_chars: int | None = None,
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, plus ``n_exact, n_near, n_links``.

    The first place of a line stays. A null text stays null; a document without an id is
    returned as it is; rows with one id count as one document, so an equal row repeats no line
    of its twin; blank lines and lines under both floors stay; an empty table gives no rows. Other columns pass
    through, but input columns named like an added one are replaced.
    """
    added = ["n_exact", "n_near", "n_links"]
    kept = docs.drop(*added)
    found = repeated_lines(docs, doc_id, text, min_chars, threshold, chars_per_edit, min_exact_chars)
    taken = {c.lower() for c in kept.columns}
    own, gone = (next(n for i in range(len(taken) + 1) if (n := f"{c}{i or ''}") not in taken) for c in ("_doc_id", "_drop"))
    found = settle(found, "repeated-lines").select(F.col("doc_id").alias(own), F.col("drop").alias(gone), *added)
    joined = kept.join(found.hint("merge"), F.col(doc_id).cast("long") == F.col(own), "left")
    stays = F.array_join(
        F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(gone, i)), "\n"
    )
    changed = F.when(F.size(gone) > 0, stays).otherwise(F.col(text))
    joined = joined.withColumn(text, changed)
    return joined.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in added}).drop(own, gone)
