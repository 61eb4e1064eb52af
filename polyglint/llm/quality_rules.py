"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind

#: Blank characters that part words: space, and tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
ADDED = (
    "words", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed",
    "failed_rule", "kept", "_lines", "_bits", "_keys", "_places",
)


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for documents that go; it is stated over the columns of ``measured``."""

    name: str
    rejects: Column


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the words and the base counts of every whole text; a null text has no words.

    Added: ``words``, ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_lines`` (lines with a word), ``n_dup_lines`` (of them, equal to an earlier line) and
    ``n_repeat_words`` (words inside 3-word windows that occur twice or more).
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    trimmed = F.btrim(body, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = bind(docs.drop(*ADDED), {"words": words, "_lines": lines, "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long")})
    out = bind(out, {
        "n_words": F.size("words").cast("long"),
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    })
    # one long for each window: its hash above, its place in the low bits
    bits = F.coalesce(F.ceil(F.log2(F.greatest(F.col("n_words"), F.lit(2)))).cast("int") + 1, F.lit(1))
    out = bind(out, {"_bits": bits})
    at = lambda i: F.get(F.col("words"), i)
    key = lambda w, i: F.coalesce(
        F.call_function("shiftleft", F.xxhash64(w, at(i + 1), at(i + 2)), F.col("_bits")).bitwiseOR(i.cast("long")),
        F.lit(0).cast("long"),
    )
    windows = F.slice(F.transform("words", key), F.lit(1), F.greatest(F.col("n_words") - 2, F.lit(0)).cast("int"))
    out = bind(out, {"_keys": F.sort_array(windows)})
    high = lambda k: F.call_function("shiftright", k, F.col("_bits"))
    low = lambda k: k.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1).cast("int")
    here, before = (lambda i: F.get("_keys", i)), (lambda i: F.get("_keys", i - 1))
    pairs = F.when(
        F.size("_keys") > 1,
        F.filter(F.sequence(F.lit(1), F.size("_keys") - 1), lambda i: high(here(i)) == high(before(i))),
    ).otherwise(F.array().cast("array<int>"))
    out = bind(out, {"_places": F.transform(pairs, lambda i: F.array(low(here(i)), low(before(i))))})
    same = lambda p: F.slice("words", F.get(p, 0) + 1, 3) == F.slice("words", F.get(p, 1) + 1, 3)
    starts = F.array_distinct(F.flatten(F.filter("_places", same)))
    covered = F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))
    out = bind(out, {"n_repeat_words": F.size(F.array_distinct(covered)).cast("long")})
    return out.drop("_lines", "_bits", "_keys", "_places")


def base_failed() -> Column:
    """Too short, or most of the words stand in repeated windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def default_rules(text: str = "text") -> list[Rule]:
    """Rules on the shape of a text; each rejects what prose of any language doesn't show."""
    body, chars = F.coalesce(F.col(text).cast("string"), F.lit("")), F.col("word_chars")
    return [
        Rule("symbols", F.col("n_symbols") * 5 > F.col("n_words")),
        Rule("word_length", (chars < F.col("n_words") * 2) | (chars > F.col("n_words") * 25)),
        Rule("repeated_lines", F.col("n_dup_lines") * 2 > F.col("n_lines")),
        Rule("shouting", F.regexp_count(body, F.lit(r"\p{Lu}")) * 2 > chars),
        Rule("few_letters", F.regexp_count(body, F.lit(r"\p{L}")) * 2 < chars),
    ]


def order_rules(docs: DataFrame, rules: Sequence[Rule]) -> list[tuple[Rule, float, float]]:
    """Rules by falling rejection per second, with the share rejected and the seconds of each.

    ``docs`` are measured; both figures are taken from its rows that pass the base rule, so it should
    be a small sample. They decide the order alone, never a verdict, as a document goes if
    any rule rejects it.
    """
    if len(rules) < 2:
        return [(r, 0.0, 0.0) for r in rules]
    sample = docs.persist()
    try:
        shares = sample.agg(
            *[F.avg((~base_failed() & r.rejects).cast("double")).alias(r.name) for r in rules]
        ).first()
        found = []
        for rule in rules:
            began = time.perf_counter()
            sample.agg(F.count_if(~base_failed() & rule.rejects)).first()
            found.append((rule, shares[rule.name] or 0.0, time.perf_counter() - began))
    finally:
        sample.unpersist()
    return sorted(found, key=lambda x: (-x[1] / max(x[2], 1e-6), x[0].name))


def cascade(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules aren't evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    return verdict


def apply_rules(
    docs: DataFrame, text: str = "text", rules: Sequence[Rule] | None = None, sample_rows: int = 500
) -> DataFrame:
    """Measure every text and judge it by the base rule, then by the cascade.

    Adds the counts of ``measured``, ``base_failed``, ``failed_rule`` (null where all pass or
    the base failed) and ``kept``. Rows are judged alone: repeated rows get the same verdict, an
    empty or null text fails the base rule, an empty table gives no rows. Input columns named
    like an added one are replaced.
    """
    rows = measured(docs, text)
    chosen = default_rules(text) if rules is None else list(rules)
    ordered = [r for r, _, _ in order_rules(measured(docs.limit(sample_rows), text), chosen)]
    rows = rows.withColumn("base_failed", base_failed())
    rows = rows.withColumn("failed_rule", F.when(~F.col("base_failed"), cascade(ordered)))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull()).drop("words")
