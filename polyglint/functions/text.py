"""Text expressions. Every function takes and returns Columns and stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import KEPT_RANGES, SCRIPT_BLOCKS, SCRIPT_MIN_CHARS, STOPWORDS

# Unicode blanks; Java's White_Space property lacks the four separators U+001C..U+001F.
BLANK = r"[\s\x1C-\x1F]"
# Word characters are letters, numbers and underscore: combining marks are not among them.
WORD = r"[\p{L}\p{N}_]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column expression named twice, or inside a lambda that runs per element, is otherwise
    computed at every mention.
    """
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Trim every kind of Unicode blank at both ends."""
    head = F.regexp_replace(text, F.lit(rf"(?U)^{BLANK}+"), F.lit(""))
    return F.regexp_replace(head, F.lit(rf"(?U){BLANK}+$"), F.lit(""))


def has_ink(text: Column) -> Column:
    """True when the text holds at least one non-blank character; null counts as blank."""
    return F.coalesce(text.rlike(r"(?U)[^\s\x1C-\x1F]"), F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.when(has_ink(text), text)


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def char_count(text: Column) -> Column:
    """Length in code points, 0 for null."""
    return F.length(or_empty(text))


def words(text: Column) -> Column:
    """Tokens between Unicode blanks; empty array for null or blank text."""
    parts = F.split(or_empty(text), rf"(?U){BLANK}+")
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def presence_flag(value: Column) -> Column:
    return value.isNotNull().cast("int")


def delimited_count(text: Column, sep: str = ",") -> Column:
    """Items in a delimited string, a trailing empty one included; null gives 0."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(F.split(text, rf"\Q{sep}\E", -1)))


def join_fields(*texts: Column) -> Column:
    """Fields joined by one blank each, nulls as empty strings, ends trimmed."""
    pieces: list[Column] = []
    for position, text in enumerate(texts):
        if position:
            pieces.append(F.lit(" "))
        pieces.append(or_empty(text))
    return strip(F.concat(*pieces))


def language_label(*candidates: Column) -> Column:
    """First non-null candidate, lower case, trimmed; ``unknown`` when all are null."""
    return strip(F.lower(F.coalesce(*candidates, F.lit("unknown"))))


def join_list(items: Column, sep: str = ",") -> Column:
    return F.coalesce(F.array_join(items, sep), F.lit(""))


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"[^\x00-\x7F]"), F.lit("?"))


def shorten(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def display_title(text: Column) -> Column:
    return F.initcap(text)


# --- cleaning steps -------------------------------------------------------------------------


def nfc(text: Column) -> Column:
    """Canonical composition, by the ICU library that Spark ships.

    Characters below U+0300 are always composed, so only texts holding a later one are normalised.
    """
    composed = F.call_function(
        "reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False)
    )
    return F.when(text.rlike(r"[^\x{0000}-\x{02FF}]"), composed).otherwise(text)


def _blanked(text: Column, pattern: str, by: str = " ") -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(by))


def drop_urls(text: Column) -> Column:
    ink = r"[^\s\x1C-\x1F]"
    return _blanked(text, rf"(?U)https?://{ink}+|www\.{ink}+")


def drop_astral(text: Column) -> Column:
    """Emoji and everything else beyond the basic plane."""
    return _blanked(text, r"[\x{10000}-\x{10FFFF}]")


def drop_mentions(text: Column) -> Column:
    return _blanked(text, rf"@{WORD}+")


def unwrap_hashtags(text: Column) -> Column:
    return _blanked(text, rf"#({WORD}+)", " $1 ")


def drop_symbols(text: Column) -> Column:
    """Keep word characters, blanks and the scripts of KEPT_RANGES."""
    kept = "".join(rf"\x{{{lo:04X}}}-\x{{{hi:04X}}}" for lo, hi in KEPT_RANGES)
    return _blanked(text, rf"(?U)[^\p{{L}}\p{{N}}_\s\x1C-\x1F{kept}]")


def drop_numbers(text: Column) -> Column:
    """Runs of decimal digits that no word character touches."""
    return _blanked(text, rf"(?<!{WORD})\p{{Nd}}+(?!{WORD})")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other capitals keep their form."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def drop_stopwords(
    tokens: Column, lang: Column, stopwords: Mapping[str, Sequence[str]] | None = None
) -> Column:
    """Remove the stopwords of the row's language and of English, and one-character tokens.

    The lists become two literal hash sets, so each token costs two probes whatever the
    number of languages, and no join or shuffle is needed.
    """
    table = STOPWORDS if stopwords is None else stopwords
    english = sorted(table.get("en", ()))
    keyed = sorted(f"{code} {w}" for code, ws in table.items() if code != "en" for w in ws)

    def keep(token: Column, code: Column) -> Column:
        ok = F.length(token) > 1
        if english:
            ok = ok & ~token.isin(english)
        if keyed:
            ok = ok & ~F.concat(code, F.lit(" "), token).isin(keyed)
        return ok

    row = F.struct(or_empty(lang).alias("code"), tokens.alias("tokens"))
    return let(row, lambda r: F.filter(r["tokens"], lambda w: keep(w, r["code"])))


def stopword_set(lang: Column, stopwords: Mapping[str, Sequence[str]] | None = None) -> Column:
    """The union of English and the row language's stopwords as an array."""
    table = STOPWORDS if stopwords is None else stopwords

    def literal(items: Sequence[str]) -> Column:
        return F.array(*[F.lit(w) for w in items]).cast("array<string>")

    english = literal(table.get("en", ()))
    own = F.lit(None).cast("array<string>")
    for code, items in table.items():
        own = F.when(lang == code, literal(items)).otherwise(own)
    return F.array_distinct(F.array_union(F.coalesce(own, literal(())), english))


def strip_noise(text: Column) -> Column:
    """All character-level cleaning after composition, in order."""
    steps = (
        drop_urls,
        drop_astral,
        drop_mentions,
        unwrap_hashtags,
        drop_symbols,
        drop_numbers,
        lower_ascii,
    )
    return reduce(lambda col, step: step(col), steps, text)


def clean_tokens(
    text: Column, lang: Column, stopwords: Mapping[str, Sequence[str]] | None = None
) -> Column:
    """Token array of the full cleaning chain for text already in composed form."""
    return drop_stopwords(words(strip_noise(or_empty(text))), lang, stopwords)


# --- language -------------------------------------------------------------------------------


def script_language(text: Column) -> Column:
    """Language of the Indic script with most characters, null below SCRIPT_MIN_CHARS.

    Equal counts go to the script seen first in the text.
    """

    def best(body: Column) -> Column:
        scored = []
        for code, (lo, hi) in SCRIPT_BLOCKS.items():
            block = rf"[\x{{{lo:04X}}}-\x{{{hi:04X}}}]"
            hits = F.length(body) - F.length(F.regexp_replace(body, F.lit(block), F.lit("")))
            first = F.regexp_instr(body, F.lit(block))
            scored.append(
                F.struct(hits.alias("hits"), (-first).alias("early"), F.lit(code).alias("lang"))
            )
        return F.greatest(*scored)

    def decide(body: Column) -> Column:
        winner = let(best(body), lambda b: F.when(b["hits"] >= SCRIPT_MIN_CHARS, b["lang"]))
        return F.when(body.rlike(r"[\x{0900}-\x{0D7F}]"), winner)

    return let(or_empty(text), decide)


def effective_language(stored: Column, text: Column, default: str = "en") -> Column:
    """Two-letter stored language; unknown ones fall back to the script, then ``default``.

    A null stored language is treated as unknown.
    """
    code = F.substring(strip(F.lower(or_empty(stored))), 1, 2)
    known = ~code.isin("un", "")
    return F.when(known, code).otherwise(F.coalesce(script_language(text), F.lit(default)))


# --- lexical features -----------------------------------------------------------------------


def unique_word_count(text: Column) -> Column:
    return F.size(F.array_distinct(words(text)))


def lexical_diversity(text: Column) -> Column:
    return let(words(text), token_diversity)


def token_diversity(tokens: Column) -> Column:
    """Distinct share of the tokens, 0 for none."""
    distinct = F.size(F.array_distinct(tokens))
    return F.when(F.size(tokens) > 0, distinct / F.size(tokens)).otherwise(F.lit(0.0))


def vector_tokens(text: Column) -> Column:
    """Lower-cased runs of word characters, the vectoriser's own tokens."""
    return F.regexp_extract_all(F.lower(or_empty(text)), F.lit(rf"({WORD}+)"), F.lit(1))


def bigrams(tokens: Column) -> Column:
    """Neighbouring token pairs joined by a blank."""
    return let(tokens, _pairs)


def uni_and_bigrams(tokens: Column) -> Column:
    return let(tokens, lambda ts: F.concat(ts, _pairs(ts)))


def _pairs(tokens: Column) -> Column:
    last = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), last), F.slice(tokens, F.lit(2), last),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def char_ngrams(token: Column, low: int = 3, high: int = 6) -> Column:
    """Character n-grams of ``<token>`` with boundary marks, low to high characters long."""

    def grams(marked: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(marked) - (n - 1))
        cut = F.transform(starts, lambda i: marked.substr(i, F.lit(n)))
        return F.when(F.length(marked) >= n, cut).otherwise(F.array().cast("array<string>"))

    return let(
        F.concat(F.lit("<"), token, F.lit(">")),
        lambda marked: F.concat(*[grams(marked, n) for n in range(low, high + 1)]),
    )
