"""Edge cases of the text expressions."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from polyglint.functions import text as tx


def values(spark, rows, expr, schema="t string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_word_and_char_counts(spark):
    rows = ["", None, "  a  b ", "😀x", "a b c"]
    assert values(spark, rows, tx.word_count(F.col("t"))) == [0, 0, 2, 1, 3]
    assert values(spark, rows, tx.char_count(F.col("t"))) == [0, 0, 7, 2, 5]


def test_delimited_count(spark):
    assert values(spark, [None, "a", "a,b,"], tx.delimited_count(F.col("t"))) == [0, 1, 3]


def test_strip_and_blank(spark):
    rows = ["\n\t a b 　", " \n", None]
    assert values(spark, rows, tx.strip(F.col("t"))) == ["a b", "", None]
    assert values(spark, rows, tx.blank_to_null(F.col("t"))) == ["\n\t a b 　", None, None]


def test_numbers_go_only_when_standing_alone(spark):
    [out] = values(spark, ["abc 123 a1 ١٢ 12क 7ि x_9 9, ²"], tx.drop_numbers(F.col("t")))
    assert out.split() == ["abc", "a1", "12क", "ि", "x_9", ",", "²"]


def test_clean_chain(spark):
    text = "#Tag @user see https://x.y/z and www.z.org 😀 123 É A Über The हिन्दी"
    [out] = values(spark, [text], tx.clean_tokens(tx.nfc(F.col("t")), F.lit("de")))
    assert out == ["tag", "see", "Über", "हिन्दी"]


def test_cleaning_is_idempotent_on_latin_output(spark):
    [once] = values(spark, ["Ab #c-d @e 12 The Ärger f_g"], F.array_join(tx.clean_tokens(F.col("t"), F.lit("fr")), " "))
    [twice] = values(spark, [once], F.array_join(tx.clean_tokens(F.col("t"), F.lit("fr")), " "))
    assert once == twice


def test_composition(spark):
    assert values(spark, ["é", "plain", None], tx.nfc(F.col("t"))) == ["é", "plain", None]


def test_composition_of_long_texts_and_many_scripts_stays_in_the_jvm(spark):
    texts = ["e\u0301", "a\u0323\u0307", "a\u0307\u0323", "\u1100\u1161\u11a8", "\u0915\u093c", "\U0001d15e", "\u212b", "", "x" * 100_000 + "u\u0308", None]
    out = values(spark, texts, tx.nfc(F.col("t")))
    assert out == [None if t is None else unicodedata.normalize("NFC", t) for t in texts]
    plan = spark.range(1).select(tx.nfc(F.col("id").cast("string")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_stopwords_by_language(spark):
    rows = [("fr", "le chat the der x"), ("de", "le chat the der x"), (None, "le chat the der x")]
    out = values(spark, rows, tx.drop_stopwords(tx.words(F.col("t")), F.col("l")), "l string, t string")
    assert out == [["chat", "der"], ["le", "chat"], ["le", "chat", "der"]]


def test_supplied_stopwords_extend_to_other_languages(spark):
    table = {"en": ["the"], "te": ["లో"]}
    rows = [("te", "the లో తెలుగు"), ("hi", "the లో తెలుగు")]
    out = values(spark, rows, tx.drop_stopwords(tx.words(F.col("t")), F.col("l"), table), "l string, t string")
    assert out == [["తెలుగు"], ["లో", "తెలుగు"]]


@pytest.mark.parametrize(
    "text, lang",
    [("తె", None), ("తెల", "te"), ("हिन्दी", "hi"), ("తెల தமி", "te"), ("தமி తెల", "ta"), ("abc", None), (None, None)],
)
def test_script_language(spark, text, lang):
    assert values(spark, [text], tx.script_language(F.col("t"))) == [lang]


@pytest.mark.parametrize(
    "stored, text, lang",
    [("en-US", "", "en"), ("unknown", "తెలుగు", "te"), (None, "abc", "en"), ("", "abc", "en"), ("HI", "abc", "hi"), ("x", "", "x")],
)
def test_effective_language(spark, stored, text, lang):
    out = values(spark, [(stored, text)], tx.effective_language(F.col("s"), F.col("t")), "s string, t string")
    assert out == [lang]


def test_vector_tokens_cut_at_vowel_signs(spark):
    assert values(spark, ["Héllo हिन्दी a_1"], tx.vector_tokens(F.col("t"))) == [["héllo", "ह", "न", "द", "a_1"]]


def test_bigrams(spark):
    rows = ["a b c", "a", ""]
    out = values(spark, rows, tx.bigrams(tx.words(F.col("t"))))
    assert out == [["a b", "b c"], [], []]


def test_char_ngrams(spark):
    assert values(spark, ["ab"], tx.char_ngrams(F.col("t"))) == [["<ab", "ab>", "<ab>"]]
    [long] = values(spark, ["abcd"], tx.char_ngrams(F.col("t"), 3, 4))
    assert long == ["<ab", "abc", "bcd", "cd>", "<abc", "abcd", "bcd>"]


def test_lexical_diversity(spark):
    assert values(spark, ["a a b", "", None], tx.lexical_diversity(F.col("t"))) == [2 / 3, 0.0, 0.0]
