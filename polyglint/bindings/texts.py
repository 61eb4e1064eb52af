"""Cleaning chain, tokens, languages and term weights on the sample documents.

The corpus is Latin text without emoji, hashtags or composed marks, so several queries first
derive such text from it, in Spark and in SQL alike.
"""

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.fixed_values import STOPWORDS
from ..operators import features as ft
from ..operators import filters as flt
from ..operators import joins as jn
from .registry import Tables, query
from .scalars import r6

_W = r"[\p{L}\p{N}_]"
_KEPT = r"\x{0900}-\x{0DFF}\x{4E00}-\x{9FFF}\x{3040}-\x{30FF}\x{0600}-\x{06FF}"


def _hashed(col):
    return F.md5(col).alias("text_hash")


# Every document wrapped in the noise the cleaning steps remove.
_NOISY_SQL = """('#' || source || ' see https://ex.am/' || doc_id || '?q=1 ' || text || ' @' || lang || '_user www.site.org/'
  || n_chars || ' 😀 ' || n_chars || ' ÉTÉ हिन्दी १२ x9 ' || doc_id)"""


def noisy(t: Tables):
    c = F.col
    return t.documents.withColumn(
        "noisy",
        F.concat(
            F.lit("#"), c("source"), F.lit(" see https://ex.am/"), c("doc_id"), F.lit("?q=1 "), c("text"),
            F.lit(" @"), c("lang"), F.lit("_user www.site.org/"), c("n_chars"), F.lit(" 😀 "), c("n_chars"),
            F.lit(" ÉTÉ हिन्दी १२ x9 "), c("doc_id"),
        ),
    )


def _sub(text, pattern, by=" "):
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


SQL_STEPS = {
    "urls": lambda x: _sub(x, r"https?://\S+|www\.\S+"),
    "astral": lambda x: _sub(x, r"[\x{10000}-\x{10FFFF}]"),
    "mentions": lambda x: _sub(x, f"@{_W}+"),
    "hashtags": lambda x: _sub(x, f"#({_W}+)", r" \1 "),
    "symbols": lambda x: _sub(x, rf"[^\p{{L}}\p{{N}}_\s{_KEPT}]"),
    "numbers": lambda x: f"""array_to_string([CASE WHEN regexp_full_match(w, '\\p{{Nd}}+') THEN ' ' ELSE w END
        for w in regexp_extract_all({x}, '{_W}+|[^\\p{{L}}\\p{{N}}_]+')], '')""",
    "lower": lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
}


def _step(name, step, sql_step):
    @query(name, f"SELECT doc_id, md5({SQL_STEPS[sql_step](_NOISY_SQL)}) AS text_hash FROM documents")
    def _(t: Tables):
        return noisy(t).select("doc_id", _hashed(step(F.col("noisy"))))


_step("tx2_drop_urls", tx.drop_urls, "urls")
_step("tx3_drop_astral", tx.drop_astral, "astral")
_step("tx4_drop_mentions", tx.drop_mentions, "mentions")
_step("tx5_unwrap_hashtags", tx.unwrap_hashtags, "hashtags")
_step("tx6_drop_symbols", tx.drop_symbols, "symbols")
_step("tx7_drop_numbers", tx.drop_numbers, "numbers")
_step("tx8_lower_ascii", tx.lower_ascii, "lower")

_DECOMPOSED_SQL = "replace(replace(text, 'e', 'e' || chr(769)), 'u', 'u' || chr(776))"


@query("tx1_nfc", f"SELECT doc_id, md5(nfc_normalize({_DECOMPOSED_SQL})) AS text_hash FROM documents")
def _(t: Tables):
    text = F.replace(F.col("text"), F.lit("e"), F.lit("é"))
    text = F.replace(text, F.lit("u"), F.lit("ü"))
    return t.documents.select("doc_id", _hashed(tx.nfc(text)))


def words_sql(x):
    return rf"[w for w in regexp_split_to_array({x}, '\s+') if w <> '']"


@query("tx9_tokens", f"SELECT doc_id, array_to_string({words_sql('text')}, '|') AS tokens FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", F.array_join(tx.words(F.col("text")), "|").alias("tokens"))


def _list_sql(items):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in items) + "]"


_STOP_SQL = (
    "CASE lang "
    + " ".join(f"WHEN '{c}' THEN {_list_sql(ws)}" for c, ws in STOPWORDS.items() if c != "en")
    + " ELSE ['the'] END"
)


def kept_sql(tokens):
    return f"""[w for w in {tokens} if length(w) > 1 AND NOT list_contains({_list_sql(STOPWORDS['en'])}, w)
      AND NOT list_contains({_STOP_SQL}, w)]"""


@query("tx10_drop_stopwords", f"SELECT doc_id, array_to_string({kept_sql(words_sql('text'))}, '|') AS tokens FROM documents")
def _(t: Tables):
    kept = tx.drop_stopwords(tx.words(F.col("text")), F.col("lang"))
    return t.documents.select("doc_id", F.array_join(kept, "|").alias("tokens"))


def _stop_table(t: Tables):
    rows = [(c, w) for c, ws in STOPWORDS.items() for w in ws]
    return t.spark.createDataFrame(rows, "lang string, word string")


@query(
    "j3_stopword_antijoin",
    f"""SELECT doc_id, count(*) AS kept, md5(string_agg(w, ' ' ORDER BY w)) AS token_hash FROM (
        SELECT doc_id, unnest({kept_sql(words_sql('text'))}) AS w FROM documents) GROUP BY doc_id""",
)
def _(t: Tables):
    long = jn.stopword_antijoin(t.documents, tx.words(F.col("text")), "lang", "doc_id", _stop_table(t))
    return long.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("kept"),
        F.md5(F.array_join(F.array_sort(F.collect_list("token")), " ")).alias("token_hash"),
    )


@query(
    "x1_stopword_union",
    f"""SELECT doc_id, CAST(len(list_distinct(list_concat({_list_sql(STOPWORDS['en'])}, {_STOP_SQL}))) AS INTEGER) AS words
        FROM documents""",
)
def _(t: Tables):
    return t.documents.select("doc_id", F.size(tx.stopword_set(F.col("lang"))).alias("words"))


# The documents once more in each of the languages in turn: some of the language's own words and
# of the next one's among the document's text.
_CODES = list(STOPWORDS)
_MIXED = {c: " ".join([*STOPWORDS[c][:6], *STOPWORDS[_CODES[(i + 1) % len(_CODES)]][:4]]) for i, c in enumerate(_CODES)}
_MULTILINGUAL_SQL = (
    "(SELECT doc_id, CASE doc_id % 21 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CODES)) + " END AS lang, "
    "text || ' ' || CASE doc_id % 21 " + " ".join(f"WHEN {i} THEN '{_MIXED[c]}'" for i, c in enumerate(_CODES)) + " END AS text FROM documents)"
)


def multilingual(t: Tables):
    at = (F.col("doc_id") % 21 + 1).cast("int")
    code = F.element_at(F.array(*[F.lit(c) for c in _CODES]), at)
    words = F.element_at(F.array(*[F.lit(_MIXED[c]) for c in _CODES]), at)
    return t.documents.select("doc_id", code.alias("lang"), F.concat_ws(" ", "text", words).alias("text"))


@query(
    "tx10_stopwords_of_all_languages",
    f"SELECT doc_id, lang, array_to_string({kept_sql(words_sql('text'))}, '|') AS tokens FROM {_MULTILINGUAL_SQL}",
)
def _(t: Tables):
    kept = tx.drop_stopwords(tx.words(F.col("text")), F.col("lang"))
    return multilingual(t).select("doc_id", "lang", F.array_join(kept, "|").alias("tokens"))


@query(
    "j3_antijoin_of_all_languages",
    f"""SELECT doc_id, count(*) AS kept, md5(string_agg(w, ' ' ORDER BY w)) AS token_hash FROM (
        SELECT doc_id, unnest({kept_sql(words_sql('text'))}) AS w FROM {_MULTILINGUAL_SQL}) GROUP BY doc_id""",
)
def _(t: Tables):
    long = jn.stopword_antijoin(multilingual(t), tx.words(F.col("text")), "lang", "doc_id", _stop_table(t))
    return long.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("kept"),
        F.md5(F.array_join(F.array_sort(F.collect_list("token")), " ")).alias("token_hash"),
    )


@query(
    "x1_union_of_all_languages",
    f"""SELECT doc_id, lang, CAST(len(list_distinct(list_concat({_list_sql(STOPWORDS['en'])}, {_STOP_SQL}))) AS INTEGER) AS words
        FROM {_MULTILINGUAL_SQL}""",
)
def _(t: Tables):
    return multilingual(t).select("doc_id", "lang", F.size(tx.stopword_set(F.col("lang"))).alias("words"))


def chain_sql(text):
    x = f"nfc_normalize({text})"
    for step in SQL_STEPS.values():
        x = step(x)
    return kept_sql(words_sql(x))


_CLEAN_SQL = f"SELECT doc_id, lang, {chain_sql(_NOISY_SQL)} AS toks FROM documents"


@query("tx11_clean_text", f"SELECT doc_id, array_to_string(toks, ' ') AS clean_text FROM ({_CLEAN_SQL})")
def _(t: Tables):
    tokens = tx.clean_tokens(tx.nfc(F.col("noisy")), F.col("lang"))
    return noisy(t).select("doc_id", F.array_join(tokens, " ").alias("clean_text"))


@query(
    "tx11_clean_text_of_all_languages",
    f"SELECT doc_id, array_to_string({chain_sql('text')}, ' ') AS clean_text FROM {_MULTILINGUAL_SQL}",
)
def _(t: Tables):
    tokens = tx.clean_tokens(tx.nfc(F.col("text")), F.col("lang"))
    return multilingual(t).select("doc_id", F.array_join(tokens, " ").alias("clean_text"))


# Latin vowels written in Indic letters, a different script per language; Spanish mixes two.
_SCRIPTS = {"fr": ("aeo", "అఎఒ"), "de": ("aeo", "அஎஒ"), "es": ("aeo", "অઅও")}
_SCRIPT_SQL = (
    "CASE lang "
    + " ".join(f"WHEN '{c}' THEN translate(text, '{a}', '{b}')" for c, (a, b) in _SCRIPTS.items())
    + " ELSE text END"
)


def scripted(t: Tables):
    text = F.col("text")
    for code, (a, b) in _SCRIPTS.items():
        text = F.when(F.col("lang") == code, F.translate("text", a, b)).otherwise(text)
    return t.documents.withColumn("scripted", text)


def _block_sql(lo, hi):
    return rf"(length(x) - length(regexp_replace(x, '[\x{{{lo}}}-\x{{{hi}}}]', '', 'g')))"


_DETECT_SQL = f"""SELECT doc_id, lang, x, CASE
    WHEN greatest(te, ta, bn, gu) < 3 THEN NULL
    WHEN te = greatest(te, ta, bn, gu) THEN 'te' WHEN ta = greatest(te, ta, bn, gu) THEN 'ta'
    WHEN bn > gu OR (bn = gu AND least(nullif(strpos(x, 'অ'), 0), nullif(strpos(x, 'ও'), 0)) < strpos(x, 'અ')) THEN 'bn'
    ELSE 'gu' END AS script FROM (
  SELECT *, {_block_sql('0C00', '0C7F')} AS te, {_block_sql('0B80', '0BFF')} AS ta,
    {_block_sql('0980', '09FF')} AS bn, {_block_sql('0A80', '0AFF')} AS gu
  FROM (SELECT doc_id, lang, {_SCRIPT_SQL} AS x FROM documents))"""


@query("tx12_script_language", f"SELECT doc_id, script FROM ({_DETECT_SQL})")
def _(t: Tables):
    return scripted(t).select("doc_id", tx.script_language(F.col("scripted")).alias("script"))


@query(
    "tx13_effective_language",
    f"""SELECT doc_id, CASE WHEN lang = 'de' THEN 'de' ELSE coalesce(script, 'en') END AS eff_lang FROM ({_DETECT_SQL})""",
)
def _(t: Tables):
    stored = (
        F.when(F.col("lang") == "de", F.lit(" DE-at")).when(F.col("lang") == "es", F.lit("unknown"))
        .when(F.col("lang") == "fr", F.lit(""))
    )
    return scripted(t).select("doc_id", tx.effective_language(stored, F.col("scripted")).alias("eff_lang"))


@query(
    "tx14_lexical_features",
    f"""SELECT doc_id, CAST(len(toks) AS INTEGER) AS clean_word_count,
        CAST(length(array_to_string(toks, ' ')) AS INTEGER) AS clean_char_count,
        CAST(len(list_distinct(toks)) AS INTEGER) AS unique_word_count,
        round(CASE WHEN len(toks) > 0 THEN len(list_distinct(toks)) / len(toks) ELSE 0 END, 6) AS lexical_diversity
        FROM ({_CLEAN_SQL})""",
)
def _(t: Tables):
    tokens = tx.clean_tokens(tx.nfc(F.col("noisy")), F.col("lang"))
    clean = noisy(t).select("doc_id", F.array_join(tokens, " ").alias("clean"))
    c = F.col("clean")
    return clean.select(
        "doc_id", tx.word_count(c).alias("clean_word_count"), tx.char_count(c).alias("clean_char_count"),
        tx.unique_word_count(c).alias("unique_word_count"), r6(tx.lexical_diversity(c)).alias("lexical_diversity"),
    )


@query("x2_distinct_tokens", f"SELECT doc_id, CAST(len(list_distinct({words_sql('text')})) AS INTEGER) AS n FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", tx.unique_word_count(F.col("text")).alias("n"))


def vec_tokens_sql(x):
    return f"regexp_extract_all(lower({x}), '{_W}+')"


@query("tx15_vector_tokens", f"SELECT doc_id, array_to_string({vec_tokens_sql('text')}, '|') AS tokens FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", F.array_join(tx.vector_tokens(F.col("text")), "|").alias("tokens"))


_TERMS_SQL = f"""WITH d AS (SELECT doc_id, {vec_tokens_sql('text')} AS toks FROM documents),
  u AS (SELECT doc_id, unnest(toks) AS w, generate_subscripts(toks, 1) AS i FROM d),
  g AS (SELECT doc_id, w AS term FROM u UNION ALL
        SELECT a.doc_id, a.w || ' ' || b.w FROM u a JOIN u b ON a.doc_id = b.doc_id AND b.i = a.i + 1)"""


@query(
    "tx16_uni_and_bigrams",
    f"{_TERMS_SQL} SELECT term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM g GROUP BY term",
)
def _(t: Tables):
    terms = tx.uni_and_bigrams(tx.vector_tokens(F.col("text")))
    totals = ft.term_totals(t.documents, "doc_id", "text", terms)
    return totals.select("term", F.col("total").alias("n"), F.col("df").alias("docs"))


_VOCAB_SQL = f"""{_TERMS_SQL}, c AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL),
  n AS (SELECT count(*) AS n FROM documents),
  v AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM c GROUP BY term
        HAVING count(*) >= 2 AND count(*) <= 0.95 * (SELECT n FROM n) ORDER BY total DESC, term LIMIT 8000)"""


@query("t7_vocabulary", f"{_VOCAB_SQL} SELECT term, df, total FROM v")
def _(t: Tables):
    return ft.tfidf_vocabulary(t.documents, "doc_id", "text")


_TFIDF_SQL = f"""{_VOCAB_SQL}, r AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((n + 1.0) / (df + 1.0)) + 1) AS w
    FROM c JOIN v USING (term), n)
  SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM r"""


@query("e1_tfidf_long", _TFIDF_SQL)
def _(t: Tables):
    long = ft.tfidf_long(t.documents, "doc_id", "text")
    return long.select("doc_id", "term", r6(F.col("weight")).alias("weight"))


@query(
    "e6_matrix_report",
    f"""SELECT (SELECT count(*) FROM documents) AS docs, count(DISTINCT term) AS terms, count(*) AS nonzero,
        round(count(*) / ((SELECT count(*) FROM documents) * count(DISTINCT term)), 9) AS density
        FROM ({_TFIDF_SQL})""",
)
def _(t: Tables):
    long = ft.tfidf_long(t.documents, "doc_id", "text")
    report = ft.density_report(long, "doc_id", t.documents.agg(F.count(F.lit(1))).scalar())
    return report.withColumn("density", F.round("density", 9))


@query(
    "e6_vocabulary_size",
    f"SELECT count(DISTINCT w) AS vocabulary FROM (SELECT unnest({words_sql('text')}) AS w FROM documents)",
)
def _(t: Tables):
    return ft.vocabulary_size(t.documents, tx.words(F.col("text")))


@query(
    "f2_keep_min_tokens",
    f"SELECT doc_id, CAST(len(toks) AS INTEGER) AS n FROM ({_CLEAN_SQL}) WHERE len(toks) >= 20",
)
def _(t: Tables):
    tokens = tx.clean_tokens(tx.nfc(F.col("noisy")), F.col("lang"))
    counted = noisy(t).select("doc_id", F.size(tokens).alias("n"))
    return flt.keep_min_tokens(counted, "n", 20)
