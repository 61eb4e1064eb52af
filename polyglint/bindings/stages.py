"""The whole chain on the documents table, each document read as one published record."""

from pyspark.sql import functions as F

from ..functions.fixed_values import DAY_NAMES
from ..plans import dashboard as db
from ..plans import stages as st
from ..session import scratch_path
from ..sources import files
from .aggregates import rounded, tier_sql
from .registry import Tables, query
from .scalars import _WORDS_SQL, human_sql
from .texts import chain_sql

_COUNTS = {"view_count": "n_chars", "like_count": "e", "comment_count": "a"}


def _letters(c):
    return (F.length("text") - F.length(F.replace(F.col("text"), F.lit(c)))).cast("bigint")


def records(t: Tables):
    """title: first sentence; description: the text after it; counts: characters and letters."""
    cut = F.instr(F.col("text"), ".")
    title = F.when(cut > 0, F.substring(F.col("text"), F.lit(1), cut)).otherwise(F.col("text"))
    views, likes, comments = F.col("n_chars"), _letters("e"), _letters("a")
    moment = F.timestamp_add("HOUR", (F.col("doc_id") * 7).cast("int"), F.to_timestamp(F.lit("2018-01-01 00:00:00")))
    rows = t.documents.select(
        F.col("doc_id").alias("video_id"), F.col("source").alias("channel_id"), title.alias("title"),
        F.when(cut > 0, F.substring(F.col("text"), cut + 1, F.length("text"))).otherwise("").alias("description"),
        F.when(F.col("lang") == "en", "").otherwise(F.concat("lang", F.lit(","), "source")).alias("tags"),
        F.when(F.col("lang") != "fr", F.concat(F.lit(" "), F.upper("lang"))).otherwise("").alias("default_language"),
        F.lit("").alias("default_audio_language"), F.lit(None).cast("string").alias("topic_ids"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        views.alias("view_count"), likes.alias("like_count"), comments.alias("comment_count"),
        (likes / views).alias("like_view_ratio"), ((likes + comments) / views).alias("engagement_score"),
    )
    return rows.withColumn("upload_hour", F.hour(F.to_timestamp("published_at"))).withColumn(
        "upload_day_of_week", F.weekday(F.to_timestamp("published_at"))
    )


_RAW_SQL = """raw AS (SELECT doc_id AS video_id, lang, source,
    CASE WHEN strpos(text, '.') > 0 THEN substring(text, 1, strpos(text, '.')) ELSE text END AS title,
    CASE WHEN strpos(text, '.') > 0 THEN substring(text, strpos(text, '.') + 1) ELSE '' END AS description,
    CASE WHEN lang = 'en' THEN NULL ELSE lang || ',' || source END AS tags,
    CASE WHEN lang = 'fr' THEN 'unknown' ELSE lang END AS language,
    TIMESTAMP '2018-01-01' + to_hours(doc_id * 7) AS published,
    n_chars AS view_count, length(text) - length(replace(text, 'e', '')) AS like_count,
    length(text) - length(replace(text, 'a', '')) AS comment_count FROM documents),
  base AS (SELECT *, CASE WHEN view_count > 0 THEN like_count / view_count ELSE 0 END AS like_view_ratio,
    CASE WHEN view_count > 0 THEN (like_count + comment_count) / view_count ELSE 0 END AS engagement_score FROM raw)"""

_SENT, _TIER = ("negative", "neutral", "positive"), ("low", "medium", "high")

_FEATURES_SQL = rf"""WITH {_RAW_SQL}, features AS (SELECT *,
    CAST(length(title) AS INTEGER) AS title_length, CAST({_WORDS_SQL.format('title')} AS INTEGER) AS title_word_count,
    CASE WHEN regexp_matches(description, '\S') THEN 1 ELSE 0 END AS has_description,
    CAST({_WORDS_SQL.format('description')} AS INTEGER) AS desc_word_count,
    CASE WHEN tags IS NULL THEN 0 ELSE 1 END AS has_tags, CASE WHEN tags IS NULL THEN 0 ELSE 2 END AS tag_count,
    regexp_replace(regexp_replace(title || ' ' || CASE WHEN regexp_matches(description, '\S') THEN description ELSE '' END
      || ' ' || coalesce(tags, ''), '^\s+', ''), '\s+$', '') AS combined_text,
    CAST(year(published) AS INTEGER) AS publish_year, CAST(month(published) AS INTEGER) AS publish_month,
    {tier_sql('like_view_ratio', _SENT, 'base')} AS sentiment_label,
    {tier_sql('engagement_score', _TIER, 'base')} AS engagement_tier FROM base)"""

_FEATURE_COLS = """video_id, title_length, title_word_count, has_description, desc_word_count, has_tags, tag_count,
  md5(combined_text) AS text_hash, language, publish_year, publish_month, sentiment_label, engagement_tier"""


@query("stage_features", f"{_FEATURES_SQL} SELECT {_FEATURE_COLS} FROM features")
def _(t: Tables):
    cols = [c.strip() for c in _FEATURE_COLS.split(",")]
    return st.feature_stage(records(t)).selectExpr(*cols)


# The stored language is unknown for French records only, whose script is Latin: they become English.
_CLEAN_SQL = f"""{_FEATURES_SQL}, clean AS (SELECT * FROM (SELECT *, CASE WHEN language = 'unknown' THEN 'en' ELSE language END AS eff_lang,
    {chain_sql('combined_text').replace('CASE lang ', 'CASE language ').replace("WHEN 'fr'", "WHEN 'zz'")} AS toks FROM features) WHERE len(toks) >= 2)"""


@query(
    "stage_clean",
    f"""{_CLEAN_SQL} SELECT video_id, eff_lang, array_to_string(toks, ' ') AS clean_text,
        CAST(len(toks) AS INTEGER) AS clean_word_count FROM clean""",
)
def _(t: Tables):
    clean = st.clean_stage(st.feature_stage(records(t)))
    return clean.select("video_id", "eff_lang", "clean_text", "clean_word_count")


def _board(t: Tables):
    """The dashboard frame, narrowed to two labels and three years."""
    path = scratch_path(t.spark, "dashboard")
    features = st.feature_stage(records(t)).withColumn("eff_lang", F.substring("language", 1, 2))
    files.write_parquet(st.dashboard_stage(features), path)
    d = files.read_parquet(t.spark, path)
    return db.select(d, sentiments=["positive", "negative"], years=(2018, 2020))


_BOARD_SQL = f"""{_FEATURES_SQL}, d AS (SELECT * REPLACE (CAST(engagement_score AS FLOAT) AS engagement_score),
    left(language, 2) AS lang_clean FROM features
    WHERE publish_year BETWEEN 2018 AND 2020 AND sentiment_label IN ('positive', 'negative'))"""


@query(
    "dashboard_kpis",
    f"""{_BOARD_SQL} SELECT count(*) AS total, count(DISTINCT lang_clean) AS categories, CAST(sum(view_count) AS BIGINT) AS views_sum,
        round(avg(view_count), 6) AS views_mean, CAST(sum(like_count) AS BIGINT) AS likes_sum, round(avg(like_count), 6) AS likes_mean,
        round(avg(engagement_score), 6) AS score_mean, round(quantile_cont(engagement_score::DOUBLE, 0.5), 6) AS score_median,
        round(100 * avg((sentiment_label = 'positive')::INT), 6) AS positive_pct,
        round(100 * avg((sentiment_label = 'negative')::INT), 6) AS negative_pct,
        round(100 * avg(has_description), 6) AS has_description_pct, round(100 * avg(has_tags), 6) AS has_tags_pct FROM d""",
)
def _(t: Tables):
    block = db.kpis(_board(t))
    exact = {"total", "categories", "views_sum", "likes_sum"}
    return rounded(block, *[c for c in block.columns if c not in exact])


@query(
    "dashboard_language_mix",
    f"""{_BOARD_SQL} SELECT lang_clean, {', '.join(f"round(100.0 * count(*) FILTER (sentiment_label = '{v}') / count(*), 6) AS {v}" for v in db.LABELS)},
        count(*) AS group_size FROM d GROUP BY lang_clean""",
)
def _(t: Tables):
    return rounded(db.language_sentiment_mix(_board(t)), *db.LABELS)


@query(
    "dashboard_top_videos",
    f"""{_BOARD_SQL} SELECT substring(title, 1, 60) AS "Title", lang_clean AS "Language", {human_sql('view_count')} AS "View Count",
        {human_sql('like_count')} AS "Like Count", {human_sql('comment_count')} AS "Comment Count",
        upper(left(sentiment_label, 1)) || substring(sentiment_label, 2) AS "Sentiment" FROM d ORDER BY view_count DESC, video_id LIMIT 10""",
)
def _(t: Tables):
    return db.top_videos(_board(t))


@query(
    "dashboard_average_views",
    f"""{_BOARD_SQL} SELECT lang_clean, round(avg(view_count), 6) AS avg_views, round(avg(like_count), 6) AS avg_likes,
        count(*) AS video_count FROM d GROUP BY lang_clean ORDER BY 2""",
)
def _(t: Tables):
    return rounded(db.average_views(_board(t)).drop("text"), "avg_views", "avg_likes")


@query(
    "dashboard_monthly_trend",
    f"""{_BOARD_SQL} SELECT CAST(date_trunc('month', published) AS DATE) AS month, sentiment_label, count(*) AS count FROM d GROUP BY 1, 2""",
)
def _(t: Tables):
    return db.monthly_trend(_board(t))


# --- the other blocks -----------------------------------------------------------------------


@query(
    "dashboard_content",
    f"""{_BOARD_SQL}, s AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(title_length) AS a, avg(title_word_count) AS b, avg(view_count) AS c,
        avg(like_count) AS e, avg(comment_count) AS f, 100 * avg(has_description) AS g, 100 * avg(has_tags) AS h FROM d)
        SELECT 'count' AS metric, n AS value FROM s UNION ALL SELECT 'avg_title_length', round(a, 6) FROM s
        UNION ALL SELECT 'avg_word_count', round(b, 6) FROM s UNION ALL SELECT 'avg_views', round(c, 6) FROM s
        UNION ALL SELECT 'avg_likes', round(e, 6) FROM s UNION ALL SELECT 'avg_comments', round(f, 6) FROM s
        UNION ALL SELECT 'has_description_pct', round(g, 6) FROM s UNION ALL SELECT 'has_tags_pct', round(h, 6) FROM s""",
)
def _(t: Tables):
    return rounded(db.content(_board(t)), "value")


@query(
    "dashboard_language_bar",
    f"""{_BOARD_SQL}, c AS (SELECT lang_clean, count(*) AS count FROM d GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)
        SELECT lang_clean, count, round(100.0 * count / (SELECT sum(count) FROM c), 1) AS pct FROM c""",
)
def _(t: Tables):
    return db.language_bar(_board(t))


@query(
    "dashboard_sentiment_donut",
    f"""{_BOARD_SQL} SELECT sentiment_label, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM d), 6) AS pct,
        upper(left(sentiment_label, 1)) || substring(sentiment_label, 2) AS label FROM d GROUP BY sentiment_label""",
)
def _(t: Tables):
    return rounded(db.sentiment_donut(_board(t)), "pct")


@query(
    "dashboard_engagement_scatter",
    f"""{_BOARD_SQL} SELECT video_id, round(log10(greatest(view_count, 1)), 6) AS views_log, round(log10(greatest(like_count, 1)), 6) AS likes_log,
        sentiment_label, title, view_count, like_count, lang_clean FROM d
        ORDER BY md5(CAST(video_id AS VARCHAR) || ':42') LIMIT 8000""",
)
def _(t: Tables):
    return rounded(db.engagement_scatter(_board(t)), "views_log", "likes_log")


@query(
    "dashboard_engagement_violin",
    f"""{_BOARD_SQL}, k AS (SELECT lang_clean, CAST(engagement_score AS DOUBLE) AS v FROM d WHERE lang_clean IN
          (SELECT lang_clean FROM d GROUP BY lang_clean ORDER BY count(*) DESC, lang_clean LIMIT 10)),
        q AS (SELECT lang_clean, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM k GROUP BY 1),
        b AS (SELECT *, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM k JOIN q USING (lang_clean))
        SELECT lang_clean, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
        round(min(v) FILTER (inside), 6) AS whisker_low, round(max(v) FILTER (inside), 6) AS whisker_high,
        count(*) FILTER (NOT inside) AS outliers, count(*) AS n FROM b GROUP BY lang_clean, q1, median, q3""",
)
def _(t: Tables):
    return rounded(db.engagement_violin(_board(t))[0], "q1", "median", "q3", "whisker_low", "whisker_high")


@query(
    "dashboard_upload_heatmap",
    f"""{_BOARD_SQL} SELECT CAST(hour(published) AS INTEGER) AS upload_hour, """
    + ", ".join(f'count(*) FILTER (isodow(published) = {i + 1}) AS "{name}"' for i, name in enumerate(DAY_NAMES))
    + " FROM d GROUP BY 1",
)
def _(t: Tables):
    return db.upload_heatmap(_board(t))


@query(
    "dashboard_title_length",
    f"""{_BOARD_SQL}, x AS (SELECT sentiment_label, CAST(title_length AS DOUBLE) AS x FROM d), e AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
        b AS (SELECT sentiment_label, CAST(least(floor((x - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, lo, (hi - lo) / 50 AS w FROM x, e)
        SELECT sentiment_label, bin, round(min(lo) + bin * min(w), 6) AS bin_start, round(min(lo) + (bin + 1) * min(w), 6) AS bin_end,
        count(*) AS count FROM b GROUP BY sentiment_label, bin""",
)
def _(t: Tables):
    return rounded(db.title_length_histogram(_board(t)), "bin_start", "bin_end")


@query(
    "dashboard_yearly_growth",
    f"""{_BOARD_SQL}, c AS (SELECT publish_year, count(*) AS count FROM d WHERE publish_year BETWEEN 2015 AND 2026 GROUP BY 1)
        SELECT publish_year, count, round((count / lag(count) OVER (ORDER BY publish_year) - 1) * 100, 6) AS growth FROM c""",
)
def _(t: Tables):
    return rounded(db.yearly_growth(_board(t)), "growth")


@query(
    "dashboard_language_treemap",
    f"""{_BOARD_SQL} SELECT lang_clean AS name, 'Languages' AS parent, count(*) AS size FROM d
        GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 20""",
)
def _(t: Tables):
    return db.language_treemap(_board(t))


@query(
    "dashboard_weekday_bar",
    f"""{_BOARD_SQL} SELECT CAST(isodow(published) - 1 AS INTEGER) AS upload_day_of_week, count(*) AS count,
        ({DAY_NAMES})[isodow(published)] AS day_name FROM d GROUP BY ALL""",
)
def _(t: Tables):
    return db.weekday_bar(_board(t))
