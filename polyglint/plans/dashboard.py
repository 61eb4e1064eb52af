"""One function per dashboard block, over a frame narrowed by ``filters.facet_filter``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import human_number, log_ten
from ..functions.text import display_title, shorten
from ..operators import aggregates as agg
from ..operators import joins as jn
from ..operators import ranking as rk
from ..operators.filters import ALL, facet_filter
from ..operators.ordered import exact_sample

LABELS = ["positive", "neutral", "negative"]


def select(
    df: DataFrame, language: str = ALL, sentiments=(ALL,), tier: str = ALL, years=(2010, 2026)
) -> DataFrame:
    return facet_filter(
        df, equal={"lang_clean": language, "engagement_tier": tier},
        one_of={"sentiment_label": list(sentiments)}, ranges={"publish_year": years},
    )


def kpis(d: DataFrame) -> DataFrame:
    return agg.kpi_block(
        d, category="lang_clean", views="view_count", likes="like_count", score="engagement_score",
        label="sentiment_label", positive="positive", negative="negative",
        flags=["has_description", "has_tags"],
    )


def content(d: DataFrame) -> DataFrame:
    return agg.content_stats(
        d,
        means={"avg_title_length": "title_length", "avg_word_count": "title_word_count",
               "avg_views": "view_count", "avg_likes": "like_count", "avg_comments": "comment_count"},
        shares={"has_description_pct": "has_description", "has_tags_pct": "has_tags"},
    )


def language_bar(d: DataFrame) -> DataFrame:
    return agg.share_of_shown(d, "lang_clean", 15).withColumn("pct", F.round("pct", 1))


def sentiment_donut(d: DataFrame) -> DataFrame:
    return agg.share_of_all(d, "sentiment_label").withColumn(
        "label", display_title(F.col("sentiment_label"))
    )


def monthly_trend(d: DataFrame, since: int = 2018) -> DataFrame:
    return agg.monthly_counts(d, "published_at", "sentiment_label", since)


def engagement_scatter(d: DataFrame, n: int = 8000) -> DataFrame:
    return exact_sample(d, "video_id", n).select(
        "video_id", log_ten(F.col("view_count")).alias("views_log"),
        log_ten(F.col("like_count")).alias("likes_log"), "sentiment_label", "title",
        "view_count", "like_count", "lang_clean",
    )


def engagement_violin(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Box statistics and density of the ten largest languages."""
    return (
        agg.box_stats(d, "lang_clean", "engagement_score"),
        agg.density(d, "lang_clean", "engagement_score"),
    )


def top_videos(d: DataFrame, k: int = 10) -> DataFrame:
    top = rk.top_rows(d, "view_count", k, ["video_id"])
    return top.select(
        shorten(F.col("title"), 60).alias("Title"), F.col("lang_clean").alias("Language"),
        human_number(F.col("view_count")).alias("View Count"),
        human_number(F.col("like_count")).alias("Like Count"),
        human_number(F.col("comment_count")).alias("Comment Count"),
        display_title(F.col("sentiment_label")).alias("Sentiment"),
    )


def upload_heatmap(d: DataFrame) -> DataFrame:
    return agg.hour_by_weekday(d, "upload_hour", "upload_day_of_week")


def title_length_histogram(d: DataFrame) -> DataFrame:
    return agg.histogram(d, "title_length", 50, by=["sentiment_label"])


def yearly_growth(d: DataFrame, first: int = 2015, last: int = 2026) -> DataFrame:
    return rk.growth(agg.counts_by_year(d, "publish_year", first, last), "publish_year")


def language_sentiment_mix(d: DataFrame) -> DataFrame:
    kept = jn.keep_top_groups(d, "lang_clean", 15)
    table = agg.crosstab_pct(kept, "lang_clean", "sentiment_label", LABELS)
    return jn.by_group_size(table, d, "lang_clean", 15)


def average_views(d: DataFrame) -> DataFrame:
    kept = jn.keep_top_groups(d, "lang_clean", 15)
    table = agg.group_overview(kept, "lang_clean", "view_count", "like_count", "video_id")
    return table.select(
        "lang_clean", F.col("avg_first").alias("avg_views"), F.col("avg_second").alias("avg_likes"),
        F.col("row_count").alias("video_count"),
        human_number(F.col("avg_first").cast("bigint")).alias("text"),
    ).orderBy("avg_views", "lang_clean")


def language_treemap(d: DataFrame) -> DataFrame:
    return agg.hierarchy(d, "lang_clean", "Languages")


def weekday_bar(d: DataFrame) -> DataFrame:
    return agg.counts_by_weekday(d, "upload_day_of_week")
