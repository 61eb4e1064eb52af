"""The stages as functions from frame to frame. Nothing here runs an action; store a stage with
``sources.files.write_parquet`` where it is reused."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import numbers as num
from ..functions import text as tx
from ..operators.aggregates import SENTIMENTS, TIERS, tiers_by_quantile
from ..operators.filters import between, keep_min_tokens, keep_nonblank
from ..operators.ordered import exact_sample
from ..sources.schemas import ALWAYS_NULL, DASHBOARD_COLUMNS

# The moments of the collected record.
MOMENTS = ("published_at", "channel_published_at", "collected_at")


def feature_stage(raw: DataFrame) -> DataFrame:
    """Collected records to features: dead columns dropped, moments parsed, text measured,
    language normalised, label and tier cut at the quantiles of the whole table."""
    df = raw.drop(*ALWAYS_NULL)
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    df = df.select(
        *[
            num.parse_timestamp(F.col(c)).alias(c) if c in MOMENTS and c in texts
            else tx.blank_to_null(F.col(c)).alias(c) if c in texts
            else F.col(c)
            for c in df.columns
        ]
    )
    title, description, tags = F.col("title"), F.col("description"), F.col("tags")
    df = df.select(
        "*",
        tx.char_count(title).alias("title_length"),
        tx.word_count(title).alias("title_word_count"),
        tx.presence_flag(description).alias("has_description"),
        tx.word_count(description).alias("desc_word_count"),
        tx.presence_flag(tags).alias("has_tags"),
        tx.delimited_count(tags).alias("tag_count"),
        tx.join_fields(title, description, tags).alias("combined_text"),
        tx.language_label(F.col("default_language"), F.col("default_audio_language")).alias("language"),
        F.year("published_at").alias("publish_year"),
        F.month("published_at").alias("publish_month"),
    )
    return tiers_by_quantile(
        df,
        {
            "sentiment_label": ("like_view_ratio", SENTIMENTS),
            "engagement_tier": ("engagement_score", TIERS),
        },
    )


def clean_stage(
    features: DataFrame, stopwords: Mapping[str, Sequence[str]] | None = None, min_tokens: int = 2
) -> DataFrame:
    """Effective language, cleaned text and lexical features; rows with too few tokens leave."""
    text = F.col("combined_text")
    df = _once(features, tx.effective_language(F.col("language"), text).alias("eff_lang"))
    df = _once(df, tx.clean_tokens(tx.nfc(text), F.col("eff_lang"), stopwords).alias("_tokens"))
    df = _once(df, F.array_join("_tokens", " ").alias("clean_text"), F.size("_tokens").alias("clean_word_count"))
    kept = keep_min_tokens(df, "clean_word_count", min_tokens)
    return kept.select(
        *[c for c in kept.columns if c != "_tokens"],
        tx.char_count(F.col("clean_text")).alias("clean_char_count"),
        F.size(F.array_distinct("_tokens")).alias("unique_word_count"),
        tx.token_diversity(F.col("_tokens")).alias("lexical_diversity"),
    )


def _once(df: DataFrame, *cols: Column) -> DataFrame:
    """Add columns through a generator, so that later filters and projections read their values
    and do not compute the expressions again."""
    return df.select("*", F.inline(F.array(F.struct(*cols))))


def corpus(clean: DataFrame, n: int | None = None, seed: int = 42) -> DataFrame:
    """Rows for the embedding stage: all non-blank texts, or ``n`` of them."""
    kept = keep_nonblank(clean, "clean_text")
    return kept if n is None else exact_sample(kept, "video_id", n, seed)


def dashboard_stage(
    clean: DataFrame, years: tuple[int, int] = (2010, 2026), sample: int | None = None, seed: int = 42
) -> DataFrame:
    """The pruned, down-cast frame the dashboard filters; ``sample`` thins it if wanted."""
    df = clean.select(*[c for c in DASHBOARD_COLUMNS if c in clean.columns])
    df = df.withColumn("lang_clean", F.coalesce("eff_lang", "language", F.lit("unknown")))
    df = between(df, "publish_year", *years)
    if sample is not None:
        df = exact_sample(df, "video_id", sample, seed)
    small = {
        "upload_hour", "upload_day_of_week", "title_length", "title_word_count",
        "has_description", "has_tags", "publish_year", "publish_month",
    }
    return df.select(
        *[
            F.col(c).try_cast("int").alias(c) if c in small
            else F.col(c).try_cast("float").alias(c) if c == "engagement_score"
            else F.col(c)
            for c in df.columns
        ]
    )
