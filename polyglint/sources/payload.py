"""Nested JSON responses to flat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import (
    age_days, age_hours, guarded_ratio, iso_duration_seconds, parse_timestamp, to_count,
    weekday_number,
)
from ..functions.text import join_list
from .schemas import CHANNEL_RESPONSE, SEARCH_RESPONSE, VIDEO_RECORD, VIDEO_RESPONSE


def parse_items(df: DataFrame, payload: str, schema: T.StructType) -> DataFrame:
    """One row per element of the response's ``items``; unreadable responses give none."""
    parsed = F.from_json(F.col(payload), schema)
    return df.select(F.explode(parsed["items"]).alias("item"))


def search_pairs(df: DataFrame, payload: str) -> DataFrame:
    """(video_id, channel_id) found by searches, each video once, ids complete."""
    found = parse_items(df, payload, SEARCH_RESPONSE).select(
        F.col("item.id.videoId").alias("video_id"),
        F.col("item.snippet.channelId").alias("channel_id"),
    )
    valid = found.where((F.col("video_id") != "") & (F.col("channel_id") != ""))
    return valid.groupBy("video_id").agg(F.min("channel_id").alias("channel_id"))


def channel_attributes(df: DataFrame, payload: str) -> DataFrame:
    items = parse_items(df, payload, CHANNEL_RESPONSE)
    return items.groupBy(F.col("item.id").alias("channel_id")).agg(
        F.min_by("item", F.to_json("item")).alias("channel")
    )


def engagement_ratios(views: Column, likes: Column, comments: Column) -> dict[str, Column]:
    return {
        "like_view_ratio": guarded_ratio(likes, views),
        "comment_view_ratio": guarded_ratio(comments, views),
        "engagement_score": guarded_ratio(likes + comments, views),
    }


def video_records(
    responses: DataFrame, payload: str, channels: DataFrame, collected_at: Column
) -> DataFrame:
    """The flat record of every video item, channel attributes joined in.

    ``channels`` is the result of ``channel_attributes``; ``collected_at`` is the moment ages
    are measured at, a parameter so that a rerun gives the same rows.
    """
    v = parse_items(responses, payload, VIDEO_RESPONSE)
    v = v.withColumn("channel_id", F.coalesce(F.col("item.snippet.channelId"), F.lit("")))
    v = v.join(channels, "channel_id", "left")

    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))

    moment = F.col("published")
    views, likes, comments = F.col("view_count"), F.col("like_count"), F.col("comment_count")
    stats = "item.statistics"
    parsed = v.select(
        "*",
        parse_timestamp(F.col("item.snippet.publishedAt")).alias("published"),
        parse_timestamp(F.col("channel.snippet.publishedAt")).alias("channel_published"),
        to_count(F.col(f"{stats}.viewCount")).alias("view_count"),
        to_count(F.col(f"{stats}.likeCount")).alias("like_count"),
        to_count(F.col(f"{stats}.commentCount")).alias("comment_count"),
    )
    known = {
        "video_id": F.col("item.id"),
        "channel_id": F.col("channel_id"),
        "channel_title": text("item.snippet.channelTitle"),
        "title": text("item.snippet.title"),
        "description": text("item.snippet.description"),
        "tags": join_list(F.col("item.snippet.tags")),
        "default_language": text("item.snippet.defaultLanguage"),
        "default_audio_language": text("item.snippet.defaultAudioLanguage"),
        "category_id": text("item.snippet.categoryId"),
        "topic_ids": join_list(F.col("item.topicDetails.topicIds")),
        "relevant_topic_ids": join_list(F.col("item.topicDetails.relevantTopicIds")),
        "published_at": text("item.snippet.publishedAt"),
        "upload_hour": F.hour(moment),
        "upload_day_of_week": weekday_number(moment),
        "duration": iso_duration_seconds(F.col("item.contentDetails.duration")),
        "live_broadcast_content": text("item.snippet.liveBroadcastContent"),
        "view_count": views, "like_count": likes, "comment_count": comments,
        **engagement_ratios(views, likes, comments),
        "subscriber_count": F.col("channel.statistics.subscriberCount").try_cast("bigint"),
        "channel_video_count": F.col("channel.statistics.videoCount").try_cast("bigint"),
        "channel_age_days": age_days(F.col("channel_published"), collected_at),
        "channel_country": text("channel.snippet.country"),
        "channel_published_at": text("channel.snippet.publishedAt"),
        "num_related_videos": F.lit(0),
        "caption": text("item.contentDetails.caption"),
        "licensed_content": F.coalesce(F.col("item.contentDetails.licensedContent"), F.lit(False)),
        "projection": text("item.contentDetails.projection"),
        "thumbnail_high_url": text("item.snippet.thumbnails.high.url"),
        "video_age_hours": age_hours(moment, collected_at),
        "collected_at": F.date_format(collected_at, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    }
    return parsed.select(
        *[
            known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in VIDEO_RECORD.fields
        ]
    )
