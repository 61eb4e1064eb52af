"""Fixed schemas. Reading never infers types."""

from pyspark.sql import types as T

S, L, D, I, B = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The collected record, in column order.
VIDEO_RECORD = _struct(
    video_id=S, channel_id=S, channel_title=S, title=S, description=S, tags=S,
    default_language=S, default_audio_language=S, category_id=S, topic_ids=S,
    relevant_topic_ids=S, published_at=S, upload_hour=I, upload_day_of_week=I, duration=D,
    live_broadcast_content=S, view_count=L, like_count=L, comment_count=L, like_view_ratio=D,
    comment_view_ratio=D, engagement_score=D, subscriber_count=L, channel_video_count=L,
    channel_age_days=D, channel_country=S, channel_published_at=S, positive_ratio=D,
    negative_ratio=D, toxic_ratio=D, related_video_ids=S, num_related_videos=L, caption=S,
    licensed_content=B, projection=S, thumbnail_high_url=S, video_age_hours=D, collected_at=S,
)

# Columns that never hold data.
ALWAYS_NULL = [
    "topic_ids", "relevant_topic_ids", "positive_ratio", "negative_ratio", "toxic_ratio",
    "related_video_ids",
]

# Columns the dashboard reads.
DASHBOARD_COLUMNS = [
    "video_id", "title", "published_at", "upload_hour", "upload_day_of_week", "view_count",
    "like_count", "comment_count", "engagement_score", "title_length", "title_word_count",
    "has_description", "has_tags", "language", "eff_lang", "sentiment_label",
    "engagement_tier", "publish_year", "publish_month",
]

_VIDEO_ITEM = _struct(
    id=S,
    snippet=_struct(
        channelId=S, channelTitle=S, title=S, description=S, tags=T.ArrayType(S),
        defaultLanguage=S, defaultAudioLanguage=S, categoryId=S, publishedAt=S,
        liveBroadcastContent=S, thumbnails=_struct(high=_struct(url=S)),
    ),
    contentDetails=_struct(duration=S, caption=S, licensedContent=B, projection=S),
    statistics=_struct(viewCount=S, likeCount=S, commentCount=S),
    topicDetails=_struct(topicIds=T.ArrayType(S), relevantTopicIds=T.ArrayType(S)),
)

VIDEO_RESPONSE = _struct(items=T.ArrayType(_VIDEO_ITEM))

CHANNEL_RESPONSE = _struct(
    items=T.ArrayType(
        _struct(
            id=S,
            snippet=_struct(publishedAt=S, country=S),
            statistics=_struct(subscriberCount=S, videoCount=S),
        )
    )
)

SEARCH_RESPONSE = _struct(
    items=T.ArrayType(_struct(id=_struct(videoId=S), snippet=_struct(channelId=S))),
    nextPageToken=S,
)
