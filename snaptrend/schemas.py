"""Declared tables: column types, partition column, clustering keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Table columns, as "name type" in table order.
_VIDEO_COLUMNS = """
run_date date, video_id string, video_url string, title string, description string,
channel_id string, channel_title string, published_at timestamp, search_query string,
category_id string, tags string, default_language string, duration_seconds bigint,
view_count bigint, like_count bigint, comment_count bigint, thumbnail_url string,
published_after_utc timestamp, published_before_utc timestamp, extracted_at timestamp,
raw_search_json string
"""
_COMMENT_RAW_COLUMNS = """
run_date date, video_id string, video_url string, video_title string, comment_id string,
parent_id string, author_channel_id string, author_name string, comment_text string,
like_count bigint, published_at timestamp, updated_at timestamp, extracted_at timestamp
"""
_COMMENT_CURRENT_COLUMNS = """
run_date date, comment_id string, parent_id string, video_id string, author_channel_id string,
author_name string, comment_text string, like_count bigint, published_at timestamp,
updated_at timestamp, extracted_at timestamp
"""
_CHANNEL_COLUMNS = """
run_date date, channel_id string, channel_title string, description string, custom_url string,
country string, subscriber_count bigint, total_view_count bigint, total_video_count bigint,
published_at timestamp, extracted_at timestamp, raw_channel_json string
"""
_MOMENTUM_COLUMNS = """
run_date date, video_id string, video_url string, title string, channel_id string,
channel_title string, description string, thumbnail_url string, view_count bigint,
like_count bigint, comment_count bigint, published_at timestamp, extracted_at timestamp,
previous_view_count bigint, previous_like_count bigint, previous_comment_count bigint,
views_gained bigint, likes_gained bigint, comments_gained bigint, pct_growth double,
momentum_score double, video_age_hours bigint, gold_loaded_at timestamp
"""
_DISCOVERY_COLUMNS = """
video_id string, title string, channel_title string, description string, view_count bigint,
views_gained bigint, comments_gained bigint, likes_gained bigint, pct_growth double,
momentum_score double, video_age_hours bigint, comment_rate double, like_rate double,
discovery_type string
"""
_VIDEO_TOPIC_COLUMNS = """
run_date date, video_id string, topic_id string, topic_name string, macro_topic_id string,
macro_topic_name string, sub_topic_id string, sub_topic_name string, topic_keywords string,
macro_topic_keywords string, sub_topic_keywords string, topic_confidence double,
topic_method string, matched_source string, source_text string, processed_at timestamp
"""
_TOPIC_COLUMNS = """
run_date date, topic_id string, topic_name string, macro_topic_id string,
macro_topic_name string, sub_topic_id string, sub_topic_name string, keywords string,
representative_videos string, sample_comments string, videos_count bigint, video_count bigint,
total_views bigint, view_count_total bigint, total_likes bigint, total_comments bigint,
comment_count_total bigint, avg_views_per_video double, avg_likes_per_video double,
avg_comments_per_video double, sentiment_avg double, relevance_score double,
processed_at timestamp
"""
_TREND_COLUMNS = """
run_date date, topic_id string, topic_name string, macro_topic_id string,
macro_topic_name string, sub_topic_id string, sub_topic_name string, keywords string,
videos_count bigint, video_count bigint, total_views bigint, view_count_total bigint,
total_likes bigint, total_comments bigint, comment_count_total bigint, relevance_score double,
previous_videos_count bigint, previous_total_views bigint, previous_total_likes bigint,
previous_total_comments bigint, videos_count_change bigint, views_change bigint,
likes_change bigint, comments_change bigint, processed_at timestamp
"""
_CHANNEL_DAILY_COLUMNS = """
run_date date, channel_id string, channel_title string, videos_count bigint,
total_views bigint, total_likes bigint, total_comments bigint, subscriber_count bigint,
total_channel_views bigint, total_channel_videos bigint, avg_views_per_video double,
avg_comments_per_video double, processed_at timestamp
"""
_SUMMARY_COLUMNS = """
run_date date, videos_monitored bigint, channels_monitored bigint, topics_detected bigint,
comments_available bigint, total_views bigint, total_likes bigint, total_comments bigint,
top_topic_id string, top_topic_name string, top_topic_comments bigint, top_channel_id string,
top_channel_title string, top_channel_views bigint, processed_at timestamp
"""


@dataclass(frozen=True)
class TableSpec:
    """One declared table of a layer."""

    name: str
    layer: str
    columns: str
    cluster: tuple[str, ...] = ()
    partition: str | None = "run_date"
    key: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


VIDEOS_RAW = TableSpec("videos_raw", "raw", _VIDEO_COLUMNS, ("video_id", "channel_id"))
COMMENTS_RAW = TableSpec("comments_raw", "raw", _COMMENT_RAW_COLUMNS, ("video_id", "comment_id"))
CHANNELS_RAW = TableSpec("channels_raw", "raw", _CHANNEL_COLUMNS, ("channel_id",))
VIDEOS_DAILY = TableSpec(
    "videos_daily", "silver", _VIDEO_COLUMNS, ("video_id", "channel_id"), key=("video_id", "run_date")
)
COMMENTS_CURRENT = TableSpec(
    "comments_current", "silver", _COMMENT_CURRENT_COLUMNS, ("video_id", "comment_id"), key=("comment_id",)
)
CHANNELS_DAILY = TableSpec(
    "channels_daily", "silver", _CHANNEL_COLUMNS, ("channel_id",), key=("channel_id", "run_date")
)
VIDEO_MOMENTUM = TableSpec("video_momentum", "gold", _MOMENTUM_COLUMNS, ("video_id", "channel_id"))
VIDEO_DISCOVERY = TableSpec("video_discovery", "gold", _DISCOVERY_COLUMNS, partition=None)
VIDEO_TOPICS_DAILY = TableSpec(
    "video_topics_daily", "gold", _VIDEO_TOPIC_COLUMNS, ("macro_topic_id", "sub_topic_id", "video_id")
)
TOPIC_DAILY = TableSpec("topic_daily", "gold", _TOPIC_COLUMNS, ("macro_topic_id", "sub_topic_id"))
TOPIC_TRENDS_DAILY = TableSpec(
    "topic_trends_daily", "gold", _TREND_COLUMNS, ("macro_topic_id", "sub_topic_id")
)
CHANNEL_DAILY = TableSpec("channel_daily", "gold", _CHANNEL_DAILY_COLUMNS, ("channel_id",))
DASHBOARD_SUMMARY_DAILY = TableSpec("dashboard_summary_daily", "gold", _SUMMARY_COLUMNS)

TABLES: tuple[TableSpec, ...] = (
    VIDEOS_RAW, COMMENTS_RAW, CHANNELS_RAW, VIDEOS_DAILY, COMMENTS_CURRENT, CHANNELS_DAILY,
    VIDEO_MOMENTUM, VIDEO_DISCOVERY, VIDEO_TOPICS_DAILY, TOPIC_DAILY, TOPIC_TRENDS_DAILY,
    CHANNEL_DAILY, DASHBOARD_SUMMARY_DAILY,
)

# The parts of landed API pages the flatten jobs read.
SEARCH_PAGE = """
items array<struct<id: struct<videoId: string>, snippet: struct<channelId: string,
channelTitle: string, title: string, description: string, publishedAt: string,
thumbnails: struct<high: struct<url: string>>>>>
"""
VIDEO_DETAIL_PAGE = """
items array<struct<id: string, snippet: struct<categoryId: string, tags: array<string>,
defaultLanguage: string>, statistics: struct<viewCount: string, likeCount: string,
commentCount: string>, contentDetails: struct<duration: string>>>
"""
COMMENT_PAGE = """
items array<struct<snippet: struct<topLevelComment: struct<id: string, snippet: struct<
authorChannelId: string, authorDisplayName: string, textDisplay: string, likeCount: string,
publishedAt: string, updatedAt: string>>>>>
"""
CHANNEL_PAGE = """
items array<struct<id: string, snippet: struct<title: string, description: string,
customUrl: string, country: string, publishedAt: string>, statistics: struct<
subscriberCount: string, viewCount: string, videoCount: string>>>
"""


def one_line(ddl: str) -> str:
    return " ".join(ddl.split())
