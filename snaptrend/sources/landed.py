"""Flatten landed API pages (JSON text, one page per row) into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrend.functions.numbers import counter
from snaptrend.functions.text import iso_duration_seconds
from snaptrend.schemas import (
    CHANNEL_PAGE, COMMENT_PAGE, SEARCH_PAGE, VIDEO_DETAIL_PAGE, one_line,
)


def read_pages(spark: SparkSession, path: str, page_per_file: bool = False) -> DataFrame:
    """Landed pages as a ``page`` column: one page per line, or one per file."""
    return spark.read.text(path, wholetext=page_per_file).withColumnRenamed("value", "page")


def _items(pages: DataFrame, page: str, ddl: str, keep: list[str]) -> DataFrame:
    """One row per entry of the page: ``raw`` holds its JSON, ``item`` the parsed fields.

    Items are first cut out as JSON text, so fields nobody declared stay in the payload. Both are made
    before the rows are, so that filters and columns after it share one reading of an item.
    """
    fields = one_line(ddl).removeprefix("items array<").removesuffix(">")
    cut = F.from_json(page, "items array<string>")["items"]
    entries = F.transform(cut, lambda raw: F.struct(raw.alias("raw"), F.from_json(raw, fields).alias("item")))
    return pages.select(*keep, F.explode(entries).alias("_entry")).select(*keep, "_entry.raw", "_entry.item")


def flatten_search(pages: DataFrame, page: str = "page", query: str = "search_query") -> DataFrame:
    """Search hits: eight fields plus the payload; hits without a video id are dropped."""
    item, snippet = F.col("item"), F.col("item.snippet")
    return (
        _items(pages, page, SEARCH_PAGE, [query])
        .where(F.coalesce(item["id"]["videoId"], F.lit("")) != "")
        .select(
            F.col(query).alias("search_query"),
            item["id"]["videoId"].alias("video_id"),
            snippet["channelId"].alias("channel_id"),
            snippet["channelTitle"].alias("channel_title"),
            snippet["title"].alias("title"),
            snippet["description"].alias("description"),
            snippet["publishedAt"].alias("published_at"),
            snippet["thumbnails"]["high"]["url"].alias("thumbnail_url"),
            F.col("raw").alias("raw_search_json"),
        )
    )


def flatten_video_details(pages: DataFrame, page: str = "page") -> DataFrame:
    """Video details: category, tags joined, language, duration in seconds, counters."""
    item = F.col("item")
    tags = item["snippet"]["tags"]
    return _items(pages, page, VIDEO_DETAIL_PAGE, []).select(
        item["id"].alias("video_id"),
        item["snippet"]["categoryId"].alias("category_id"),
        F.when(F.size(tags) > 0, F.array_join(tags, ", ")).alias("tags"),
        item["snippet"]["defaultLanguage"].alias("default_language"),
        iso_duration_seconds(item["contentDetails"]["duration"]).alias("duration_seconds"),
        *_counters(item["statistics"], {
            "view_count": "viewCount", "like_count": "likeCount", "comment_count": "commentCount",
        }),
    )


def flatten_comments(pages: DataFrame, page: str = "page", video_id: str = "video_id") -> DataFrame:
    """Top-level comments of the threads fetched for one video per page."""
    top = F.col("item.snippet.topLevelComment")
    snippet = top["snippet"]
    return _items(pages, page, COMMENT_PAGE, [video_id]).select(
        F.col(video_id).alias("video_id"),
        top["id"].alias("comment_id"),
        F.lit(None).cast("string").alias("parent_id"),
        # The author id counts only where the field is an object with a value.
        F.get_json_object(snippet["authorChannelId"], "$.value").alias("author_channel_id"),
        snippet["authorDisplayName"].alias("author_name"),
        snippet["textDisplay"].alias("comment_text"),
        counter(snippet["likeCount"]).alias("like_count"),
        snippet["publishedAt"].alias("published_at"),
        snippet["updatedAt"].alias("updated_at"),
    )


def flatten_channels(pages: DataFrame, page: str = "page") -> DataFrame:
    """Channel metadata: five text fields, three counters and the payload."""
    item, snippet = F.col("item"), F.col("item.snippet")
    return _items(pages, page, CHANNEL_PAGE, []).select(
        item["id"].alias("channel_id"),
        snippet["title"].alias("channel_title"),
        snippet["description"].alias("description"),
        snippet["customUrl"].alias("custom_url"),
        snippet["country"].alias("country"),
        *_counters(item["statistics"], {
            "subscriber_count": "subscriberCount", "total_view_count": "viewCount",
            "total_video_count": "videoCount",
        }),
        snippet["publishedAt"].alias("published_at"),
        F.col("raw").alias("raw_channel_json"),
    )


def _counters(statistics: Column, names: dict[str, str]) -> list[Column]:
    return [counter(statistics[field]).alias(name) for name, field in names.items()]
