"""Landed pages to typed daily snapshots of videos, comments and channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrend.functions.dates import search_window_utc
from snaptrend.functions.lexicon import LOCAL_ZONE, VIDEO_URL_PREFIX
from snaptrend.operators.versions import first_per_key, merge_hits
from snaptrend.schemas import CHANNELS_RAW, COMMENTS_RAW, VIDEOS_RAW
from snaptrend.sources.landed import (
    flatten_channels, flatten_comments, flatten_search, flatten_video_details,
)
from snaptrend.sources.snapshots import align


def videos_snapshot(
    search_pages: DataFrame,
    detail_pages: DataFrame,
    run_date: Column,
    extracted_at: Column | None = None,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """One row per video found, with its details where they were fetched."""
    day = run_date.cast("date")
    after, before = search_window_utc(day, zone=zone)
    hits = merge_hits(flatten_search(search_pages))
    details = flatten_video_details(detail_pages)
    return align(
        hits.join(details, "video_id", "left").withColumns({
            "run_date": day,
            "published_after_utc": after,
            "published_before_utc": before,
            "video_url": F.concat(F.lit(VIDEO_URL_PREFIX), F.col("video_id")),
            "extracted_at": F.current_timestamp() if extracted_at is None else extracted_at,
        }),
        VIDEOS_RAW.schema,
    )


def comments_snapshot(
    comment_pages: DataFrame, videos: DataFrame, extracted_at: Column | None = None
) -> DataFrame:
    """Comments with run date, address and title of their video, each comment once a day.

    A video may have most of the comments: the join then has one row per video on its other side,
    which adaptive execution splits well.
    """
    title = F.col("video_title") if "video_title" in videos.columns else F.lit(None).cast("string")
    parents = videos.select(
        "run_date", "video_id", "video_url",
        F.coalesce(F.nullif(title, F.lit("")), F.col("title")).alias("video_title"),
    )
    rows = flatten_comments(comment_pages).join(parents, "video_id").withColumn(
        "extracted_at", F.current_timestamp() if extracted_at is None else extracted_at
    )
    order = [F.col("updated_at").desc_nulls_last(), F.col("video_id"), F.col("comment_text")]
    return align(first_per_key(rows, ["run_date", "comment_id"], order), COMMENTS_RAW.schema)


def wanted_channels(videos: DataFrame) -> DataFrame:
    """Distinct channel ids whose metadata a snapshot needs."""
    return videos.where(F.col("channel_id").isNotNull()).select("channel_id").distinct()


def channels_snapshot(
    channel_pages: DataFrame,
    run_date: Column,
    extracted_at: Column | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """One row per channel, optionally only those a snapshot needs."""
    rows = flatten_channels(channel_pages)
    if wanted is not None:
        rows = rows.join(wanted, "channel_id", "left_semi")
    once = first_per_key(rows, ["channel_id"], [F.col("raw_channel_json")])
    return align(
        once.withColumns({
            "run_date": run_date.cast("date"),
            "extracted_at": F.current_timestamp() if extracted_at is None else extracted_at,
        }),
        CHANNELS_RAW.schema,
    )
