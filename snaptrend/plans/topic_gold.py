"""Gold aggregates by topic, channel and day.

Every job takes all run dates at once or one of them: the run date is part of each grouping key,
so a backfill over many dates is a single plan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrend.functions.dates import as_date
from snaptrend.functions.lexicon import CATCH_ALL_ID
from snaptrend.functions.numbers import relevance_score, safe_divide, zero_if_null
from snaptrend.operators.deltas import with_changes
from snaptrend.operators.ranking import joined_distinct, joined_top, top_per_group

TOPIC_KEY = (
    "run_date", "topic_id", "topic_name", "macro_topic_id", "macro_topic_name", "sub_topic_id",
    "sub_topic_name",
)
TOPIC_SLICES = 256


def with_hierarchy(df: DataFrame) -> DataFrame:
    """Fill the macro and sub-topic columns of rows that only carry the older topic columns."""
    return df.withColumns({
        "macro_topic_id": F.coalesce("macro_topic_id", "topic_id"),
        "macro_topic_name": F.coalesce("macro_topic_name", "topic_name"),
        "sub_topic_id": F.coalesce("sub_topic_id", F.concat("topic_id", F.lit("__general"))),
        "sub_topic_name": F.coalesce("sub_topic_name", "topic_name"),
    })


def on_date(df: DataFrame, run_date: str | date | Column | None) -> DataFrame:
    """Rows of one run date (a partition filter), or all rows when none is given."""
    if run_date is None:
        return df
    day = run_date if isinstance(run_date, Column) else F.lit(as_date(run_date, "run_date"))
    return df.where(F.col("run_date") == day)


def stamp(at: Column | None) -> Column:
    return (F.current_timestamp() if at is None else at).cast("timestamp")


def topic_daily(
    assignments: DataFrame,
    videos: DataFrame,
    comments: DataFrame,
    run_date: str | date | None = None,
    processed_at: Column | None = None,
    samples: int = 5,
) -> DataFrame:
    """Metrics, representative titles and sample comments per topic, sub-topic and day."""
    topics = with_hierarchy(on_date(assignments, run_date))
    # One row per topic and video first, so that repeated assignments count once.
    counts = {c: F.max(zero_if_null(F.col(c))).alias(c) for c in ("view_count", "like_count", "comment_count")}
    per_video = (
        topics.select(*TOPIC_KEY, "video_id", "sub_topic_keywords")
        .join(
            on_date(videos, run_date).select("run_date", "video_id", "title", *counts),
            ["run_date", "video_id"],
        )
        .groupBy(*TOPIC_KEY, "video_id")
        .agg(F.min("sub_topic_keywords").alias("keywords"), F.min("title").alias("title"), *counts.values())
    )
    # Totals and best titles come from one pass over the videos. A topic may hold most of them, so
    # titles are ranked within slices of a topic, and the few best of each slice are ranked again.
    best_first = [F.col("title").isNull(), F.col("comment_count").desc(), F.col("view_count").desc(), F.col("video_id")]
    sliced = per_video.withColumn("_slice", F.pmod(F.xxhash64("video_id"), F.lit(TOPIC_SLICES))).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*TOPIC_KEY, "_slice").orderBy(*best_first))
    )
    candidate = F.struct(
        (-F.col("comment_count")).alias("c"), (-F.col("view_count")).alias("v"), "video_id", "title"
    )
    listed = F.slice(F.array_sort("_best"), 1, samples)
    full = sliced.groupBy(*TOPIC_KEY).agg(
        joined_distinct("keywords").alias("keywords"),
        F.count("video_id").alias("videos_count"),
        F.sum("view_count").alias("total_views"),
        F.sum("like_count").alias("total_likes"),
        F.sum("comment_count").alias("total_comments"),
        F.collect_list(F.when((F.col("_rank") <= samples) & F.col("title").isNotNull(), candidate)).alias("_best"),
    ).withColumn(
        "representative_videos",
        F.when(F.size("_best") > 0, F.array_join(F.transform(listed, lambda x: x["title"]), " | ")),
    )
    talk = _comment_samples(topics, on_date(comments, run_date), samples)
    keyed = [F.col(k) for k in TOPIC_KEY]
    per_video_avg = {
        f"avg_{n}_per_video": safe_divide(F.col(f"total_{n}"), F.col("videos_count"))
        for n in ("views", "likes", "comments")
    }
    return full.join(talk, ["run_date", "sub_topic_id"], "left").select(
        *keyed,
        "keywords", "representative_videos", "sample_comments", "videos_count",
        F.col("videos_count").alias("video_count"),
        "total_views",
        F.col("total_views").alias("view_count_total"),
        "total_likes", "total_comments",
        F.col("total_comments").alias("comment_count_total"),
        *[c.alias(n) for n, c in per_video_avg.items()],
        F.lit(None).cast("double").alias("sentiment_avg"),
        relevance_score(F.col("total_comments"), F.col("total_views"), F.col("videos_count")).alias("relevance_score"),
        stamp(processed_at).alias("processed_at"),
    )


def _comment_samples(topics: DataFrame, comments: DataFrame, samples: int) -> DataFrame:
    """Most liked comments per sub-topic and day.

    The best of a sub-topic are among the best of its videos, so each video is cut to its best
    few before the join and no busy video reaches it with more. Every assignment of a video
    repeats its comments, hence the plain join.
    """
    order = [F.col("like_count").desc(), F.col("comment_id")]
    best = top_per_group(
        comments.where(F.col("comment_text").isNotNull() & F.col("video_id").isNotNull())
        .select("run_date", "video_id", "comment_id", "comment_text", "like_count"),
        ["run_date", "video_id"], order, samples, "_video_rank",
    ).drop("_video_rank")
    joined = topics.select("run_date", "video_id", "sub_topic_id").join(best, ["run_date", "video_id"])
    return joined_top(
        joined, ["run_date", "sub_topic_id"], "comment_text", order, samples, " | ", "sample_comments"
    )


def topic_trends(topics: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Change of each sub-topic against its previous present day, over the whole history.

    A sub-topic has at most one row per day and topic, so a window group is bounded by the
    number of run dates.
    """
    filled = with_hierarchy(topics)
    trends = with_changes(
        filled, ["sub_topic_id"], ["run_date", "topic_id"],
        {
            "videos_count": ("previous_videos_count", "videos_count_change"),
            "total_views": ("previous_total_views", "views_change"),
            "total_likes": ("previous_total_likes", "likes_change"),
            "total_comments": ("previous_total_comments", "comments_change"),
        },
    )
    return trends.select(
        *TOPIC_KEY, "keywords", "videos_count", "video_count", "total_views", "view_count_total",
        "total_likes", "total_comments", "comment_count_total", "relevance_score",
        "previous_videos_count", "previous_total_views", "previous_total_likes",
        "previous_total_comments", "videos_count_change", "views_change", "likes_change",
        "comments_change", stamp(processed_at).alias("processed_at"),
    )


def channel_daily(
    videos: DataFrame,
    channels: DataFrame,
    run_date: str | date | None = None,
    processed_at: Column | None = None,
) -> DataFrame:
    """Totals per channel, title and day, with channel metadata where there is some.

    Both sides are aggregated before they meet, so a channel with very many videos joins as one
    row. The number of metadata rows weighs the sums, as joining them first would.
    """
    own = on_date(videos, run_date).groupBy("run_date", "channel_id", "channel_title").agg(
        F.count_distinct("video_id").alias("videos_count"),
        F.sum("view_count").alias("_views"),
        F.sum("like_count").alias("_likes"),
        F.sum("comment_count").alias("_comments"),
    )
    known = _channel_metadata(on_date(channels, run_date))
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    joined = own.join(known, ["run_date", "channel_id"], "left").withColumns({
        "total_views": F.col("_views") * copies,
        "total_likes": F.col("_likes") * copies,
        "total_comments": F.col("_comments") * copies,
    })
    return joined.select(
        "run_date", "channel_id", "channel_title", "videos_count", "total_views", "total_likes",
        "total_comments", "subscriber_count", "total_channel_views", "total_channel_videos",
        safe_divide(F.col("total_views"), F.col("videos_count")).alias("avg_views_per_video"),
        safe_divide(F.col("total_comments"), F.col("videos_count")).alias("avg_comments_per_video"),
        stamp(processed_at).alias("processed_at"),
    )


def _channel_metadata(channels: DataFrame) -> DataFrame:
    return channels.where(F.col("channel_id").isNotNull()).groupBy("run_date", "channel_id").agg(
        F.count(F.lit(1)).alias("_copies"),
        F.max("subscriber_count").alias("subscriber_count"),
        F.max("total_view_count").alias("total_channel_views"),
        F.max("total_video_count").alias("total_channel_videos"),
    )


def dashboard_summary(
    videos: DataFrame,
    channels: DataFrame,
    comments: DataFrame,
    assignments: DataFrame,
    run_date: str | date | None = None,
    processed_at: Column | None = None,
    catch_all: str = CATCH_ALL_ID,
) -> DataFrame:
    """One KPI row per run date.

    With a date there is always one row, even without data; without one, each date that has
    videos gets a row. The parts are stacked and folded by date rather than cross joined.
    """
    videos, channels = on_date(videos, run_date), on_date(channels, run_date)
    comments, assignments = on_date(comments, run_date), on_date(assignments, run_date)
    day = ["run_date"]
    sums = {"view_count": "total_views", "like_count": "total_likes", "comment_count": "total_comments"}
    video_part = videos.groupBy(*day).agg(
        F.count_distinct("video_id").alias("videos_monitored"),
        F.count_distinct("channel_id").alias("channels_monitored"),
        *[F.sum(c).alias(n) for c, n in sums.items()],
    )
    comment_part = comments.groupBy(*day).agg(F.count_distinct("comment_id").alias("comments_available"))
    topic_part = assignments.groupBy(*day).agg(
        F.count_distinct(F.when(F.col("macro_topic_id") != catch_all, F.col("macro_topic_id"))).alias("topics_detected")
    )
    top_topic = _top_topic(assignments, videos, catch_all)
    top_channel = _top_channel(videos, channels)
    counts = ["videos_monitored", "channels_monitored", "topics_detected", "comments_available", *sums.values()]
    tops = [
        "top_topic_id", "top_topic_name", "top_topic_comments", "top_channel_id",
        "top_channel_title", "top_channel_views",
    ]
    stacked = video_part.withColumn("_keep", F.lit(True))
    if run_date is not None:
        seed = videos.sparkSession.range(1).select(
            F.lit(as_date(run_date, "run_date")).alias("run_date"), F.lit(True).alias("_keep")
        )
        stacked = stacked.unionByName(seed, allowMissingColumns=True)
    for part in (comment_part, topic_part, top_topic, top_channel):
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    folded = stacked.groupBy(*day).agg(*[F.max(c).alias(c) for c in [*counts, *tops, "_keep"]])
    return folded.where("_keep").select(
        "run_date",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
        *tops,
        stamp(processed_at).alias("processed_at"),
    )


def _top_topic(assignments: DataFrame, videos: DataFrame, catch_all: str) -> DataFrame:
    """Macro topic with most comments per day, the catch-all left out."""
    summed = (
        assignments.where(F.col("macro_topic_id") != catch_all)
        .select("run_date", "video_id", "macro_topic_id", "macro_topic_name")
        .join(videos.select("run_date", "video_id", "comment_count"), ["run_date", "video_id"])
        .groupBy("run_date", "macro_topic_id", "macro_topic_name")
        .agg(F.sum("comment_count").alias("top_topic_comments"))
    )
    order = [F.col("top_topic_comments").desc(), F.col("macro_topic_id"), F.col("macro_topic_name")]
    return top_per_group(summed, ["run_date"], order, 1, "_rank").select(
        "run_date", F.col("macro_topic_id").alias("top_topic_id"),
        F.col("macro_topic_name").alias("top_topic_name"), "top_topic_comments",
    )


def _top_channel(videos: DataFrame, channels: DataFrame) -> DataFrame:
    """Channel with most views per day among those with metadata."""
    views = videos.where(F.col("channel_id").isNotNull()).groupBy("run_date", "channel_id").agg(
        F.sum("view_count").alias("_views")
    )
    known = channels.groupBy("run_date", "channel_id", "channel_title").agg(F.count(F.lit(1)).alias("_copies"))
    summed = views.join(known, ["run_date", "channel_id"]).withColumn(
        "top_channel_views", F.col("_views") * F.col("_copies")
    )
    order = [F.col("top_channel_views").desc(), F.col("channel_id"), F.col("channel_title")]
    return top_per_group(summed, ["run_date"], order, 1, "_rank").select(
        "run_date", F.col("channel_id").alias("top_channel_id"),
        F.col("channel_title").alias("top_channel_title"), "top_channel_views",
    )
