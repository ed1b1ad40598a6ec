"""Ready-to-serve results for one day or a window of days.

Every job returns rows; the ``*_document`` functions nest them for the JSON sink. Nothing
data-sized passes through the driver: a chosen set of topics is a frame that later plans join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrend.functions.dates import DateWindow, date_window
from snaptrend.functions.lexicon import CATCH_ALL_ID
from snaptrend.functions.numbers import safe_divide, zero_if_null
from snaptrend.operators.deltas import with_changes
from snaptrend.operators.ranking import (
    nested, prefer_specific, share_of_total, top_per_group, top_ranked,
)
from snaptrend.operators.series import densify
from snaptrend.plans.topic_gold import on_date
from snaptrend.session import stored
from snaptrend.sources.json_sink import write_array, write_object
from snaptrend.sources.tables import run_dates_of

SERIES = ("videos_count", "total_comments", "total_views", "comments_change", "views_change")
MACRO_ID = ("macro_topic_id", "topic_id")
MACRO_NAME = ("macro_topic_name", "topic_name")


def date_bounds(summary: DataFrame, topics: DataFrame) -> DataFrame:
    """Latest summary date and earliest topic date, one row, null where a table is empty."""
    latest = summary.select(F.max("run_date").alias("latest_run_date"), F.lit(None).cast("date").alias("earliest_run_date"))
    earliest = topics.select(F.lit(None).cast("date").alias("latest_run_date"), F.min("run_date").alias("earliest_run_date"))
    return latest.unionByName(earliest).agg(
        F.max("latest_run_date").alias("latest_run_date"),
        F.min("earliest_run_date").alias("earliest_run_date"),
    )


def window_from_tables(summary: DataFrame, topics: DataFrame, start=None, end=None) -> tuple[date | None, DateWindow]:
    """Latest date and the export window; two dates are all that reaches the driver."""
    row = date_bounds(summary, topics).first()
    window = date_window(start or row["earliest_run_date"], end, row["latest_run_date"])
    return row["latest_run_date"], window


def bounds_from_catalog(spark: SparkSession, summary: str, topics: str) -> tuple[date | None, date | None]:
    """Latest date of the summary table and earliest of the topic table, from the catalog alone."""
    return max(run_dates_of(spark, summary), default=None), min(run_dates_of(spark, topics), default=None)


def _in_window(df: DataFrame, window: DateWindow) -> DataFrame:
    return df.where(F.col("run_date").between(F.lit(window.start), F.lit(window.end)))


def _macro_sums(topics: DataFrame, keys: list[str], **sums: str) -> DataFrame:
    """Sums per macro topic; ``sums`` maps new name to column."""
    rows = topics.select(
        F.coalesce(*MACRO_ID).alias("topic_id"),
        F.coalesce(*MACRO_NAME).alias("topic_name"),
        *[k for k in keys if k != "topic_id"],
        *[zero_if_null(F.col(c)).alias(n) for n, c in sums.items()],
    )
    return rows.groupBy(*keys).agg(
        F.min("topic_name").alias("topic_name"), *[F.sum(n).alias(n) for n in sums]
    )


def top_relevant_topics(
    topics: DataFrame, window: DateWindow, limit: int = 6, catch_all: str = CATCH_ALL_ID, minimum: int = 3
) -> DataFrame:
    """Topics with most comments in a window, ranked.

    The catch-all counts only while fewer than ``minimum`` other topics exist.
    """
    sums = _macro_sums(
        _in_window(topics, window), ["topic_id"],
        window_total_comments="total_comments", window_total_views="total_views",
    )
    chosen = prefer_specific(sums, F.col("topic_id") == catch_all, minimum)
    order = [F.col("window_total_comments").desc(), F.col("window_total_views").desc(), F.col("topic_id")]
    return top_ranked(chosen, order, limit)


def metadata(
    summary: DataFrame, topics: DataFrame, window_days: int = 30, generated_at: Column | None = None
) -> DataFrame:
    """One row: when generated, latest and earliest date, days available, window length."""
    generated = F.current_timestamp() if generated_at is None else generated_at
    span = topics.agg(
        F.min("run_date").alias("earliest_run_date"),
        F.count_distinct("run_date").alias("days_available"),
    )
    return span.select(
        generated.alias("generated_at"),
        summary.select(F.max("run_date")).scalar().alias("latest_run_date"),
        "earliest_run_date",
        "days_available",
        F.lit(window_days).cast("bigint").alias("data_window_days"),
    )


def summary_of_day(summary: DataFrame, run_date) -> DataFrame:
    """KPI row of a day, the latest processed one; no row when there is none."""
    order = [F.col("processed_at").desc(), F.col("run_date")]
    return on_date(summary, run_date).orderBy(*order).limit(1).drop("processed_at")


def topics_over_time(
    topics: DataFrame,
    window: DateWindow,
    limit: int = 6,
    catch_all: str = CATCH_ALL_ID,
    chosen: DataFrame | None = None,
) -> DataFrame:
    """Gap-free daily series of the most relevant topics, with the change to the day before.

    ``chosen`` are those topics where they are known already.

    Changes look at the window only, so the first present day has none. A day without data has
    zeros, also for its changes.
    """
    chosen = top_relevant_topics(topics, window, limit, catch_all) if chosen is None else chosen
    daily = _macro_sums(
        _in_window(topics, window), ["run_date", "topic_id"],
        videos_count="videos_count", total_comments="total_comments", total_views="total_views",
    )
    kept = daily.join(F.broadcast(chosen.select("topic_id")), "topic_id", "left_semi")
    trends = with_changes(
        kept, ["topic_id"], ["run_date"],
        {
            "total_comments": ("_previous_comments", "comments_change"),
            "total_views": ("_previous_views", "views_change"),
        },
    )
    series = densify(trends, ["topic_id"], window, SERIES)
    info = chosen.select("topic_id", "topic_name", F.col("rank").alias("topic_rank"), "window_total_comments", "window_total_views")
    return series.join(F.broadcast(info), "topic_id")


def _day_topics(topics: DataFrame, run_date) -> DataFrame:
    return _macro_sums(
        on_date(topics, run_date), ["topic_id"],
        videos_count="videos_count", total_views="total_views", total_likes="total_likes",
        total_comments="total_comments",
    )


def topic_share(topics: DataFrame, run_date, limit: int = 10, catch_all: str = CATCH_ALL_ID) -> DataFrame:
    """Share of comments per topic; the total covers all selected topics, before the limit."""
    chosen = prefer_specific(_day_topics(topics, run_date), F.col("topic_id") == catch_all)
    shared = share_of_total(chosen, "total_comments", "share_of_comments")
    return (
        shared.orderBy(F.col("total_comments").desc(), F.col("total_views").desc(), F.col("topic_id"))
        .limit(limit)
        .select("topic_id", "topic_name", "total_comments", "share_of_comments", "total_views", "videos_count")
    )


def topic_changes(topics: DataFrame, run_date, limit: int = 10, catch_all: str = CATCH_ALL_ID) -> DataFrame:
    """Topics of a day with their change against the previous present day."""
    day = run_date if isinstance(run_date, Column) else F.lit(run_date).cast("date")
    daily = _macro_sums(
        topics.where(F.col("run_date") <= day), ["run_date", "topic_id"],
        videos_count="videos_count", total_comments="total_comments", total_views="total_views",
    )
    latest = with_changes(
        daily, ["topic_id"], ["run_date"],
        {
            "total_comments": ("previous_total_comments", "comments_change"),
            "total_views": ("previous_total_views", "views_change"),
            "videos_count": ("previous_videos_count", "videos_count_change"),
        },
    ).where(F.col("run_date") == day)
    chosen = prefer_specific(latest, F.col("topic_id") == catch_all)
    return (
        chosen.orderBy(F.col("comments_change").desc(), F.col("views_change").desc(), F.col("topic_id"))
        .limit(limit)
        .select(
            "topic_id", "topic_name", "total_comments", "previous_total_comments", "comments_change",
            "total_views", "previous_total_views", "views_change", "videos_count", "videos_count_change",
        )
    )


def top_topics(topics: DataFrame, run_date, limit: int = 10, catch_all: str = CATCH_ALL_ID) -> DataFrame:
    """Topics of a day ranked by comments and views."""
    chosen = prefer_specific(_day_topics(topics, run_date), F.col("topic_id") == catch_all)
    order = [F.col("total_comments").desc(), F.col("total_views").desc(), F.col("topic_id")]
    return top_ranked(chosen, order, limit).select(
        "rank", "topic_id", "topic_name", "videos_count", "total_views", "total_likes", "total_comments",
        safe_divide(F.col("total_comments"), F.col("videos_count")).alias("avg_comments_per_video"),
    )


def _topic_videos(assignments: DataFrame, videos: DataFrame, run_date, catch_all: str) -> DataFrame:
    """Videos of a day with their topics, the catch-all left out."""
    topics = (
        on_date(assignments, run_date)
        .withColumns({"_macro": F.coalesce(*MACRO_ID), "_macro_name": F.coalesce(*MACRO_NAME)})
        .where(F.col("_macro") != catch_all)
        .select(
            "run_date", "video_id", "_macro", "_macro_name", "sub_topic_id", "sub_topic_name",
            "topic_keywords", "sub_topic_keywords", "matched_source",
        )
    )
    return topics.join(
        on_date(videos, run_date).select(
            "run_date", "video_id", "title", "channel_title", "video_url", "thumbnail_url",
            "view_count", "like_count", "comment_count", "published_at",
        ),
        ["run_date", "video_id"],
    )


VIDEO_ORDER = ("comment_count", "view_count")


def _video_order() -> list[Column]:
    return [*[F.col(c).desc() for c in VIDEO_ORDER], F.col("video_id")]


def top_videos_by_topic(
    assignments: DataFrame,
    videos: DataFrame,
    chosen: DataFrame,
    run_date,
    limit: int = 5,
    catch_all: str = CATCH_ALL_ID,
) -> DataFrame:
    """Most discussed videos of each chosen topic; ``chosen`` has ``topic_id`` and ``rank``."""
    return _best_of_topics(_topic_videos(assignments, videos, run_date, catch_all), chosen, limit)


def _best_of_topics(rows: DataFrame, chosen: DataFrame, limit: int) -> DataFrame:
    rows = rows.withColumnsRenamed({"_macro": "topic_id", "_macro_name": "topic_name"})
    # The chosen topics come from a top-k with a fixed limit, so broadcasting them is safe.
    kept = rows.join(F.broadcast(chosen.select("topic_id", F.col("rank").alias("topic_rank"))), "topic_id")
    return top_per_group(kept, ["topic_id"], _video_order(), limit, "video_rank").select(
        "topic_rank", "topic_id", "topic_name", "video_rank", "video_id", "sub_topic_id",
        "sub_topic_name", "title", "channel_title", "video_url", "thumbnail_url", "view_count",
        "like_count", "comment_count", "published_at", "topic_keywords", "matched_source",
    )


def videos_by_sub_topic(
    assignments: DataFrame, videos: DataFrame, run_date, limit: int = 5, catch_all: str = CATCH_ALL_ID
) -> DataFrame:
    """Most discussed videos of each sub-topic."""
    return _best_of_sub_topics(_topic_videos(assignments, videos, run_date, catch_all), limit)


def _best_of_sub_topics(rows: DataFrame, limit: int) -> DataFrame:
    rows = rows.where(F.col("sub_topic_id").isNotNull())
    return top_per_group(rows, ["sub_topic_id"], _video_order(), limit, "video_rank").select(
        F.col("_macro").alias("macro_topic_id"), F.col("_macro_name").alias("macro_topic_name"),
        "sub_topic_id", "sub_topic_name", "video_rank", "video_id", "title", "channel_title",
        "video_url", "thumbnail_url", "view_count", "like_count", "comment_count", "published_at",
        F.col("sub_topic_keywords").alias("topic_keywords"),
    )


def sub_topics_over_time(
    topics: DataFrame, window: DateWindow, limit: int = 8, catch_all: str = CATCH_ALL_ID
) -> DataFrame:
    """Gap-free series of the most discussed sub-topics of each macro topic.

    The source rows carry no change columns, so the series shows zero change throughout.
    """
    keys = ["macro_topic_id", "sub_topic_id"]
    rows = (
        _in_window(topics, window)
        .withColumns({"macro_topic_id": F.coalesce(*MACRO_ID), "macro_topic_name": F.coalesce(*MACRO_NAME)})
        .where((F.col("macro_topic_id") != catch_all) & F.col("sub_topic_id").isNotNull())
    )
    daily = rows.groupBy(*keys, "run_date").agg(
        *[F.min(c).alias(c) for c in ("macro_topic_name", "sub_topic_name", "keywords")],
        *[F.sum(zero_if_null(F.col(c))).alias(c) for c in ("videos_count", "total_comments", "total_views")],
    )
    names = [F.min_by(c, "run_date").alias(c) for c in ("macro_topic_name", "sub_topic_name", "keywords")]
    totals = daily.groupBy(*keys).agg(
        F.sum("total_comments").alias("window_total_comments"),
        F.sum("total_views").alias("window_total_views"),
        *names,
    )
    order = [F.col("window_total_comments").desc(), F.col("window_total_views").desc(), F.col("sub_topic_id")]
    best = top_per_group(totals, ["macro_topic_id"], order, limit, "sub_topic_rank")
    kept = daily.join(best.select(*keys), keys, "left_semi").withColumns({
        "comments_change": F.lit(0).cast("bigint"), "views_change": F.lit(0).cast("bigint"),
    })
    return densify(kept, keys, window, SERIES).join(best, keys)


def top_sub_topics_by_macro(
    topics: DataFrame, run_date, limit: int = 8, catch_all: str = CATCH_ALL_ID
) -> DataFrame:
    """Sub-topics of a day ranked within their macro topic."""
    rows = (
        on_date(topics, run_date)
        .withColumns({"macro_topic_id": F.coalesce(*MACRO_ID), "macro_topic_name": F.coalesce(*MACRO_NAME)})
        .where((F.col("macro_topic_id") != catch_all) & F.col("sub_topic_id").isNotNull())
    )
    order = [F.col("total_comments").desc(), F.col("total_views").desc(), F.col("sub_topic_id")]
    return top_per_group(rows, ["macro_topic_id"], order, limit, "sub_topic_rank").select(
        "macro_topic_id", "macro_topic_name", "sub_topic_rank", "sub_topic_id", "sub_topic_name",
        "keywords", "representative_videos", "sample_comments", "videos_count", "total_views",
        "total_comments", "relevance_score",
    )


def top_channels(channels: DataFrame, run_date, limit: int = 10) -> DataFrame:
    """Channels of a day ranked by comments and views."""
    order = [
        F.col("total_comments").desc(), F.col("total_views").desc(), F.col("channel_id"), F.col("channel_title"),
    ]
    return top_ranked(on_date(channels, run_date), order, limit).select(
        "rank", "channel_id", "channel_title", "videos_count", "total_views", "total_likes",
        "total_comments", "subscriber_count", "avg_comments_per_video",
    )


def _window_document(df: DataFrame, window: DateWindow, entries: str) -> DataFrame:
    """One row around the nested entries: the window, its days and the metric."""
    return df.agg(F.array_sort(F.collect_list(entries)).alias(entries)).select(
        F.lit(window.start).alias("start_date"),
        F.lit(window.end).alias("end_date"),
        F.transform(
            F.sequence(F.lit(window.start), F.lit(window.end), F.expr("INTERVAL 1 DAY")),
            lambda d: d.cast("string"),
        ).alias("dates"),
        F.lit(window.days).alias("window_days"),
        F.lit("total_comments").alias("metric"),
        F.transform(entries, lambda e: e["body"]).alias(entries),
    )


def topics_over_time_document(series: DataFrame, window: DateWindow) -> DataFrame:
    """Nested form of ``topics_over_time``; its size is topics times days."""
    info = ["topic_rank", "topic_id", "topic_name", "window_total_comments", "window_total_views"]
    per_topic = nested(series, info, ["run_date", *SERIES], [F.col("run_date")], "series")
    body = F.struct(*info[1:], "series")
    return _window_document(
        per_topic.select(F.struct(F.col("topic_rank").alias("at"), body.alias("body")).alias("topics")),
        window, "topics",
    )


def sub_topics_over_time_document(series: DataFrame, window: DateWindow) -> DataFrame:
    """Nested form of ``sub_topics_over_time``: macro topics, sub-topics, days."""
    sub = [
        "macro_topic_id", "macro_topic_name", "sub_topic_rank", "sub_topic_id", "sub_topic_name",
        "keywords", "window_total_comments", "window_total_views",
    ]
    per_sub = nested(series, sub, ["run_date", *SERIES], [F.col("run_date")], "series")
    per_macro = nested(per_sub, ["macro_topic_id"], [*sub[3:], "series"], [F.col("sub_topic_rank")], "sub_topics")
    names = series.groupBy("macro_topic_id").agg(F.min("macro_topic_name").alias("macro_topic_name"))
    body = F.struct("macro_topic_id", "macro_topic_name", "sub_topics")
    return _window_document(
        per_macro.join(names, "macro_topic_id").select(
            F.struct(F.col("macro_topic_id").alias("at"), body.alias("body")).alias("macros")
        ),
        window, "macros",
    )


def nested_videos(rows: DataFrame, parent: list[str]) -> DataFrame:
    """Videos nested under their topic or sub-topic, in rank order."""
    fields = [c for c in rows.columns if c not in (*parent, "video_rank", "topic_rank")]
    return nested(rows, parent, fields, [F.col("video_rank")], "videos")


def nested_sub_topics(rows: DataFrame) -> DataFrame:
    """Sub-topics nested under their macro topic, in rank order."""
    names = rows.groupBy("macro_topic_id").agg(F.min("macro_topic_name").alias("macro_topic_name"))
    fields = [c for c in rows.columns if not c.startswith("macro_topic")]
    inner = nested(rows, ["macro_topic_id"], fields, [F.col("sub_topic_rank")], "sub_topics")
    return names.join(inner, "macro_topic_id")


# --- the whole set --------------------------------------------------------------------------


@dataclass
class Document:
    """One JSON document: an object of one row, or an array of rows in order."""

    rows: DataFrame
    order: tuple[str, ...] | None = None

    def write(self, *paths: str) -> None:
        if self.order is None:
            write_object(self.rows, *paths)
        else:
            hidden = [c for c in self.order if c.startswith("_")]
            write_array(self.rows, [F.col(c) for c in self.order], *paths, hidden=hidden)


def dashboard_documents(
    summary: DataFrame,
    topics: DataFrame,
    assignments: DataFrame,
    videos: DataFrame,
    channels: DataFrame,
    start=None,
    end=None,
    topic_limit: int = 6,
    generated_at: Column | None = None,
    bounds: tuple[date | None, date | None] | None = None,
) -> dict[str, Document]:
    """All documents of the dashboard by file name.

    The gold topics are read once, for the columns and dates that any document needs; what several documents share (the
    chosen topics, the day's videos with their topics) is made once. Without a summary there is no latest date: then the
    window needs both bounds, and the documents of the latest day are empty. ``bounds`` are the latest and earliest date
    where they are known already (``bounds_from_catalog``); otherwise the tables are read for them.
    """
    if bounds is None:
        latest, window = window_from_tables(summary, topics, start, end)
    else:
        latest, window = bounds[0], date_window(start or bounds[1], end, bounds[0])
    slim = stored(topics.select(*TOPIC_COLUMNS))
    day = F.lit(latest).cast("date")
    chosen = stored(top_relevant_topics(slim, window, topic_limit))
    seen = stored(_topic_videos(assignments, videos, day, CATCH_ALL_ID))
    series = topics_over_time(slim, window, topic_limit, chosen=chosen)
    shares = topic_share(slim, day)
    changes = topic_changes(slim, day)
    return {
        "latest_metadata.json": Document(metadata(summary, slim, window.days, generated_at)),
        "dashboard_summary.json": Document(summary_of_day(summary, day)),
        "relevant_topics_over_time.json": Document(topics_over_time_document(series, window)),
        "topic_share_today.json": Document(*_by(shares, "total_comments", "total_views", "topic_id")),
        "topic_changes_today.json": Document(*_by(changes, "comments_change", "views_change", "topic_id")),
        "top_topics_today.json": Document(top_topics(slim, day), ("rank",)),
        "top_videos_by_topic.json": Document(
            nested_videos(_best_of_topics(seen, chosen, 5), ["topic_rank", "topic_id", "topic_name"]).withColumnRenamed("topic_rank", "_rank"),
            ("_rank",),
        ),
        "sub_topics_over_time.json": Document(sub_topics_over_time_document(sub_topics_over_time(slim, window), window)),
        "top_sub_topics_by_macro.json": Document(nested_sub_topics(top_sub_topics_by_macro(slim, day)), ("macro_topic_id",)),
        "videos_by_sub_topic.json": Document(
            nested_videos(_best_of_sub_topics(seen, 5), ["macro_topic_id", "macro_topic_name", "sub_topic_id", "sub_topic_name"]),
            ("macro_topic_id", "sub_topic_id", "macro_topic_name", "sub_topic_name"),
        ),
        "channel_daily.json": Document(top_channels(channels, day), ("rank",)),
    }


#: What the documents read of the gold topics.
TOPIC_COLUMNS = (
    "run_date", "topic_id", "topic_name", "macro_topic_id", "macro_topic_name", "sub_topic_id", "sub_topic_name", "keywords",
    "representative_videos", "sample_comments", "videos_count", "total_views", "total_likes", "total_comments", "relevance_score",
)


def _by(rows: DataFrame, first: str, second: str, tie: str) -> tuple[DataFrame, tuple[str, ...]]:
    """Rows of a top-k in its order: two columns descending (null last), then the id."""
    return rows.withColumns({"_a": -F.col(first), "_b": -F.col(second)}).withColumns(
        {"_na": F.col("_a").isNull(), "_nb": F.col("_b").isNull()}
    ), ("_na", "_a", "_nb", "_b", tie)


def export_dashboard(documents: dict[str, Document], folders: Sequence[str]) -> list[str]:
    """Write every document to every folder; returns the file names."""
    for name, document in documents.items():
        document.write(*(f"{folder.rstrip('/')}/{name}" for folder in folders))
    return sorted(documents)
