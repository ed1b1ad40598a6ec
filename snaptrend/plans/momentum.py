"""Video momentum between snapshots, and the discovery labels built on it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrend.functions.dates import whole_hours
from snaptrend.functions.numbers import safe_divide, weighted_gain
from snaptrend.operators.deltas import with_changes

SNAPSHOT_COLUMNS = (
    "run_date", "video_id", "video_url", "title", "channel_id", "channel_title", "description",
    "thumbnail_url", "view_count", "like_count", "comment_count", "published_at", "extracted_at",
)


def video_momentum(
    videos: DataFrame,
    as_of: Column | None = None,
    fresh: str = "3 days",
    weights: tuple[int, int, int] = (1, 10, 25),
    first_run_date: Column | None = None,
    split: Column | None = None,
) -> DataFrame:
    """Growth of fresh videos against their previous snapshot; first snapshots drop out.

    The freshness filter runs before the window, so it reaches the scan. ``first_run_date`` adds
    a partition filter where the extraction window allows one. ``videos`` has one row per video
    and run date, so a window group is no longer than the number of run dates; pass ``split``
    for history that is denser than that.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    recent = videos.where(F.col("published_at") >= as_of - F.expr(f"INTERVAL {fresh}"))
    if first_run_date is not None:
        recent = recent.where(F.col("run_date") >= first_run_date)
    grown = with_changes(
        recent.select(*SNAPSHOT_COLUMNS),
        ["video_id"],
        ["extracted_at", "run_date"],
        {
            "view_count": ("previous_view_count", "views_gained"),
            "like_count": ("previous_like_count", "likes_gained"),
            "comment_count": ("previous_comment_count", "comments_gained"),
        },
        split,
    ).where(F.col("previous_view_count").isNotNull())
    gains = [F.col(c) for c in ("views_gained", "likes_gained", "comments_gained")]
    return grown.withColumns({
        "pct_growth": safe_divide(F.col("views_gained"), F.col("previous_view_count")),
        "momentum_score": weighted_gain(list(zip(gains, weights))),
        "video_age_hours": whole_hours(F.col("extracted_at"), F.col("published_at")),
        "gold_loaded_at": F.lit(as_of),
    })


@dataclass(frozen=True)
class DiscoveryLimits:
    """Bounds of the discovery filter and labels."""

    min_views: int = 100
    max_views: int = 100_000
    min_growth: float = 0.25
    min_comments: int = 3
    min_momentum: int = 500
    gem_views: int = 5_000
    breakout_views: int = 20_000
    breakout_growth: float = 0.5
    driver_comments: int = 5
    driver_rate: float = 0.01


# Labels in order of presentation; anything else comes last.
LABEL_PRIORITY = ("conversation_driver", "breakout_candidate", "hidden_gem")


def discovery_label(limits: DiscoveryLimits, comment_rate: Column) -> Column:
    views = F.col("view_count")
    return (
        F.when((views < limits.gem_views) & (F.col("momentum_score") > 0), "hidden_gem")
        .when(
            (views < limits.breakout_views) & (F.col("pct_growth") >= limits.breakout_growth),
            "breakout_candidate",
        )
        .when(
            (F.col("comments_gained") >= limits.driver_comments) & (comment_rate >= limits.driver_rate),
            "conversation_driver",
        )
        .otherwise("normal")
    )


def label_priority(label: Column) -> Column:
    chain = reduce(
        lambda acc, pair: acc.when(label == pair[1], pair[0]),
        list(enumerate(LABEL_PRIORITY, start=1))[1:],
        F.when(label == LABEL_PRIORITY[0], 1),
    )
    return chain.otherwise(len(LABEL_PRIORITY) + 1)


def video_discovery(
    momentum: DataFrame, limits: DiscoveryLimits = DiscoveryLimits(), ordered: bool = True
) -> DataFrame:
    """Candidate videos with rates and a label, in order of presentation.

    A table write does not keep row order; pass ``ordered=False`` there and save the sort.
    """
    comment_rate = safe_divide(F.col("comment_count"), F.col("view_count"))
    chosen = momentum.where(
        F.col("view_count").between(limits.min_views, limits.max_views)
        & (
            (F.col("pct_growth") >= limits.min_growth)
            | (F.col("comments_gained") >= limits.min_comments)
            | (F.col("momentum_score") >= limits.min_momentum)
        )
    )
    out = chosen.select(
        "video_id", "title", "channel_title", "description", "view_count", "views_gained",
        "comments_gained", "likes_gained", "pct_growth", "momentum_score", "video_age_hours",
        comment_rate.alias("comment_rate"),
        safe_divide(F.col("like_count"), F.col("view_count")).alias("like_rate"),
        discovery_label(limits, comment_rate).alias("discovery_type"),
    )
    if not ordered:
        return out
    return out.orderBy(
        label_priority(F.col("discovery_type")), F.col("momentum_score").desc(), F.col("video_id")
    )
