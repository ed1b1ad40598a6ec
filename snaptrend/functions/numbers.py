"""Null-safe arithmetic and the scores built from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(num: Column, den: Column) -> Column:
    """``num / den`` as double, null where ``den`` is zero or either side is null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def weighted_gain(gains_and_weights: list[tuple[Column, int]]) -> Column:
    """Momentum: weighted sum of gains in which a null gain counts as zero."""
    terms = [F.coalesce(g, F.lit(0)) * F.lit(w) for g, w in gains_and_weights]
    return reduce(lambda a, b: a + b, terms)


def relevance_score(comments: Column, views: Column, videos: Column) -> Column:
    """Topic relevance: comments + views per thousand + five per video, as double."""
    return comments.cast("double") + safe_divide(views, F.lit(1000)) + videos * F.lit(5)


def counter(col: Column) -> Column:
    """Text counter to bigint: missing, empty or unreadable gives null, "0" gives 0."""
    return F.nullif(F.trim(col.cast("string")), F.lit("")).try_cast("bigint")
