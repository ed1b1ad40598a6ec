"""Top-N, ranks, shares and ordered text lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrend.session import checkpointed


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, rank: str = "rank"
) -> DataFrame:
    """The first ``limit`` rows per group with their rank.

    Comparing the rank with a literal lets Spark keep ``limit`` rows per group and task before the
    shuffle, so a group holding most of the rows stays cheap.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(rank, F.row_number().over(spec)).where(F.col(rank) <= limit)
    return kept.withColumn(rank, F.col(rank).cast("bigint"))


def top_ranked(df: DataFrame, order: Sequence[Column], limit: int, rank: str = "rank") -> DataFrame:
    """The first ``limit`` rows overall with their rank.

    The limit runs first (each task keeps its own best rows), so the rank only ever sees
    ``limit`` rows.
    """
    best = df.orderBy(*order).limit(limit)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from one, for groups of any size.

    Rows are range partitioned by group and order, which cuts a large group into several tasks.
    Each part numbers its own rows and adds the sizes of the parts before it. The parts are stored
    first, so that a lost task cannot come back with other bounds. Keys are not null.
    """
    part, parts = "_part", [*keys, "_part"]
    ranged = df.repartitionByRange(df.sparkSession.sparkContext.defaultParallelism, *keys, *order)
    placed = checkpointed(ranged.withColumn(part, F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*parts).agg(F.count(F.lit(1)).alias("_size")).select(
        *parts, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    own = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
    return (
        placed.withColumn("_own", own)
        .join(offsets, parts)
        .withColumn(name, F.col("_own") + F.col("_before"))
        .drop(part, "_own", "_before")
    )


def joined_top(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    order: Sequence[Column],
    limit: int,
    separator: str,
    name: str,
) -> DataFrame:
    """Per group the first ``limit`` non-null texts in order, joined; other columns are dropped."""
    best = top_per_group(df.where(F.col(text).isNotNull()), keys, order, limit, "_rank")
    listed = F.array_sort(F.collect_list(F.struct("_rank", F.col(text).alias("_text"))))
    return best.groupBy(*keys).agg(
        F.array_join(F.transform(listed, lambda x: x["_text"]), separator).alias(name)
    )


def joined_distinct(text: str, separator: str = ", ") -> Column:
    """Aggregate: distinct non-null values in order, joined; null when there is none.

    Repeats are dropped before the shuffle; what is held per group is the text that comes out.
    """
    values = F.collect_set(text)
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), separator))


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add the share of a column's total; the total is one value from a scalar subquery."""
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value).cast("double"), total.cast("double")))


def prefer_specific(
    df: DataFrame, catch_all: Column, minimum: int = 1
) -> DataFrame:
    """Leave out catch-all rows, unless fewer than ``minimum`` other rows exist; then keep all."""
    others = df.where(~catch_all).select(F.count(F.lit(1))).scalar()
    return df.where(F.coalesce(~catch_all, F.lit(False)) | (others < minimum))


def nested(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """Group rows under their parent as an array of structs in the given order.

    Meant for rows already cut to a top-N, which bounds the array.
    """
    sort_key = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)])
    entries = F.array_sort(F.collect_list(F.struct(sort_key.alias("_o"), F.struct(*fields).alias("_v"))))
    return df.groupBy(*keys).agg(F.transform(entries, lambda e: e["_v"]).alias(name))
