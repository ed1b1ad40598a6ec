"""Change against the previous present row of an entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, str],
    split: Column | None = None,
) -> DataFrame:
    """Add the previous row's value of each column; ``columns`` maps column to new name.

    Without ``split`` one window group holds all rows of an entity. That suits daily tables, whose
    key makes the group no longer than the number of run dates. For history without such a bound
    pass ``split``, a value that never falls along ``order`` (a month, an hour): each entity is
    then cut into pieces, and the last row of a piece is handed to the next one.
    """
    if split is None:
        spec = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({new: F.lag(old).over(spec) for old, new in columns.items()})
    return _with_previous_split(df, keys, order, columns, split)


def _with_previous_split(df, keys, order, columns, split):
    piece, carried = "_piece", "_carried"
    parts = df.withColumn(piece, split).withColumn(carried, F.lit(False))
    needed = list(dict.fromkeys([*keys, *order, *columns]))
    last = F.max_by(F.struct(*needed), F.struct(*order)).alias("_last")
    # A row per entity and piece: small against the input, and merged before its shuffle.
    ends = parts.select(*needed, piece).groupBy(*keys, piece).agg(last)
    ahead = Window.partitionBy(*keys).orderBy(F.col(piece).asc())
    handed = (
        ends.withColumn("_next", F.lead(F.struct(F.col(piece))).over(ahead))
        .where(F.col("_next").isNotNull())
        .select("_last.*", F.col(f"_next.{piece}").alias(piece), F.lit(True).alias(carried))
    )
    spec = Window.partitionBy(*keys, piece).orderBy(F.col(carried).desc(), *order)
    return (
        parts.unionByName(handed, allowMissingColumns=True)
        .withColumns({new: F.lag(old).over(spec) for old, new in columns.items()})
        .where(~F.col(carried))
        .drop(piece, carried)
    )


def with_changes(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, tuple[str, str]],
    split: Column | None = None,
) -> DataFrame:
    """Add previous value and change; ``columns`` maps column to (previous name, change name)."""
    out = with_previous(df, keys, order, {c: prev for c, (prev, _) in columns.items()}, split)
    return out.withColumns({
        change: F.col(c) - F.col(prev) for c, (prev, change) in columns.items()
    })
