"""Versions of a row: latest per key, newer-wins upsert, merged hits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str = "_version_rank"
) -> DataFrame:
    """The first row per key in the given order.

    The rank is compared with a literal, so every task keeps one row per key before the shuffle
    and a hot key sends one row per task.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(spec)).where(F.col(rank) == 1).drop(rank)


def latest_before(
    df: DataFrame, keys: Sequence[str], before: Column, date_column: str = "run_date", tie: Sequence[Column] = ()
) -> DataFrame:
    """Latest row per key strictly before a date."""
    earlier = df.where(F.col(date_column) < before)
    return latest_per_key(earlier, keys, [F.col(date_column).desc(), *tie])


def has_null_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def upsert_newer(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    version: str = "extracted_at",
    tie: Sequence[Column] = (),
) -> DataFrame:
    """Target after merging the source: a strictly newer version wins, unknown keys are added.

    The source is first cut to its latest version per key. A target row stays when either
    version is null or the versions are equal. A key with a null part matches nothing: those rows
    come out of the outer join as they are, spread by a hash of the row so that they cannot pile up in
    one task. Each input is read once.
    """
    columns = target.columns
    incoming = latest_per_key(source.select(*columns), keys, [F.col(version).desc(), *tie])
    old = target.select(*keys, _salt(target, keys), F.struct(*columns).alias("_old"))
    new = incoming.select(*keys, _salt(incoming, keys), F.struct(*columns).alias("_new"))
    take_new = F.col("_old").isNull() | (F.col(f"_new.{version}") > F.col(f"_old.{version}"))
    return (
        old.join(new, [*keys, "_salt"], "full_outer")
        .select(F.when(take_new, F.col("_new")).otherwise(F.col("_old")).alias("_row"))
        .select("_row.*")
    )


def _salt(df: DataFrame, keys: Sequence[str]) -> Column:
    """Zero for a whole key; a hash of the row where a part of the key is null, which spreads such rows."""
    hashed = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.when(has_null_key(keys), F.xxhash64(*hashed)).otherwise(F.lit(0).cast("bigint")).alias("_salt")


def split_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    version: str = "extracted_at",
    date_column: str = "run_date",
    tie: Sequence[Column] = (),
    unique: bool = False,
) -> DataFrame:
    """Source rows that change the target, with the date of the row each one supersedes.

    Reads only key, version and date of the target, so that a table writer can rewrite just the
    dates that lose or gain a row. ``_old_date`` is null for an added key. The source is first cut to its latest
    version per key, unless it is ``unique`` already.
    """
    incoming = source if unique else latest_per_key(source, keys, [F.col(version).desc(), *tie])
    no_key = has_null_key(keys)
    known = target.where(~no_key).select(
        *keys,
        F.col(date_column).alias("_old_date"),
        F.col(version).alias("_old_version"),
        F.lit(True).alias("_known"),
    )
    matched = incoming.where(~no_key).join(known, list(keys), "left")
    changed = matched.where(F.col("_known").isNull() | (F.col(version) > F.col("_old_version")))
    added = incoming.where(no_key).withColumn("_old_date", F.lit(None).cast("date"))
    return changed.drop("_old_version", "_known").unionByName(added)


def merge_hits(hits: DataFrame, key: str = "video_id", query: str = "search_query") -> DataFrame:
    """One row per key found by several queries.

    The queries are joined in order; every other column is its first non-null value in query
    order. All of it is aggregation, so tasks merge their own hits before the shuffle. The set per
    key holds distinct queries, of which a run has a few.
    """
    others = [c for c in hits.columns if c not in (key, query)]
    firsts = [
        # A value found twice by one query ties on the query; the smaller value decides.
        F.min(F.when(F.col(c).isNotNull(), F.struct(query, c)))[c].alias(c) for c in others
    ]
    joined = F.array_join(F.array_sort(F.collect_set(query)), ", ").alias(query)
    return hits.where(F.col(key).isNotNull()).groupBy(key).agg(joined, *firsts)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Drop duplicates on a key, keeping the first row of a stated order (null keys are equal)."""
    return latest_per_key(df, keys, order)
