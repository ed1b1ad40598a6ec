"""Silver refresh: merge the raw rows of a run date into the current tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrend.functions.dates import as_date
from snaptrend.operators.versions import has_null_key, latest_per_key, split_upsert, upsert_newer
from snaptrend.schemas import (
    CHANNELS_DAILY, CHANNELS_RAW, COMMENTS_CURRENT, COMMENTS_RAW, VIDEOS_DAILY, VIDEOS_RAW, TableSpec,
)
from snaptrend.session import checkpointed
from snaptrend.sources.snapshots import align
from snaptrend.sources.tables import create_database, create_table, replace_run_dates


def _tie(spec: TableSpec) -> list:
    """Total order among source rows of one version."""
    return [F.col(f.name) for f in spec.schema if f.name not in (*spec.key, "extracted_at")]


def merge_daily(spark: SparkSession, raw: DataFrame, database: str, spec: TableSpec, run_date: str | date) -> None:
    """Merge into a table whose key holds the run date: only that partition is read and written."""
    day = F.lit(as_date(run_date, "run_date"))
    source = align(raw.where(F.col("run_date") == day), spec.schema)
    target = spark.table(f"{database}.{spec.name}").where(F.col("run_date") == day)
    merged = upsert_newer(target.select(*source.columns), source, spec.key, tie=_tie(spec))
    # The partition is rewritten while it is read, so the result is stored first.
    replace_run_dates(checkpointed(merged), database, spec, [run_date])


#: Buckets of the index of keys, and the parts that are rewritten apart from each other; the first is a multiple of the second.
BUCKETS, PARTS = 64, 32
STATE, CURRENT, BEHIND = "index.state", "current, whole buckets", "behind"


def _part(spec: TableSpec) -> Column:
    """Part of a key, by the hash that also gives its bucket: a bucket lies in one part, as one file."""
    return F.pmod(F.hash(*spec.key), F.lit(PARTS)).alias("part")


def _index_rows(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Key, date and version of rows with a key."""
    return rows.where(~has_null_key(spec.key)).select(*spec.key, "run_date", "extracted_at", _part(spec))


def _write_index(rows: DataFrame, index: str, spec: TableSpec) -> None:
    """Replace the parts that occur in ``rows``; a task writes one bucket, so an index has as many files as buckets."""
    spark = rows.sparkSession
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        dealt = rows.repartition(BUCKETS, *spec.key).sortWithinPartitions("part", *spec.key)
        dealt.select(*spark.table(index).columns).write.insertInto(index, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)


def _mark(spark: SparkSession, index: str, state: str) -> None:
    spark.sql(f"ALTER TABLE {index} SET TBLPROPERTIES ('{STATE}' = '{state}')")


def current_keys(spark: SparkSession, database: str, spec: TableSpec) -> str:
    """Name of the index of a current table: its keys with date and version, in buckets by key.

    It is made from the table where it is missing, or where a merge has broken off before the index was up to date.
    """
    index = f"{database}.{spec.name}_keys"
    if spark.catalog.tableExists(index):
        told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {index}").collect()}
        if told.get(STATE) == CURRENT:
            return index
        spark.sql(f"DROP TABLE {index}")
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema if f.name in spec.key)
    by = ", ".join(spec.key)
    spark.sql(
        f"CREATE TABLE {index} ({keys}, run_date date, extracted_at timestamp, part int) USING parquet "
        f"PARTITIONED BY (part) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {BUCKETS} BUCKETS"
    )
    _write_index(_index_rows(spark.table(f"{database}.{spec.name}"), spec), index, spec)
    _mark(spark, index, CURRENT)
    return index


def current_changes(spark: SparkSession, source: DataFrame, database: str, spec: TableSpec) -> DataFrame:
    """Source rows that change a current table, with the date of the row each supersedes.

    They are looked up in the index: only its parts that the source touches are read, and as it lies in buckets by key, only the
    source is shuffled.
    """
    index = current_keys(spark, database, spec)
    # At most as many numbers as there are parts.
    touched = [r["part"] for r in source.select(_part(spec)).distinct().collect()]
    known = spark.table(index).where(F.col("part").isin(touched)).drop("part")
    # A key with many rows is cut to its latest before the shuffle; into as many tasks as buckets, or Spark would deal the index
    # out once more where the session uses more tasks than that.
    latest = latest_per_key(source, spec.key, [F.col("extracted_at").desc(), *_tie(spec)]).repartition(BUCKETS, *spec.key)
    return split_upsert(known, latest, spec.key, unique=True)


def merge_current(spark: SparkSession, raw: DataFrame, database: str, spec: TableSpec, run_date: str | date) -> None:
    """Merge into a table keyed without the run date: a newer row moves to the newer date.

    Only the dates that lose or gain a row are rewritten, none where nothing changes. A date that loses its last row is
    dropped. The index of keys is kept along; while it is behind the table it is marked as such.
    """
    day = as_date(run_date, "run_date")
    source = align(raw.where(F.col("run_date") == F.lit(day)), spec.schema)
    target = spark.table(f"{database}.{spec.name}").select(*source.columns)
    changes = checkpointed(current_changes(spark, source, database, spec))
    if changes.isEmpty():
        return
    index = current_keys(spark, database, spec)
    gone = changes.where(F.col("_old_date").isNotNull()).select(*spec.key, F.col("_old_date").alias("run_date"))
    # A list of calendar days, however large the table is.
    touched = sorted({day, *[r["run_date"] for r in gone.select("run_date").distinct().collect()]})
    kept = target.where(F.col("run_date").isin(touched)).join(gone, [*spec.key, "run_date"], "left_anti")
    content = checkpointed(kept.unionByName(changes.drop("_old_date")))
    newer = _index_rows(changes, spec)
    parts = [r["part"] for r in newer.select("part").distinct().collect()]
    held = spark.table(index).where(F.col("part").isin(parts)).join(newer.select(*spec.key), list(spec.key), "left_anti")
    keys = checkpointed(held.unionByName(newer))
    _mark(spark, index, BEHIND)
    replace_run_dates(content, database, spec, touched)
    _write_index(keys, index, spec)
    _mark(spark, index, CURRENT)


def refresh_silver(spark: SparkSession, raw_database: str, silver_database: str, run_date: str | date) -> None:
    """Create the silver tables if needed and merge the three raw tables of a run date."""
    create_database(spark, silver_database)
    for raw, spec in ((COMMENTS_RAW, COMMENTS_CURRENT), (VIDEOS_RAW, VIDEOS_DAILY), (CHANNELS_RAW, CHANNELS_DAILY)):
        create_table(spark, silver_database, spec)
        rows = spark.table(f"{raw_database}.{raw.name}")
        merge = merge_daily if "run_date" in spec.key else merge_current
        merge(spark, rows, silver_database, spec, run_date)
