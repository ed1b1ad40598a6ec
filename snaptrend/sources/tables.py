"""Catalog tables: create the layers, add columns, replace, append."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snaptrend.functions.dates import as_date
from snaptrend.schemas import TABLES, TableSpec
from snaptrend.session import delete_folder
from snaptrend.sources.snapshots import align


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def create_table(spark: SparkSession, database: str, spec: TableSpec) -> None:
    """Create one declared Parquet table, partitioned by run date where declared."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
    by = f" PARTITIONED BY ({spec.partition})" if spec.partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{spec.name} ({columns}) USING parquet{by}")


def create_layers(spark: SparkSession, databases: dict[str, str]) -> None:
    """Create databases and all declared tables; ``databases`` maps layer to database name."""
    for database in dict.fromkeys(databases.values()):
        create_database(spark, database)
    for spec in TABLES:
        if spec.layer in databases:
            create_table(spark, databases[spec.layer], spec)


def add_missing_columns(spark: SparkSession, database: str, spec: TableSpec) -> list[str]:
    """Add the declared columns a table lacks; returns their names."""
    table = f"{database}.{spec.name}"
    present = set(spark.table(table).columns)
    missing = [f for f in spec.schema if f.name not in present]
    if missing:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    return [f.name for f in missing]


def _ordered(df: DataFrame, spark: SparkSession, table: str) -> DataFrame:
    """Declared columns in the order the table stores them."""
    return df.select(*spark.table(table).columns)


def replace_table(df: DataFrame, database: str, spec: TableSpec) -> None:
    """Replace all rows of a table, keeping its declaration."""
    spark, table = df.sparkSession, f"{database}.{spec.name}"
    create_table(spark, database, spec)
    shaped = _ordered(align(df, spec.schema), spark, table)
    sort_keys = ([spec.partition] if spec.partition else []) + list(spec.cluster)
    if sort_keys:
        shaped = shaped.sortWithinPartitions(*sort_keys)
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        shaped.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)


def append_rows(df: DataFrame, database: str, spec: TableSpec) -> None:
    spark, table = df.sparkSession, f"{database}.{spec.name}"
    _ordered(align(df, spec.schema), spark, table).write.insertInto(table)


def replace_run_dates(
    df: DataFrame, database: str, spec: TableSpec, run_dates: Sequence[str | date]
) -> None:
    """Replace some run dates; a date without rows ends up empty, a row of another date is an error.

    One dynamic overwrite writes all of them, and notes in passing which dates it had rows for. It touches
    only those partitions, so the others are dropped afterwards.
    """
    spark, table = df.sparkSession, f"{database}.{spec.name}"
    days = sorted({as_date(d, "run_date") for d in run_dates})
    foreign = F.raise_error(F.concat(F.lit("run_date is not to be replaced: "), F.coalesce(F.col("run_date").cast("string"), F.lit("null"))))
    rows = align(df, spec.schema).withColumn(
        "run_date", F.when(F.col("run_date").isin(days), F.col("run_date")).otherwise(foreign.cast("date"))
    )
    seen = Observation()
    # At most as many dates as are replaced.
    rows = rows.observe(seen, F.collect_set("run_date").alias("days"))
    keys = ["run_date", *spec.cluster]
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        _ordered(rows, spark, table).sortWithinPartitions(*keys).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)
    for day in sorted(set(days) - set(seen.get["days"])):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run_date = DATE'{day}')")


def run_dates_of(spark: SparkSession, table: str) -> list[date]:
    """Run dates of a table in order, from the catalog: no file is listed or opened.

    A date that was replaced by nothing is dropped from the catalog, so every date listed was written with rows.
    """
    said = spark.sql(f"SHOW PARTITIONS {table}").collect()
    days = (r["partition"].split("/")[0].removeprefix("run_date=") for r in said)
    return sorted(date.fromisoformat(d) for d in days if d != "__HIVE_DEFAULT_PARTITION__")


# --- staged run dates -----------------------------------------------------------------------


def stage_run_date(df: DataFrame, spec: TableSpec, run_date: str | date, folder: str) -> DataFrame:
    """Write the rows of one run date to a folder of their own, seen by nobody yet; a row of another date is an error.

    Returns the rows as the table will show them.
    """
    day = as_date(run_date, "run_date")
    foreign = F.raise_error(F.concat(F.lit("run_date is not to be replaced: "), F.coalesce(F.col("run_date").cast("string"), F.lit("null"))))
    rows = align(df, spec.schema).withColumn(
        "run_date", F.when(F.col("run_date") == F.lit(day), F.col("run_date")).otherwise(foreign.cast("date"))
    )
    # The date is checked in the files' place: it is kept by the catalog alone.
    kept = rows.where(F.col("run_date").isNotNull()).drop("run_date")
    if spec.cluster:
        kept = kept.sortWithinPartitions(*spec.cluster)
    kept.write.mode("overwrite").parquet(folder)
    return staged_rows(df.sparkSession, spec, day, folder)


def staged_rows(spark: SparkSession, spec: TableSpec, day: date, folder: str) -> DataFrame:
    names = [f.name for f in spec.schema]
    inner = spec.schema.__class__([f for f in spec.schema if f.name != "run_date"])
    return spark.read.schema(inner).parquet(folder).withColumn("run_date", F.lit(day)).select(*names)


def partition_folder(spark: SparkSession, table: str, day: date) -> str | None:
    """Folder of a run date, None where the table has no such partition."""
    if spark.sql(f"SHOW PARTITIONS {table} PARTITION (run_date = DATE'{day}')").isEmpty():
        return None
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (run_date = DATE'{day}')")
    return next((r["data_type"] for r in told.collect() if r["col_name"] == "Location"), None)


def switch_run_date(spark: SparkSession, table: str, run_date: str | date, folder: str) -> str | None:
    """Let a run date of a table be what a folder holds: a change of the catalog only. Returns the former folder."""
    day = as_date(run_date, "run_date")
    former = partition_folder(spark, table, day)
    where = f"{table} PARTITION (run_date = DATE'{day}')"
    if former is None:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION (run_date = DATE'{day}') LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {where} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    return former


def discard_folder(spark: SparkSession, former: str | None, now: str) -> None:
    """Delete the former folder of a partition that has moved on."""
    path = lambda x: spark._jvm.org.apache.hadoop.fs.Path(x).toUri().getPath()
    if former is not None and path(former) != path(now):
        delete_folder(spark, former)
