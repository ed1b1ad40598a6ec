"""Typed snapshots by run date: coercion, reading and writing."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptrend.functions.dates import as_date
from snaptrend.schemas import TableSpec


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every declared column that is present; a value that does not fit becomes null."""
    declared = {field.name: field.dataType for field in schema}
    return df.select([
        _coerced(df, name, declared[name]).alias(name) if name in declared else F.col(name)
        for name in df.columns
    ])


def _coerced(df: DataFrame, name: str, target: T.DataType) -> Column:
    col = F.col(name)
    if df.schema[name].dataType == target:
        return col
    text = F.nullif(F.trim(col.cast("string")), F.lit(""))
    if isinstance(target, T.TimestampType):
        return text.try_cast("timestamp")
    if isinstance(target, T.DateType):
        return F.to_date(text.try_cast("timestamp"))
    if isinstance(target, (T.LongType, T.DoubleType)):
        return text.try_cast(target)
    return col.cast(target)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns in declared order; an absent one is a typed null."""
    present = set(df.columns)
    return coerce(df, schema).select([
        F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def write_snapshot(df: DataFrame, path: str, spec: TableSpec) -> None:
    """Write the run dates found in ``df``, replacing those partitions only."""
    shaped = align(df, spec.schema)
    if spec.partition:
        # Every task writes its own files, sorted so that readers can skip blocks by cluster key.
        shaped = shaped.sortWithinPartitions(spec.partition, *spec.cluster)
    elif spec.cluster:
        shaped = shaped.sortWithinPartitions(*spec.cluster)
    writer = shaped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if spec.partition:
        writer = writer.partitionBy(spec.partition)
    writer.parquet(path)


def run_dates(spark: SparkSession, path: str, column: str = "run_date") -> list[date]:
    """Run dates of a partitioned snapshot, from the names of its folders: one listing, no file is opened."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
    found = (n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))
    return sorted(date.fromisoformat(n) for n in found if n != "__HIVE_DEFAULT_PARTITION__")


def read_snapshot(
    spark: SparkSession, path: str, spec: TableSpec, run_date: str | date | None = None
) -> DataFrame:
    """Snapshot of one run date, or the newest when none is given; a missing date is an error.

    Only the folder of the chosen date is listed and read.
    """
    present = run_dates(spark, path)
    day = as_date(run_date, "run_date") if run_date is not None else max(present, default=None)
    if day not in present:
        raise FileNotFoundError(f"no snapshot for run_date {run_date or '(newest)'} in {path}")
    return spark.read.schema(spec.schema).option("basePath", path).parquet(f"{path.rstrip('/')}/run_date={day}")


def latest_run_date(df: DataFrame, column: str = "run_date") -> Column:
    """Newest run date as a scalar subquery, evaluated when the plan runs."""
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    return df.select(F.max(column)).scalar()


def latest_run_date_value(df: DataFrame, column: str = "run_date") -> date:
    """Newest run date as a value; no rows is an error."""
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    value = df.agg(F.max(column)).first()[0]
    if value is None:
        raise ValueError(f"no {column} in an empty frame")
    return value


@dataclass(frozen=True)
class Conflict:
    """A column that has different types in different files, and the type that it gets."""

    column: str
    types: tuple[str, ...]
    taken: str


def read_files(spark: SparkSession, path: str, schema: T.StructType | None = None) -> tuple[DataFrame, list[Conflict]]:
    """Rows of all Parquet files below a path under one schema, and the columns on which the files disagree.

    A column that some files lack is null there. Where types differ, the declared one is taken, else text; values that
    do not fit become null. Files that agree, the usual case, are one read; others are read by groups of equal schema.
    """
    base = path.rstrip("/")
    try:
        return _as(spark.read.option("mergeSchema", "true").parquet(base), schema), []
    except AnalysisException as error:
        merged = error
    except Exception as error:  # the merge runs as a job, whose error Spark does not translate
        if "merge" not in str(error).lower():
            raise
        merged = error
    reader = spark.read.option("basePath", base)
    groups = _by_schema(reader, _data_files(spark, base))
    if len(groups) < 2:
        raise merged
    found: dict[str, set[str]] = {}
    for text in groups:
        for field in T.StructType.fromJson(json.loads(text)):
            found.setdefault(field.name, set()).add(field.dataType.simpleString())
    declared = {f.name: f.dataType.simpleString() for f in schema or ()}
    conflicts = [
        Conflict(name, tuple(sorted(kinds)), declared.get(name, "string")) for name, kinds in found.items() if len(kinds) > 1
    ]
    told = {c.column: c.taken for c in conflicts}
    parts = []
    for text, files in groups.items():
        part = reader.schema(T.StructType.fromJson(json.loads(text))).parquet(*files)
        wanted = T.StructType([T.StructField(n, T.StructType.fromDDL(f"x {k}")[0].dataType) for n, k in told.items()])
        parts.append(_as(coerce(part, wanted), schema))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), conflicts


def _by_schema(reader: DataFrameReader, files: Sequence[str]) -> dict[str, list[str]]:
    """Files by schema, as JSON. Footers only: those of a folder are merged in one job, and read one by one where they disagree."""
    folders: dict[str, list[str]] = {}
    for file in sorted(files):
        folders.setdefault(file.rpartition("/")[0], []).append(file)
    groups: dict[str, list[str]] = {}
    for inside in folders.values():
        try:
            groups.setdefault(reader.option("mergeSchema", "true").parquet(*inside).schema.json(), []).extend(inside)
        except Exception as error:  # as above
            if "merge" not in str(error).lower():
                raise
            for file in inside:
                groups.setdefault(reader.option("mergeSchema", "false").parquet(file).schema.json(), []).append(file)
    return groups


def _as(rows: DataFrame, schema: T.StructType | None) -> DataFrame:
    return rows if schema is None else align(rows, schema)


def _data_files(spark: SparkSession, path: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(where, True)
    found = []
    while listed.hasNext():
        file = listed.next().getPath()
        if not file.getName().startswith(("_", ".")):
            found.append(file.toString())
    return found


def load_table(spark: SparkSession, path: str, table: str, mode: str = "overwrite") -> list[Conflict]:
    """Load Parquet files into a table, by default replacing all of it.

    A table that is there keeps its declaration: columns, types and partitions. Otherwise it is made as the files are.
    """
    if not spark.catalog.tableExists(table):
        rows, conflicts = read_files(spark, path)
        rows.write.mode(mode).saveAsTable(table)
        return conflicts
    rows, conflicts = read_files(spark, path, spark.table(table).schema)
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        rows.write.insertInto(table, overwrite=mode == "overwrite")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)
    return conflicts


def load_layer(spark: SparkSession, sources: dict[str, str], database: str) -> dict[str, list[Conflict]]:
    """Load every ``table -> path`` pair into a database, each table replaced as a whole; conflicts of each."""
    return {table: load_table(spark, path, f"{database}.{table}") for table, path in sources.items()}
