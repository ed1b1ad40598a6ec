"""JSON documents: records with explicit nulls, UTC timestamps and plain numbers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptrend.session import checkpoint_folder, delete_folder, stored

UTC_ISO = "yyyy-MM-dd'T'HH:mm:ss"


def iso_utc(col: Column) -> Column:
    """Instant as ISO text ending in ``Z``; a fraction of a second is kept only if there is one."""
    micros = F.date_format(col, "SSSSSS")
    base = F.date_format(col, UTC_ISO)
    return F.when(micros == "000000", F.concat(base, F.lit("Z"))).otherwise(
        F.concat(base, F.lit("."), micros, F.lit("Z"))
    )


def json_ready(col: Column, dtype: T.DataType) -> Column:
    """Value as it goes into JSON: NaN is null, decimals are doubles, dates and times are text."""
    if isinstance(dtype, T.StructType):
        fields = [json_ready(col[f.name], f.dataType).alias(f.name) for f in dtype]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: json_ready(x, dtype.elementType))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    if isinstance(dtype, T.DecimalType):
        return col.cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_utc(col)
    if isinstance(dtype, T.DateType):
        return col.cast("string")
    return col


def to_records(df: DataFrame, name: str = "record") -> DataFrame:
    """One JSON object text per row, every column present even when null."""
    fields = [json_ready(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(name))


def write_records(df: DataFrame, path: str) -> None:
    """Write one JSON object per line; the rows stay distributed."""
    to_records(df, "value").write.mode("overwrite").text(path)


def write_document(df: DataFrame, path: str) -> None:
    """Write a one-row document frame as a single JSON object in a folder."""
    to_records(df, "value").coalesce(1).write.mode("overwrite").text(path)


def write_array(df: DataFrame, order: Sequence[Column], *paths: str, hidden: Sequence[str] = ()) -> None:
    """Write one JSON array, its records in the given order and one to a line, to every path.

    Columns named in ``hidden`` serve the order only.

    The records are sorted and written by many tasks, each with its bracket or comma in front; the numbered
    parts are then joined. Without rows the array is empty.
    """
    spark = df.sparkSession
    rows = stored(to_records(df.orderBy(*order).drop(*hidden), "value").withColumn("_at", F.monotonically_increasing_id()))
    first = rows.agg(F.min("_at")).first()[0]
    mark = F.when(F.col("_at") == F.lit(first), "[").otherwise(",")
    lines = rows.orderBy("_at").select(F.concat(mark, "value").alias("value"))
    _joined(spark, lines if first is not None else None, "]\n" if first is not None else "[]\n", paths)


def write_object(df: DataFrame, *paths: str) -> None:
    """Write the one row of a frame as a JSON object to every path; without a row the object is empty."""
    rows = stored(to_records(df, "value"))
    n = rows.limit(2).count()
    if n > 1:
        raise ValueError("a document has one row")
    _joined(df.sparkSession, rows if n else None, "" if n else "{}\n", paths)


def _joined(spark: SparkSession, lines: DataFrame | None, tail: str, paths: Sequence[str]) -> None:
    """Parts of a text, in the order of their numbers, and a last line as one file at every path.

    Bytes are streamed from file to file. A file is made under another name first, so that readers never see half of it.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    folder = f"{checkpoint_folder(spark)}/document-{uuid.uuid4()}"
    parts = []
    if lines is not None:
        lines.write.text(folder)
        files = hadoop.fs.Path(folder).getFileSystem(conf)
        found = files.listStatus(hadoop.fs.Path(folder))
        parts = sorted((s.getPath() for s in found if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    for path in paths:
        target = hadoop.fs.Path(path)
        fresh = hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4()}")
        there = target.getFileSystem(conf)
        there.mkdirs(target.getParent())
        out = there.create(fresh, True)
        try:
            for part in parts:
                source = files.open(part)
                try:
                    hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
                finally:
                    source.close()
            out.write(bytearray(tail.encode()))
        finally:
            out.close()
        there.delete(target, False)
        if not there.rename(fresh, target):
            raise OSError(f"cannot name {fresh} {target}")
    if lines is not None:
        delete_folder(spark, folder)
