"""Session settings and lineage cutting."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle later in the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Checkpoints that nothing refers to any more are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def build_session(name: str = "snaptrend", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle rows by key into as many tasks as the session uses for shuffles.

    For steps that make many rows of one: a stated number keeps adaptive execution from merging
    tasks by the size of what goes in.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session takes a folder next to the tables of its warehouse. On a cluster that
    folder may lie on one machine, so there the setting is required.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


#: Folders written by ``stored`` and not yet deleted, by application, and by the table read from them.
_STORED: dict[str, list[str]] = {}
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage by a written table in the same folder: columns pack better than checkpointed rows.

    Lost executors read it again. It stays until ``drop_stored``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` returned, which nothing reads any more, before the others."""
    for df in tables:
        path = _FOLDERS.pop(df)
        _STORED[df.sparkSession.sparkContext.applicationId].remove(path)
        delete_folder(df.sparkSession, path)


#: Deletes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go with the query that wrote them: for many rounds whose tables are all stored."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def drop_stored(spark: SparkSession) -> int:
    """Delete the tables that this application has stored, once nothing that reads them is left; returns their number."""
    paths = _STORED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_folder(spark, path)
    return len(paths)


def delete_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
