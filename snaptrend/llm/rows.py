"""Row identity and small helpers that the corpus operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrend.session import stored

#: Identity of a row: its id and a hash of its whole text. Rows equal in both count as one document.
KEYS = ("_id", "_hash")
KEY_SCHEMA = "_id bigint, _hash bigint"


def ship(name: str) -> None:
    """Send the functions of a module to executors by value, so that they need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship(__name__)

__all__ = ["KEYS", "KEY_SCHEMA", "keyed", "portions", "ship", "stored", "table", "text_of", "through_pandas"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text, null as the empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def keyed(docs: DataFrame, *columns: Column) -> DataFrame:
    """Identity of every row, with the stated columns; a null id becomes the smallest number."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("_id"),
        F.xxhash64(text_of()).alias("_hash"),
        *columns,
    )


def portions(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut into rows of about so many bytes in a column, so that few texts are Python objects at a time.

    Nothing is copied, and ids stay Arrow numbers: null ones next to any 64-bit one. A longer text goes alone.
    """
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
        upto, at = np.cumsum(size), 0
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def through_pandas(rows: DataFrame, run: Callable, schema: str, *ids: str) -> DataFrame:
    """``mapInPandas`` whose id columns, first in the result, are text in between.

    Pandas holds whole numbers next to a null one as floats, and those know only 53 bits of an id.
    """
    kinds = {f.name: f.dataType for f in rows.schema}
    told = rows.select(*(F.col(c).cast("string").alias(c) if c in ids else F.col(c) for c in rows.columns))
    found = told.mapInPandas(run, ", ".join([*(f"{c} string" for c in ids), schema]))
    return found.select(*(F.col(c).cast(kinds[c]).alias(c) if c in ids else F.col(c) for c in found.columns))
