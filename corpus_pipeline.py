"""The corpus pipeline: toxicity, line dedup, near-duplicates, benchmark leaks, mixing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrend.llm import leaks, lines, mixing, near, toxicity
from snaptrend.llm.rows import table
from snaptrend.session import checkpoint_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go; it is fitted to the labelled rows of this stage's own input."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out of the texts; every document stays."""
    kept = lines.without_repeats(docs, gone=None)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the least id."""
    return near.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written as Parquet and read again by the next.

    Every stage keeps its promises on nulls, empty texts, ties, repeats and empty tables as its operator states them.
    """
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


#: No stage but the last can be told in SQL.
ORACLE_SQL = None
