"""The gold job: topics, totals, channels and the KPI row of run dates, one date after the other.

Sub-topic ids of a date depend on those before it, so dates run in order and hand their state on through the tables.
The four tables of a date change together: their rows are written to fresh folders, the journal notes that they are
complete, and only then is the catalog pointed at them. A run that breaks off before the note has changed nothing; one that
breaks off after it is completed by the next run of the same job, from the folders that are there.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrend.functions.dates import as_date
from snaptrend.plans import topic_gold
from snaptrend.plans.topic_gold import on_date
from snaptrend.plans.video_topics import video_topics
from snaptrend.schemas import (
    CHANNEL_DAILY, CHANNELS_DAILY, COMMENTS_CURRENT, DASHBOARD_SUMMARY_DAILY, TOPIC_DAILY, TOPIC_TRENDS_DAILY, VIDEO_TOPICS_DAILY,
    VIDEOS_DAILY, TableSpec,
)
from snaptrend.sources import tables

JOURNAL = TableSpec(
    "gold_journal", "gold", "job string, run_date date, state string, folder string, noted_at timestamp", partition=None
)
#: Tables that a date changes, in the order in which they are made.
DATED = (VIDEO_TOPICS_DAILY, TOPIC_DAILY, CHANNEL_DAILY, DASHBOARD_SUMMARY_DAILY)
STAGED, DONE, SKIPPED = "staged", "done", "skipped"


def prepare_gold(spark: SparkSession, gold: str) -> None:
    """Create the gold tables that are missing, and add the columns that older ones lack."""
    tables.create_database(spark, gold)
    for spec in (*DATED, TOPIC_TRENDS_DAILY, JOURNAL):
        tables.create_table(spark, gold, spec)
        tables.add_missing_columns(spark, gold, spec)


def journal_of(spark: SparkSession, gold: str, job: str) -> dict[date, tuple[str, str | None]]:
    """Last state and folder of every date of a job: a few rows for each date."""
    rows = spark.table(f"{gold}.{JOURNAL.name}").where(F.col("job") == job)
    last = rows.groupBy("run_date").agg(F.max_by(F.struct("state", "folder"), F.struct("noted_at", "state")).alias("last"))
    return {r["run_date"]: (r["last"]["state"], r["last"]["folder"]) for r in last.collect()}


def note(spark: SparkSession, gold: str, job: str, day: date, state: str, folder: str | None = None) -> None:
    row = spark.range(1).select(
        F.lit(job).alias("job"), F.lit(day).alias("run_date"), F.lit(state).alias("state"),
        F.lit(folder).cast("string").alias("folder"), F.current_timestamp().alias("noted_at"),
    )
    tables.append_rows(row, gold, JOURNAL)


def stage_date(
    spark: SparkSession, silver: str, gold: str, day: date, folder: str, processed_at: Column | None = None, **topics
) -> None:
    """Make all rows of a date, each table in a folder below ``folder``; later tables read the fresh rows of earlier ones."""
    videos, comments, channels = (spark.table(f"{silver}.{s.name}") for s in (VIDEOS_DAILY, COMMENTS_CURRENT, CHANNELS_DAILY))
    history = spark.table(f"{gold}.{TOPIC_DAILY.name}")

    def stage(rows: DataFrame, spec: TableSpec) -> DataFrame:
        return tables.stage_run_date(rows, spec, day, f"{folder}/{spec.name}")

    assigned = stage(video_topics(videos, comments, history, day, processed_at=processed_at, **topics), VIDEO_TOPICS_DAILY)
    stage(topic_gold.topic_daily(assigned, videos, comments, day, processed_at), TOPIC_DAILY)
    stage(topic_gold.channel_daily(videos, channels, day, processed_at), CHANNEL_DAILY)
    stage(topic_gold.dashboard_summary(videos, channels, comments, assigned, day, processed_at), DASHBOARD_SUMMARY_DAILY)


def switch_date(spark: SparkSession, gold: str, day: date, folder: str) -> list[tuple[str | None, str]]:
    """Point the four tables at the folders of a date; repeating it changes nothing. Former and present folders."""
    pairs = []
    for spec in DATED:
        now = f"{folder}/{spec.name}"
        pairs.append((tables.switch_run_date(spark, f"{gold}.{spec.name}", day, now), now))
    return pairs


def run_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    run_dates: Sequence[str | date],
    job: str | None = None,
    processed_at: Column | None = None,
    **topics,
) -> dict[date, str]:
    """Process run dates in order, then rebuild the trends once; returns what became of each date.

    A date without videos is skipped and keeps the rows it has. The first date that fails stops the run. A ``job`` that is
    run again under its name starts at its first unfinished date; without a name every date is processed.
    ``topics`` goes to the topic assignment (rules, stop words, limits).
    """
    days = sorted({as_date(d, "run_date") for d in run_dates})
    job = job or uuid.uuid4().hex
    prepare_gold(spark, gold)
    base = spark.catalog.getDatabase(gold).locationUri.rstrip("/")
    known = journal_of(spark, gold, job)
    videos = spark.table(f"{silver}.{VIDEOS_DAILY.name}")
    out = {}
    for day in days:
        state, folder = known.get(day, (None, None))
        if state in (DONE, SKIPPED):
            out[day] = state
            continue
        if state != STAGED:
            if on_date(videos, day).isEmpty():
                note(spark, gold, job, day, SKIPPED)
                out[day] = SKIPPED
                continue
            folder = f"{base}/gold_runs/{job}/{day}-{uuid.uuid4().hex}"
            stage_date(spark, silver, gold, day, folder, processed_at, **topics)
            note(spark, gold, job, day, STAGED, folder)
        moved = switch_date(spark, gold, day, folder)
        note(spark, gold, job, day, DONE, folder)
        for former, now in moved:
            tables.discard_folder(spark, former, now)
        out[day] = DONE
    rebuild_trends(spark, gold, processed_at)
    return out


def rebuild_trends(spark: SparkSession, gold: str, processed_at: Column | None = None) -> None:
    """The whole history of changes from the topic totals as they are now."""
    rows = topic_gold.topic_trends(spark.table(f"{gold}.{TOPIC_DAILY.name}"), processed_at)
    tables.replace_table(rows, gold, TOPIC_TRENDS_DAILY)
