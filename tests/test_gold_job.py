"""The gold job over dates: all or nothing, resumed, empty dates kept; and the set of documents."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from snaptrend import schemas
from snaptrend.plans import export, gold_job
from snaptrend.sources import tables

DAYS = [date(2024, 1, d) for d in (1, 2, 3)]
EMPTY = DAYS[1]


def plain_topics(videos, comments, topics, day, processed_at=None, **options):
    """Every video in one topic: enough where the job matters, not what it says."""
    named = {"macro_topic_id": "m", "topic_id": "m", "sub_topic_id": "m__s", "sub_topic_name": "s"}
    rows = videos.where(F.col("run_date") == F.lit(day)).select("run_date", "video_id")
    return rows.withColumns({k: F.lit(v) for k, v in named.items()})


@pytest.fixture
def layers(spark, request):
    """Silver tables with videos on two of three days, gold tables with an older row on the empty one."""
    silver, gold = (f"{layer}_{abs(hash(request.node.name)) % 10**8}" for layer in ("s", "g"))
    for database in (silver, gold):
        tables.create_database(spark, database)
    videos = spark.createDataFrame(
        [(day, f"v{i}", f"title {i}", "boletos de concierto" if i < 2 else "estadio y boletos", f"c{i}", f"C{i}", 10 * i + day.day, i, 1)
         for day in DAYS if day != EMPTY for i in range(3)],
        "run_date date, video_id string, title string, description string, channel_id string, channel_title string, "
        "view_count long, comment_count long, like_count long",
    )
    comments = spark.createDataFrame(
        [(DAYS[0], "v1", "k1", None, 5)], "run_date date, video_id string, comment_id string, comment_text string, like_count long"
    )
    channels = spark.createDataFrame(
        [(day, "c1", "C1", 100) for day in DAYS], "run_date date, channel_id string, channel_title string, subscriber_count long"
    )
    for rows, spec in ((videos, schemas.VIDEOS_DAILY), (comments, schemas.COMMENTS_CURRENT), (channels, schemas.CHANNELS_DAILY)):
        tables.create_table(spark, silver, spec)
        tables.append_rows(rows, silver, spec)
    gold_job.prepare_gold(spark, gold)
    for spec in gold_job.DATED:
        tables.append_rows(spark.range(1).select(F.lit(EMPTY).alias("run_date")), gold, spec)
    yield silver, gold
    for database in (silver, gold):
        spark.sql(f"DROP DATABASE {database} CASCADE")


def counts(spark, gold):
    return {
        spec.name: {r["run_date"]: r["count"] for r in spark.table(f"{gold}.{spec.name}").groupBy("run_date").count().collect()}
        for spec in gold_job.DATED
    }


def test_dates_in_order_and_an_empty_one(spark, layers, monkeypatch):
    silver, gold = layers
    got = gold_job.run_gold(spark, silver, gold, reversed(DAYS), starts=1)
    assert list(got.items()) == [(d, "skipped" if d == EMPTY else "done") for d in DAYS]
    found = counts(spark, gold)
    assert found["video_topics_daily"] == {DAYS[0]: 3, EMPTY: 1, DAYS[2]: 3}
    assert found["dashboard_summary_daily"] == dict.fromkeys(DAYS, 1)
    assert found["channel_daily"][DAYS[2]] == 3
    ids = spark.table(f"{gold}.video_topics_daily").where("video_id is not null").groupBy("video_id").agg(
        F.count_distinct("sub_topic_id").alias("n")
    )
    assert {r["n"] for r in ids.collect()} == {1}
    trends = spark.table(f"{gold}.topic_trends_daily").where(F.col("run_date") == F.lit(DAYS[2]))
    assert all(r["videos_count_change"] == 0 for r in trends.collect())
    # Again: the date is replaced, and the folder of the first run is gone.
    before = tables.partition_folder(spark, f"{gold}.video_topics_daily", DAYS[0])
    monkeypatch.setattr(gold_job, "video_topics", plain_topics)
    gold_job.run_gold(spark, silver, gold, DAYS[:1])
    after = tables.partition_folder(spark, f"{gold}.video_topics_daily", DAYS[0])
    assert before != after and counts(spark, gold)["video_topics_daily"] == found["video_topics_daily"]
    path = spark._jvm.org.apache.hadoop.fs.Path(before)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    # The other ways to write a table still work on such a date.
    tables.replace_run_dates(spark.table(f"{gold}.topic_daily").where("false"), gold, schemas.TOPIC_DAILY, DAYS[:1])
    assert DAYS[0] not in counts(spark, gold)["topic_daily"]


def test_a_failing_date_changes_nothing_and_the_job_goes_on_there(spark, layers, monkeypatch):
    silver, gold = layers
    monkeypatch.setattr(gold_job, "video_topics", plain_topics)
    good = gold_job.topic_gold.dashboard_summary

    def fail(*args, **kwargs):
        if args[4] == DAYS[2]:
            raise RuntimeError("no summary")
        return good(*args, **kwargs)

    monkeypatch.setattr(gold_job.topic_gold, "dashboard_summary", fail)
    with pytest.raises(RuntimeError):
        gold_job.run_gold(spark, silver, gold, DAYS, job="j")
    # Three tables of the last date were made already, but nothing of them is seen.
    assert all(set(x) == {DAYS[0], EMPTY} for x in counts(spark, gold).values())
    monkeypatch.setattr(gold_job.topic_gold, "dashboard_summary", good)
    made = []
    stage = gold_job.stage_date
    monkeypatch.setattr(gold_job, "stage_date", lambda *a, **k: (made.append(a[3]), stage(*a, **k)))
    # Broken off between two tables of the catalog: completed from the folders that are there.
    switch = gold_job.tables.switch_run_date
    seen = []

    def break_off(spark, table, day, folder):
        if day == DAYS[2] and "channel_daily" in table and not seen:
            seen.append(day)
            raise RuntimeError("lost")
        return switch(spark, table, day, folder)

    monkeypatch.setattr(gold_job.tables, "switch_run_date", break_off)
    with pytest.raises(RuntimeError):
        gold_job.run_gold(spark, silver, gold, DAYS, job="j")
    got = gold_job.run_gold(spark, silver, gold, DAYS, job="j")
    assert made == [DAYS[2]] and got[EMPTY] == "skipped"
    assert all(set(x) == set(DAYS) for x in counts(spark, gold).values())


def test_staged_rows_of_another_date_are_an_error(spark, tmp_path):
    rows = spark.createDataFrame([(DAYS[0], "c")], "run_date date, channel_id string")
    with pytest.raises(Exception, match="not to be replaced"):
        tables.stage_run_date(rows, schemas.CHANNEL_DAILY, DAYS[1], str(tmp_path / "x"))


def test_bounds_come_from_the_catalog(spark, tmp_path):
    """No file of the tables is there to be read."""
    tables.create_database(spark, "b_gold")
    for spec, days in ((schemas.DASHBOARD_SUMMARY_DAILY, DAYS[1:]), (schemas.TOPIC_DAILY, DAYS)):
        tables.create_table(spark, "b_gold", spec)
        for day in days:
            tables.switch_run_date(spark, f"b_gold.{spec.name}", day, str(tmp_path / "nowhere" / spec.name))
    names = ("b_gold.dashboard_summary_daily", "b_gold.topic_daily")
    assert export.bounds_from_catalog(spark, *names) == (DAYS[2], DAYS[0])
    assert tables.run_dates_of(spark, names[0]) == DAYS[1:]
    tables.create_table(spark, "b_gold", schemas.CHANNEL_DAILY)
    assert export.bounds_from_catalog(spark, "b_gold.channel_daily", "b_gold.channel_daily") == (None, None)


def test_documents_without_any_rows(spark, tmp_path):
    nothing = lambda spec: spark.createDataFrame([], spec.schema)
    frames = [nothing(s) for s in (schemas.DASHBOARD_SUMMARY_DAILY, schemas.TOPIC_DAILY, schemas.VIDEO_TOPICS_DAILY, schemas.VIDEOS_DAILY, schemas.CHANNEL_DAILY)]
    with pytest.raises(ValueError):
        export.dashboard_documents(*frames)
    with pytest.raises(ValueError):
        export.dashboard_documents(*frames, bounds=(None, None))
    documents = export.dashboard_documents(*frames, "2024-01-01", "2024-01-02")
    names = export.export_dashboard(documents, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert len(names) == 11
    for name in names:
        said = [(tmp_path / side / name).read_text() for side in "ab"]
        assert said[0] == said[1]
        found = json.loads(said[0])
        if name == "dashboard_summary.json":
            assert found == {}
        elif name == "latest_metadata.json":
            assert found["days_available"] == 0 and found["latest_run_date"] is None and found["data_window_days"] == 2
        elif name.endswith("over_time.json"):
            assert found["dates"] == ["2024-01-01", "2024-01-02"] and found.get("topics", found.get("macros")) == []
        else:
            assert found == []
