from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from snaptrend.functions.dates import date_window
from snaptrend.plans import export, topic_gold, video_topics
from snaptrend.plans.momentum import video_discovery, video_momentum

D = [date(2024, 1, d) for d in range(1, 8)]


def snapshots(spark, rows):
    data = [
        (day, v, views, likes, comments, datetime(2024, 1, 1), datetime(day.year, day.month, day.day, 5))
        for day, v, views, likes, comments in rows
    ]
    df = spark.createDataFrame(
        data, "run_date date, video_id string, view_count long, like_count long, comment_count long, "
        "published_at timestamp, extracted_at timestamp",
    )
    for c in ("video_url", "title", "channel_id", "channel_title", "description", "thumbnail_url"):
        df = df.withColumn(c, F.lit("x"))
    return df


def test_momentum_edges(spark):
    rows = snapshots(spark, [
        (D[0], "a", 0, 1, 1), (D[1], "a", 10, None, 2), (D[4], "a", 30, 5, 2),   # zero before, null, gap
        (D[0], "b", None, 0, 0), (D[1], "b", 7, 0, 0),                           # null before: dropped
        (D[0], "c", 5, 0, 0),                                                    # first only: dropped
    ])
    got = video_momentum(rows, F.lit(datetime(2024, 1, 3))).orderBy("run_date").collect()
    assert [(r.video_id, r.views_gained, r.likes_gained, r.pct_growth, r.momentum_score, r.video_age_hours) for r in got] == [
        ("a", 10, None, None, 10 + 25, 29), ("a", 20, None, 2.0, 20, 101),
    ]
    assert video_momentum(rows, F.lit(datetime(2024, 1, 5))).count() == 0


@pytest.mark.parametrize("views,gain,likes,comments,pct,momentum,want", [
    (99, 90, 0, 0, 10.0, 90, None), (100, 50, 0, 0, 1.0, 50, "hidden_gem"),
    (4999, 1, 0, 3, 0.0, 76, "hidden_gem"), (5000, 1, 0, 3, 0.5, 76, "breakout_candidate"),
    (4999, -200, 0, 5, 0.0, 0, "normal"), (400, -200, 0, 5, 0.0, 0, "conversation_driver"),
    (19999, 1, 0, 5, 0.5, 200, "breakout_candidate"), (20000, 1, 0, 5, 0.5, 200, "normal"),
    (100000, 0, 0, 0, None, 500, "normal"), (100001, 0, 0, 0, None, 500, None),
    (6000, 0, 0, 2, 0.24, 499, None), (6000, 0, 0, None, 0.25, 0, "normal"),
])
def test_discovery_bounds(spark, views, gain, likes, comments, pct, momentum, want):
    # The comment count is the number of comments gained: at 400 views five are over one in a hundred.
    row = spark.createDataFrame(
        [("v", "t", "c", "d", views, gain, comments, likes, pct, momentum, 1, comments, likes)],
        "video_id string, title string, channel_title string, description string, view_count long, views_gained long, "
        "comments_gained long, likes_gained long, pct_growth double, momentum_score long, video_age_hours long, "
        "comment_count long, like_count long",
    )
    got = [r.discovery_type for r in video_discovery(row).collect()]
    assert got == ([want] if want else [])


def topic_rows(spark, rows):
    return spark.createDataFrame(
        [(d, t, t.upper(), t, t.upper(), f"{t}__s", f"{t} s", "kw", 1, v, 0, c) for d, t, v, c in rows],
        "run_date date, topic_id string, topic_name string, macro_topic_id string, macro_topic_name string, "
        "sub_topic_id string, sub_topic_name string, keywords string, videos_count long, total_views long, "
        "total_likes long, total_comments long",
    )


@pytest.mark.parametrize("others,want", [
    ([], ["other"]), (["a"], ["other", "a"]), (["a", "b"], ["other", "b", "a"]), (["a", "b", "c"], ["c", "b", "a"]),
])
def test_catch_all_rules_differ(spark, others, want):
    rows = topic_rows(spark, [(D[0], "other", 9, 99)] + [(D[0], t, 1, i) for i, t in enumerate(others)])
    window = date_window(D[0], D[0])
    assert [r.topic_id for r in export.top_relevant_topics(rows, window).orderBy("rank").collect()] == want
    share = export.topic_share(rows, D[0]).collect()
    assert sorted(r.topic_id for r in share) == (others or ["other"])
    if sum(r.total_comments for r in share):
        assert abs(sum(r.share_of_comments for r in share) - 1) < 1e-12


def test_share_counts_topics_beyond_the_limit(spark):
    rows = topic_rows(spark, [(D[0], f"t{i:02d}", 1, 1) for i in range(20)])
    share = export.topic_share(rows, D[0], limit=10).collect()
    assert len(share) == 10 and all(abs(r.share_of_comments - 0.05) < 1e-12 for r in share)


def test_dense_series(spark):
    rows = topic_rows(spark, [(D[1], "a", 5, 5), (D[3], "a", 9, 7), (D[1], "b", 1, 1), (D[2], "c", 1, 1)])
    window = date_window(D[0], D[4])
    series = export.topics_over_time(rows, window)
    assert series.count() == 3 * 5
    got = [(r.total_comments, r.comments_change, r.views_change) for r in series.where("topic_id = 'a'").orderBy("run_date").collect()]
    assert got == [(0, 0, 0), (5, None, None), (0, 0, 0), (7, 2, 4), (0, 0, 0)]
    doc = export.topics_over_time_document(series, window).first()
    assert [t.topic_id for t in doc.topics] == ["a", "b", "c"] and len(doc.topics[0].series) == 5
    empty = export.topics_over_time_document(export.topics_over_time(rows.where("false"), window), window).first()
    assert empty.topics == [] and empty.window_days == 5
    subs = export.sub_topics_over_time(rows, window)
    nested = export.sub_topics_over_time_document(subs, window).first()
    assert [m.macro_topic_id for m in nested.macros] == ["a", "b", "c"]
    assert [s.total_comments for s in nested.macros[0].sub_topics[0].series] == [0, 5, 0, 7, 0]


def test_channel_fan_out_weighs_sums(spark):
    videos = spark.createDataFrame(
        [(D[0], "v1", "c1", "T", 10, 1, 1), (D[0], "v2", "c1", "T", 20, 1, None), (D[0], "v3", None, "N", 5, 0, 0)],
        "run_date date, video_id string, channel_id string, channel_title string, view_count long, like_count long, comment_count long",
    )
    channels = spark.createDataFrame(
        [(D[0], "c1", 7, 8, 9), (D[0], "c1", 6, 8, 9), (D[0], None, 1, 1, 1)],
        "run_date date, channel_id string, subscriber_count long, total_view_count long, total_video_count long",
    )
    got = {r.channel_id: r for r in topic_gold.channel_daily(videos, channels).collect()}
    assert (got["c1"].videos_count, got["c1"].total_views, got["c1"].subscriber_count) == (2, 60, 7)
    assert (got[None].total_views, got[None].subscriber_count) == (5, None)


def test_summary_of_an_empty_date(spark):
    videos = snapshots(spark, [(D[0], "a", 1, 1, 1)])
    channels = spark.createDataFrame([], "run_date date, channel_id string, channel_title string")
    comments = spark.createDataFrame([(D[1], "c1")], "run_date date, comment_id string")
    topics = spark.createDataFrame([], "run_date date, video_id string, macro_topic_id string, macro_topic_name string")
    rows = topic_gold.dashboard_summary(videos, channels, comments, topics, D[1]).collect()
    assert len(rows) == 1 and rows[0].videos_monitored == 0 and rows[0].comments_available == 1
    assert rows[0].top_topic_id is None and rows[0].total_views == 0
    every = topic_gold.dashboard_summary(videos, channels, comments, topics).collect()
    assert [r.run_date for r in every] == [D[0]]


def video_rows(spark, rows):
    return snapshots(spark, [(d, v, n, 0, n) for d, v, n, _ in rows]).drop("title", "description").join(
        spark.createDataFrame([(d, v, t) for d, v, _, t in rows], "run_date date, video_id string, title string"),
        ["run_date", "video_id"],
    ).withColumns({"description": F.lit(None).cast("string"), "tags": F.lit(None).cast("string"), "search_query": F.lit(None).cast("string")})


def test_video_topics_stay_stable_over_days(spark):
    titles = [
        "boletos reventa alta demanda", "boletos reventa alta demanda hoy", "boletos precio oficial taquilla",
        "boletos precio oficial taquilla ayer", "hotel lujo centro", "xyzzy plugh",
    ]
    videos = video_rows(spark, [(d, f"v{i}", i, t) for d in D[:2] for i, t in enumerate(titles)])
    comments = spark.createDataFrame(
        [(D[0], "v4", "c1", "hotel barato", 3)], "run_date date, video_id string, comment_id string, comment_text string, like_count long"
    )
    empty = spark.createDataFrame(
        [], "run_date date, macro_topic_id string, sub_topic_id string, sub_topic_name string, keywords string"
    )
    first = video_topics.video_topics(videos, comments, empty, D[0], starts=2)
    got = {r.video_id: r for r in first.collect()}
    assert len(got) == 6
    assert got["v5"].sub_topic_id == "other__otros" and got["v4"].macro_topic_id == "tourism"
    assert got["v0"].sub_topic_id == got["v1"].sub_topic_id != got["v2"].sub_topic_id == got["v3"].sub_topic_id
    assert got["v4"].sub_topic_id.startswith("tourism__hotel_lujo_centro__")
    assert got["v4"].source_text == "hotel lujo centro hotel barato"
    daily = topic_gold.topic_daily(first, videos, comments)
    second = video_topics.video_topics(videos, comments, daily, D[1], starts=2)
    again = {r.video_id: r.sub_topic_id for r in second.collect()}
    assert {v: again[v] for v in ("v0", "v2", "v5")} == {v: got[v].sub_topic_id for v in ("v0", "v2", "v5")}


def test_equal_documents_fall_back_to_their_own_phrases(spark):
    videos = video_rows(spark, [(D[0], f"v{i}", i, "boletos boletos agotados") for i in range(3)])
    none = spark.createDataFrame([], "run_date date, video_id string, comment_id string, comment_text string, like_count long")
    empty = spark.createDataFrame([], "run_date date, macro_topic_id string, sub_topic_id string, sub_topic_name string, keywords string")
    got = sorted(r.sub_topic_id for r in video_topics.video_topics(videos, none, empty, D[0]).collect())
    assert got[1:] == [f"{got[0]}_2", f"{got[0]}_3"]


def test_window_from_tables(spark):
    rows = topic_rows(spark, [(D[1], "a", 1, 1), (D[3], "a", 1, 1)])
    summary = spark.createDataFrame([(D[4],)], "run_date date")
    latest, window = export.window_from_tables(summary, rows)
    assert latest == D[4] and (window.start, window.end) == (D[1], D[4])
    with pytest.raises(ValueError):
        export.window_from_tables(summary.where("false"), rows.where("false"))
    meta = export.metadata(summary, rows, window.days).first()
    assert (meta.latest_run_date, meta.earliest_run_date, meta.days_available, meta.data_window_days) == (D[4], D[1], 2, 4)
    empty = export.metadata(summary.where("false"), rows.where("false")).first()
    assert (empty.latest_run_date, empty.days_available) == (None, 0)
