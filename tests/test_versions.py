from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from snaptrend.operators.deltas import with_previous
from snaptrend.operators.versions import latest_before, latest_per_key, merge_hits, split_upsert, upsert_newer

ROW = "comment_id string, run_date date, comment_text string, extracted_at timestamp"
D1, D2 = date(2024, 1, 1), date(2024, 1, 2)
T1, T2, T3 = (datetime(2024, 1, d, 12) for d in (1, 2, 3))


def tables(spark):
    target = spark.createDataFrame([
        ("same", D1, "old", T1), ("older", D1, "old", T2), ("newer", D1, "old", T1),
        ("nullold", D1, "old", None), ("nullnew", D1, "old", T1), ("alone", D1, "old", T1), (None, D1, "old", T1),
    ], ROW)
    source = spark.createDataFrame([
        ("same", D2, "new", T1), ("older", D2, "new", T1), ("newer", D2, "new", T2), ("newer", D2, "newest", T3),
        ("nullold", D2, "new", T2), ("nullnew", D2, "new", None), ("added", D2, "new", None),
        (None, D2, "first", T1), (None, D2, "second", T2),
    ], ROW)
    return target, source


def test_upsert_rules(spark):
    target, source = tables(spark)
    got = sorted(
        [(r.comment_id or "", r.run_date, r.comment_text) for r in upsert_newer(target, source, ["comment_id"]).collect()]
    )
    assert got == sorted([
        ("same", D1, "old"), ("older", D1, "old"), ("newer", D2, "newest"), ("nullold", D1, "old"),
        ("nullnew", D1, "old"), ("alone", D1, "old"), ("added", D2, "new"), ("", D1, "old"), ("", D2, "second"),
    ])


def test_upsert_is_idempotent(spark):
    target, source = tables(spark)
    target, source = target.where("comment_id is not null"), source.where("comment_id is not null")
    once = upsert_newer(target, source, ["comment_id"])
    twice = upsert_newer(once, source, ["comment_id"])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_split_upsert_agrees(spark):
    target, source = tables(spark)
    got = sorted((r.comment_id or "", r.comment_text, r._old_date) for r in split_upsert(target, source, ["comment_id"]).collect())
    assert got == [("", "second", None), ("added", "new", None), ("newer", "newest", D1)]


def test_latest_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    best = latest_per_key(df, ["k"], [F.col("id").desc()])
    assert sorted(r.id for r in best.collect()) == [97, 98, 99]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert [r.id for r in latest_before(df, ["k"], F.lit(50), "id").orderBy("id").collect()] == [47, 48, 49]


def test_merge_hits_first_value_in_query_order(spark):
    hits = spark.createDataFrame(
        [("q2", "v", "two", None), ("q1", "v", None, "x"), ("q1", "v", None, "w"), ("q9", None, "n", "n")],
        "search_query string, video_id string, title string, tag string",
    )
    rows = merge_hits(hits).collect()
    assert [tuple(r) for r in rows] == [("v", "q1, q2", "two", "w")]


@pytest.mark.parametrize("unit", ["day", "hour", "month"])
def test_split_lag_equals_plain_lag(spark, unit):
    rows = spark.range(300).select(
        F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 2).cast("string")).alias("k"),
        (F.timestamp_seconds(F.col("id") * F.col("id") * 97 % 500000)).alias("t"), "id",
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("n"),
    )
    columns = {"n": "pn", "id": "pid"}
    plain = with_previous(rows, ["k"], ["t", "id"], columns)
    split = with_previous(rows, ["k"], ["t", "id"], columns, split=F.date_trunc(unit, "t"))
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.select(*plain.columns).collect()))


def test_top_per_group_is_cut_before_the_shuffle(spark):
    from snaptrend.operators.ranking import top_per_group

    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    best = top_per_group(df, ["k"], [F.col("id").desc()], 2)
    assert sorted((r.id, r.rank) for r in best.collect()) == [(94, 2), (95, 2), (96, 2), (97, 1), (98, 1), (99, 1)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
