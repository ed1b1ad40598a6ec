import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snaptrend import schemas
from snaptrend.plans import silver
from snaptrend.plans.silver import refresh_silver
from snaptrend.session import drop_stored, stored
from snaptrend.sources import json_sink, landed, snapshots, tables

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def videos(spark, *rows):
    data = [(str(d), v, str(n), f"{d} {h:02d}:00:00") for d, v, n, h in rows]
    return spark.createDataFrame(data, "run_date string, video_id string, view_count string, extracted_at string")


def test_snapshot_round_trip(spark, tmp_path):
    path = str(tmp_path / "videos")
    snapshots.write_snapshot(videos(spark, (D1, "a", 1, 1), (D2, "a", "oops", 1)), path, schemas.VIDEOS_RAW)
    snapshots.write_snapshot(videos(spark, (D2, "b", 5, 2)), path, schemas.VIDEOS_RAW)
    newest = snapshots.read_snapshot(spark, path, schemas.VIDEOS_RAW)
    assert [(r.video_id, r.view_count, r.run_date) for r in newest.collect()] == [("b", 5, D2)]
    assert [r.video_id for r in snapshots.read_snapshot(spark, path, schemas.VIDEOS_RAW, "2024-01-01").collect()] == ["a"]
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, path, schemas.VIDEOS_RAW, "2024-01-09")
    assert snapshots.latest_run_date_value(newest) == D2
    with pytest.raises(ValueError):
        snapshots.latest_run_date_value(newest.where("false"))


def test_coercion_gives_nulls(spark):
    rows = spark.createDataFrame([("x", "bad", "bad", "2024-13-01"), ("y", "7", "2024-01-01T10:00:00Z", "2024-01-05")],
                                 "video_id string, view_count string, published_at string, run_date string")
    got = snapshots.coerce(rows, schemas.VIDEOS_RAW.schema).collect()
    assert tuple(got[0]) == ("x", None, None, None)
    assert tuple(got[1]) == ("y", 7, datetime(2024, 1, 1, 10), date(2024, 1, 5))


def test_layers_evolution_and_replacement(spark):
    tables.create_layers(spark, {"raw": "t_raw", "silver": "t_silver", "gold": "t_gold"})
    assert spark.table("t_gold.topic_daily").count() == 0
    spark.sql("CREATE TABLE t_gold.old_topics (topic_id string, run_date date) USING parquet PARTITIONED BY (run_date)")
    spec = schemas.TableSpec("old_topics", "gold", "run_date date, topic_id string, keywords string, n bigint")
    assert tables.add_missing_columns(spark, "t_gold", spec) == ["keywords", "n"]
    assert tables.add_missing_columns(spark, "t_gold", spec) == []
    rows = spark.createDataFrame([(D1, "a"), (D2, "b")], "run_date date, topic_id string")
    tables.append_rows(rows, "t_gold", spec)
    with pytest.raises(Exception, match="not to be replaced"):
        tables.replace_run_dates(rows, "t_gold", spec, [D2])
    assert spark.table("t_gold.old_topics").count() == 2
    tables.replace_run_dates(rows.where(F.col("run_date") == D2).withColumn("topic_id", F.lit("z")), "t_gold", spec, [D2])
    assert sorted((r.topic_id, r.run_date) for r in spark.table("t_gold.old_topics").collect()) == [("a", D1), ("z", D2)]
    tables.replace_run_dates(rows.where("false"), "t_gold", spec, [D2])
    assert [r.topic_id for r in spark.table("t_gold.old_topics").collect()] == ["a"]
    tables.replace_table(rows.where("topic_id = 'b'"), "t_gold", spec)
    assert [r.topic_id for r in spark.table("t_gold.old_topics").collect()] == ["b"]


def test_silver_refresh_moves_comments_and_repeats(spark, tmp_path):
    tables.create_layers(spark, {"raw": "s_raw"})

    def load(day, hour, ids, text):
        comments = spark.createDataFrame(
            [(day, i, f"{text} {i}", datetime(day.year, day.month, day.day, hour)) for i in ids],
            "run_date date, comment_id string, comment_text string, extracted_at timestamp",
        )
        tables.replace_table(comments, "s_raw", schemas.COMMENTS_RAW)
        tables.replace_table(videos(spark, *[(day, i, hour, hour) for i in ids]), "s_raw", schemas.VIDEOS_RAW)
        channels = spark.createDataFrame(
            [(day, "ch", hour, datetime(day.year, day.month, day.day, hour))],
            "run_date date, channel_id string, subscriber_count long, extracted_at timestamp",
        )
        tables.replace_table(channels, "s_raw", schemas.CHANNELS_RAW)
        refresh_silver(spark, "s_raw", "s_silver", day)

    def state():
        return sorted((r.comment_id, r.run_date, r.comment_text) for r in spark.table("s_silver.comments_current").collect())

    load(D1, 1, ["a", "b"], "one")
    load(D1, 2, ["b"], "again")
    assert state() == [("a", D1, "one a"), ("b", D1, "again b")]
    load(D2, 1, ["a", "b", "c"], "two")
    moved = [("a", D2, "two a"), ("b", D2, "two b"), ("c", D2, "two c")]
    assert state() == moved                             # the first date lost all its rows
    refresh_silver(spark, "s_raw", "s_silver", D2)
    assert state() == moved
    daily = sorted((r.video_id, r.run_date, r.view_count) for r in spark.table("s_silver.videos_daily").collect())
    assert daily == [("a", D1, 1), ("a", D2, 1), ("b", D1, 2), ("b", D2, 1), ("c", D2, 1)]
    assert spark.table("s_silver.channels_daily").count() == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_current_keys_are_not_shuffled_and_survive_a_break(spark, monkeypatch):
    """Only the source is shuffled; an index that is behind its table is made anew."""
    spec = schemas.COMMENTS_CURRENT
    tables.create_layers(spark, {"silver": "k_silver"})

    def rows(day, ids, hour):
        return spark.createDataFrame(
            [(day, i, datetime(day.year, day.month, day.day, hour)) for i in ids], "run_date date, comment_id string, extracted_at timestamp"
        )

    def state():
        return sorted((r.comment_id, r.run_date) for r in spark.table("k_silver.comments_current").collect() if r.comment_id)

    silver.merge_current(spark, rows(D1, ["a", "b", None], 1), "k_silver", spec, D1)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for partitions in ("4", "200"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            changes = silver.current_changes(spark, snapshots.align(rows(D2, ["b", "c"], 1), spec.schema), "k_silver", spec)
            plan = plan_of(changes)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        lines = plan.splitlines()
        at = next(i for i, x in enumerate(lines) if "FileScan" in x and "comments_current_keys" in x)
        depth, above = len(lines[at]), []
        for line in reversed(lines[: at + 1]):
            indent = len(line) - len(line.lstrip(" :+-"))
            if indent < depth:
                depth = indent
                above.append(line.strip(" :+-"))
                if "SortMergeJoin" in line:
                    break
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in x for x in above), plan
        assert "PartitionFilters: [" in lines[at] and "part" in lines[at]
    good = silver._write_index
    monkeypatch.setattr(silver, "_write_index", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        silver.merge_current(spark, rows(D2, ["b", "c"], 1), "k_silver", spec, D2)
    monkeypatch.setattr(silver, "_write_index", good)
    assert state() == [("a", D1), ("b", D2), ("c", D2)]
    silver.merge_current(spark, rows(D2, ["b", "c"], 1), "k_silver", spec, D2)
    assert state() == [("a", D1), ("b", D2), ("c", D2)]
    assert sorted(r.comment_id for r in spark.table("k_silver.comments_current_keys").collect()) == ["a", "b", "c"]


def test_index_has_a_file_per_bucket_and_a_repeat_writes_nothing(spark):
    """Every bucket had a file in each of 32 parts, and a merge without a change rewrote its date."""
    spec = schemas.COMMENTS_CURRENT
    tables.create_layers(spark, {"silver": "f_silver"})
    rows = lambda hour: spark.range(3000).select(
        F.lit(D1).alias("run_date"), F.concat(F.lit("c"), "id").alias("comment_id"), F.lit(datetime(2024, 1, 1, hour)).alias("extracted_at")
    )
    files = lambda name: {r[0] for r in spark.table(name).select(F.input_file_name()).distinct().collect()}
    for hour in (1, 2):
        silver.merge_current(spark, rows(hour), "f_silver", spec, D1)
        assert len(files("f_silver.comments_current_keys")) <= silver.BUCKETS
    before = files("f_silver.comments_current"), files("f_silver.comments_current_keys")
    silver.merge_current(spark, rows(2), "f_silver", spec, D1)
    assert (files("f_silver.comments_current"), files("f_silver.comments_current_keys")) == before
    assert spark.table("f_silver.comments_current").where(F.hour("extracted_at") == 2).count() == 3000
    assert spark.table("f_silver.comments_current_keys").count() == 3000


def test_files_that_disagree(spark, tmp_path):
    """Types of all files are told; the declared table keeps its partitions; undeclared columns become text."""
    path = str(tmp_path / "in")
    one = spark.createDataFrame([(D1, "a", 1, 1.5)], "run_date date, video_id string, view_count int, other double")
    two = spark.createDataFrame([(D2, "b", "x", "y"), (D2, "c", "7", "z")], "run_date date, video_id string, view_count string, other string")
    for rows in (one, two):
        rows.write.mode("append").partitionBy("run_date").parquet(path)
    tables.create_layers(spark, {"raw": "d_raw"})
    for _ in range(2):
        told = snapshots.load_layer(spark, {"videos_raw": path}, "d_raw")
    assert snapshots.Conflict("view_count", ("int", "string"), "bigint") in told["videos_raw"]
    got = spark.table("d_raw.videos_raw")
    assert sorted((r.video_id, r.view_count, r.run_date) for r in got.collect()) == [("a", 1, D1), ("b", None, D2), ("c", 7, D2)]
    assert spark.sql("SHOW PARTITIONS d_raw.videos_raw").count() == 2
    rows, conflicts = snapshots.read_files(spark, path)
    assert {c.column: c.taken for c in conflicts} == {"view_count": "string", "other": "string"}
    assert sorted((r.view_count, r.other) for r in rows.collect()) == [("1", "1.5"), ("7", "z"), ("x", "y")]


def test_landed_edge_cases(spark, tmp_path):
    page = json.dumps({"items": [
        {"id": "v1", "snippet": {}, "statistics": {"viewCount": "0", "likeCount": ""}, "contentDetails": {"duration": "x"}},
        {"id": "v2", "snippet": {"tags": ["a", "b"]}, "contentDetails": {"duration": "PT1M"}},
    ]})
    file = tmp_path / "page.json"
    file.write_text(page)
    rows = landed.flatten_video_details(landed.read_pages(spark, str(file), page_per_file=True)).collect()
    assert [tuple(r) for r in rows] == [
        ("v1", None, None, None, None, 0, None, None), ("v2", None, "a, b", None, 60, None, None, None),
    ]
    found = json.dumps({"items": [{"id": {"kind": "channel"}}, {"id": {"videoId": "v"}, "snippet": {"title": "T"}, "extra": [1]}]})
    hits = spark.createDataFrame([("q", found), ("q", '{"items":[]}'), ("q", "{}")], "search_query string, page string")
    got = landed.flatten_search(hits).collect()
    assert len(got) == 1 and json.loads(got[0].raw_search_json)["extra"] == [1]


def test_json_values(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), Decimal("1.50"), date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), "ñ", [1.0, float("nan")]),
         (None, 2.5, None, None, datetime(2024, 1, 2, 3, 4, 5, 60), None, None)],
        "i int, f double, d decimal(5,2), day date, t timestamp, s string, l array<double>",
    )
    got = [json.loads(r.record) for r in json_sink.to_records(df).collect()]
    assert got[0] == {"i": 1, "f": None, "d": 1.5, "day": "2024-01-02", "t": "2024-01-02T03:04:05Z", "s": "ñ", "l": [1.0, None]}
    assert got[1] == {"i": None, "f": 2.5, "d": None, "day": None, "t": "2024-01-02T03:04:05.000060Z", "s": None, "l": None}


def test_json_files(spark, tmp_path):
    json_sink.write_records(spark.range(3), str(tmp_path / "rows"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "rows")).collect()) == ['{"id":0}', '{"id":1}', '{"id":2}']
    json_sink.write_document(spark.range(1), str(tmp_path / "doc"))
    assert [r.value for r in spark.read.text(str(tmp_path / "doc")).collect()] == ['{"id":0}']


def written(path):
    return path.read_text()


@pytest.mark.parametrize("parts", [1, 5])
def test_arrays_are_joined_byte_by_byte(spark, tmp_path, parts):
    rows = spark.range(40, -1, -1, numPartitions=parts).select(
        "id", F.when(F.col("id") % 2 == 0, F.concat(F.lit('é "\n'), F.col("id"))).alias("s"), (-F.col("id")).alias("_o")
    )
    paths = [tmp_path / name / "rows.json" for name in ("site", "mirror")]
    json_sink.write_array(rows, [F.col("_o")], *map(str, paths), hidden=["_o"])
    records = [{"id": i, "s": None if i % 2 else f'é "\n{i}'} for i in range(40, -1, -1)]
    said = "\n,".join(json.dumps(r, ensure_ascii=False, separators=(",", ":")) for r in records)
    assert [written(p) for p in paths] == [f"[{said}\n]\n"] * 2
    json_sink.write_array(rows.where("false"), [F.col("id")], *map(str, paths))
    assert [written(p) for p in paths] == ["[]\n"] * 2
    json_sink.write_array(rows.where("id = 3").select("id"), [F.col("id")], str(paths[0]))
    assert written(paths[0]) == '[{"id":3}\n]\n'
    assert sorted(p.name for p in paths[0].parent.iterdir() if not p.name.endswith(".crc")) == ["rows.json"]


def test_objects(spark, tmp_path):
    path = tmp_path / "one.json"
    json_sink.write_object(spark.range(1).select("id", F.lit(None).cast("string").alias("x")), str(path))
    assert written(path) == '{"id":0,"x":null}\n'
    json_sink.write_object(spark.range(0), str(path))
    assert written(path) == "{}\n"
    with pytest.raises(ValueError):
        json_sink.write_object(spark.range(2), str(path))
    assert written(path) == "{}\n"


def test_stored_tables_are_dropped(spark):
    kept = stored(spark.range(5))
    assert kept.count() == 5
    assert drop_stored(spark) >= 1 and drop_stored(spark) == 0


def test_load_tables(spark, tmp_path):
    tables.create_database(spark, "l_raw")
    for value in (1, 2):
        spark.createDataFrame([(value,)], "v int").write.mode("overwrite").parquet(str(tmp_path / "in"))
        snapshots.load_layer(spark, {"loaded": str(tmp_path / "in")}, "l_raw")
    assert [r.v for r in spark.table("l_raw.loaded").collect()] == [2]
