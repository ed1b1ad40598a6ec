"""Files that disagree cost a look at each folder, not at each file."""

from pyspark.sql import functions as F

from snaptrend.sources import snapshots


def test_schemas_are_found_by_folder(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    rows = spark.range(200).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("run_date"))
    odd = F.day("run_date") % 2 == 1
    rows.where(odd).repartition(8).write.partitionBy("run_date").parquet(path)
    rows.where(~odd).withColumn("id", F.col("id").cast("string")).repartition(8).write.mode("append").partitionBy("run_date").parquet(path)
    # A folder whose own files disagree.
    rows.where("id < 3").withColumn("run_date", F.lit("2024-01-01")).withColumn("id", F.concat(F.lit("x"), "id")).write.mode(
        "append").partitionBy("run_date").parquet(path)
    looks = []
    parquet = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *a, **k: looks.append(a) or parquet(self, *a, **k))
    found, conflicts = snapshots.read_files(spark, path)
    files = len(snapshots._data_files(spark, path))
    assert [(c.column, c.types, c.taken) for c in conflicts] == [("id", ("bigint", "string"), "string")]
    got = sorted((r.id, str(r.run_date)) for r in found.collect())
    want = [(str(i), f"2024-01-0{i % 4 + 1}") for i in range(200)] + [(f"x{i}", "2024-01-01") for i in range(3)]
    assert got == sorted(want)
    in_one = len(snapshots._data_files(spark, f"{path}/run_date=2024-01-01"))
    # One look at the whole, one at a folder, one at each file of the odd folder, one at a group.
    assert len(looks) <= 1 + 4 + in_one + 2 < files
