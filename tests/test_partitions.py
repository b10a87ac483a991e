"""Stored tables changed in place: files of untouched partitions stay, a failed run leaves the old rows."""

import os

import pytest
from pyspark.sql import functions as F

from brightledger.session import scratch_path
from brightledger.sources import partitions


def files_of(path):
    found = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                at = os.path.join(folder, n)
                found.setdefault(os.path.basename(folder), set()).add((n, os.stat(at).st_mtime_ns))
    return found


@pytest.fixture
def stored(spark):
    path = scratch_path(spark, "stored")
    rows = spark.range(300).select("id", (F.col("id") % 7).cast("int").alias("v"), F.expr("CASE WHEN id < 290 THEN id div 100 END").cast("int").alias("part"))
    rows.repartition(3).write.partitionBy("part").parquet(path)
    return path


def read(spark, path):
    return {r["id"]: (r["v"], r["part"]) for r in spark.read.parquet(path).collect()}


def test_update_writes_touched_partitions_only(spark, stored):
    before, old = files_of(stored), read(spark, stored)
    changes = spark.createDataFrame([(5, 70), (17, 71), (295, 72), (999, 73)], "id bigint, v int")
    assert partitions.update_in_place(spark, stored, changes, ["id"], ["v"], "part") == 2
    after = files_of(stored)
    assert after["part=1"] == before["part=1"] and after["part=2"] == before["part=2"]
    assert not after["part=0"] & before["part=0"]
    assert read(spark, stored) == {**old, 5: (70, 0), 17: (71, 0), 295: (72, None)}
    assert partitions.update_in_place(spark, stored, changes.filter("id = 999"), ["id"], ["v"], "part") == 0
    assert files_of(stored) == after
    for column in ("part", "other"):
        with pytest.raises(ValueError):
            partitions.update_in_place(spark, stored, changes.withColumn(column, F.lit(1)), ["id"], [column], "part")


def test_a_failed_run_leaves_the_old_rows(spark, stored):
    before = files_of(stored)
    bad = spark.read.parquet(stored).withColumn("v", F.when(F.col("id") == 299, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.lit(1)))
    with pytest.raises(Exception, match="stop"):
        partitions.overwrite_partitions(bad, stored, "part")
    assert files_of(stored) == before


def test_expiry_touches_old_days_only(spark):
    path = scratch_path(spark, "days")
    rows = spark.range(96).select("id", (F.lit("2024-03-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"))
    rows.union(spark.createDataFrame([(1000, None)], rows.schema)).withColumn("day", F.to_date("timestamp")).write.partitionBy("day").parquet(path)
    before = files_of(path)
    as_of = F.lit("2024-03-03 06:00:00").cast("timestamp")
    assert partitions.expire_in_place(spark, path, as_of) == 2
    assert {r["id"] for r in spark.read.parquet(path).collect()} == set(range(31, 96)) | {1000}
    after = files_of(path)
    assert "day=2024-03-01" not in after and not after["day=2024-03-02"] & before["day=2024-03-02"]
    assert all(after[d] == before[d] for d in after if d != "day=2024-03-02")
    assert partitions.expire_in_place(spark, path, as_of) == 0 and files_of(path) == after
    # the limit is the last moment of a day: the whole day goes
    assert partitions.expire_in_place(spark, path, F.lit("2024-03-03 23:00:00").cast("timestamp")) == 1
    assert {r["id"] for r in spark.read.parquet(path).collect()} == set(range(48, 96)) | {1000}
