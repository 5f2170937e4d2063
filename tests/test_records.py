"""The record store: whole batches or none, retries once, pushed filters, pruned columns."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakeline.session import scratch_path
from lakeline.sources import records

SCHEMA = "k bigint, at timestamp_ntz, x double, name string, amount decimal(12,2), day date, flag boolean"


@pytest.fixture(scope="module")
def rows(spark):
    records.register(spark)
    return spark.range(1000).selectExpr("id AS k", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id AS int)) AS at", "if(id % 7 = 0, NULL, id / 10.0D) AS x",
                                        "if(id % 5 = 0, NULL, concat('é', id)) AS name", "cast(id AS decimal(12,2)) / 4 AS amount", "date'2024-01-01' + cast(id div 24 AS int) AS day", "id % 2 = 0 AS flag") \
        .withColumn("amount", F.col("amount").cast("decimal(12,2)")).repartitionByRange(8, "k")


def back(spark, path):
    return records.read(spark, path, SCHEMA)


def same(a, b):
    return a.exceptAll(b).count() == 0 and a.count() == b.count()


def files(path):
    folder = path.removeprefix("file:") + "/data"
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def test_rows_come_back_whole(spark, rows):
    path = scratch_path(spark, "records")
    records.append(rows.filter("k < 400"), path, "a")
    records.append(rows.filter("k >= 400"), path, "b")
    assert same(back(spark, path), rows)
    records.append(rows.filter("k < 400"), path, "a")  # a retry
    assert same(back(spark, path), rows)
    records.append(rows.filter("k < 10"), path, "c", mode="overwrite")
    assert same(back(spark, path), rows.filter("k < 10"))
    records.append(rows.filter("k < 0"), path, "d")  # a batch without rows
    assert back(spark, path).count() == 10
    assert back(spark, scratch_path(spark, "nothing")).count() == 0


def test_a_failed_task_leaves_no_rows(spark, rows):
    path = scratch_path(spark, "records")
    records.append(rows.filter("k < 100"), path, "a")
    before = files(path)
    broken = rows.withColumn("x", F.when(F.col("k") == 990, F.raise_error(F.lit("broken row"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken row"):
        records.append(broken, path, "b")
    assert back(spark, path).count() == 100
    # What a task wrote before the failure is removed, or at least in no list.
    listed = {p["file"].removeprefix("data/") for p in records.parts(path)}
    assert listed == set(before) and listed <= set(files(path))


def test_filters_are_pushed_and_parts_pruned(spark, rows):
    path = scratch_path(spark, "records")
    records.append(rows, path, "a")
    assert len(records.parts(path)) == 8
    lo, hi = "2024-01-07 00:00:00", "2024-01-09 00:00:00"
    window = (F.col("at") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("at") < F.lit(hi).cast("timestamp_ntz"))
    got = back(spark, path).filter(window)
    assert got.rdd.getNumPartitions() == 1  # one of eight parts can hold the window
    for cond in ("k = 500", "k > 990 AND k <= 995", "x < 3.5", "name = 'é7'", "day >= date'2024-02-10'", "x IS NULL", "name IS NOT NULL AND flag", "amount > 200", "k = 5 OR k = 700", "k < 0"):
        assert same(back(spark, path).filter(cond), rows.filter(cond)), cond
    assert same(got, rows.filter(window)) and got.count() == 48
    assert back(spark, path).filter("k < 0").count() == 0


def test_least_and_greatest_values(spark):
    may = records._may_hold
    assert may([1, 5], "==", 5) and not may([1, 5], "==", 6) and not may([1, 5], ">", 5) and may([1, 5], ">=", 5) and not may([1, 5], "<", 1) and may([1, 5], "<=", 1)
    assert may(None, "==", 1) and not may([None, None], "==", 1) and may(["a", "b"], "==", 1)
    records.register(spark)
    path = scratch_path(spark, "records")
    records.append(spark.sql("SELECT 1L AS k, double('NaN') AS x UNION ALL SELECT 2L, 5D").coalesce(1), path, "a")
    (part,) = records.parts(path)
    assert part["ends"] == {"k": [1, 2]} and part["rows"] == 2 and json.dumps(part)
    assert records.read(spark, path, "k bigint, x double").filter("x > 100").count() == 1  # NaN is the greatest in Spark
