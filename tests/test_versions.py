"""Versioned tables: readers keep what they read, untouched files stay, retries
converge, a second writer is refused; the raw table appends and resolves."""

import pytest
from pyspark.sql import functions as F

from lakeline.operators import merge, versions
from lakeline.session import scratch_path

SCHEMA = "id string, payload string, w int"
KEYS, ORDER = ["id"], ["w", "payload"]


def files(df):
    return set(df.inputFiles())


def state(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def days(spark, rows):
    return spark.createDataFrame(rows, "k int, day int, v string")


def test_a_reader_sees_whole_versions(spark):
    path = versions.create(days(spark, [(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, None, "n")]), scratch_path(spark, "v"), "day", ["k"])
    reader = versions.read(spark, path)  # planned, not run yet
    before, old = state(reader), files(reader)
    folders = versions.write_folders(days(spark, [(9, 1, "half")]), path, 2, "day", ["k"])
    assert folders and state(versions.read(spark, path)) == before  # written, not published
    versions.merge(path, days(spark, [(2, 1, "B"), (5, 1, "e"), (6, None, "m"), (4, None, "N")]), ["k", "day"], "day")
    assert state(reader) == before
    now = versions.read(spark, path)
    assert state(now) == sorted([(1, 1, "a"), (2, 1, "B"), (5, 1, "e"), (3, 2, "c"), (4, None, "N"), (6, None, "m")], key=str)
    # The untouched day is the same file; the others were written anew.
    assert len(files(now) & old) == 1 and files(now.filter("day = 2")) & old
    assert state(versions.read(spark, path, 1)) == before
    assert versions.numbers(spark, path) == [1, 2]


def test_merging_again_gives_the_same_table_and_vacuum_keeps_it(spark):
    path = versions.create(days(spark, [(1, 1, "a"), (None, 2, "x")]), scratch_path(spark, "v"), "day", ["k"])
    fresh = days(spark, [(1, 1, "A"), (None, 2, "X"), (2, 3, "b")])
    for _ in range(3):
        versions.merge(path, fresh, ["k", "day"], "day")
    want = sorted([(1, 1, "A"), (None, 2, "X"), (2, 3, "b")], key=str)
    assert state(versions.read(spark, path)) == want
    assert versions.vacuum(spark, path, keep=1) > 0 and versions.numbers(spark, path) == [4]
    assert state(versions.read(spark, path)) == want
    empty = fresh.limit(0)
    versions.merge(path, empty, ["k", "day"], "day")
    assert versions.numbers(spark, path) == [4] and state(versions.read(spark, path)) == want


def test_the_second_of_two_writers_is_refused(spark):
    path = versions.create(days(spark, [(1, 1, "a")]), scratch_path(spark, "v"), "day", ["k"])
    now = versions.latest(spark, path)
    mine = versions.Version(2, now.schema, now.folders)
    versions.publish(spark, path, mine)
    with pytest.raises(versions.Conflict):
        versions.publish(spark, path, versions.Version(2, now.schema, {}))
    assert state(versions.read(spark, path)) == [(1, 1, "a")]


def test_reading_prunes_to_the_folders_of_a_filter(spark):
    path = versions.create(spark.range(60).selectExpr("id AS k", "id % 6 AS day", "'x' AS v"), scratch_path(spark, "v"), "day", ["k"])
    plan = versions.read(spark, path).filter("day = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "ReadSchema: struct<k:bigint,v:string>" in plan


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def load(spark, path, rows, name, stamp=1):
    return merge.append_batch(path, batch(spark, rows), name, KEYS, ORDER, stamp=F.lit(stamp))


def test_a_batch_of_fresh_ids_writes_no_old_file(spark):
    path = scratch_path(spark, "raw")
    load(spark, path, [(str(i), f"p{i}", 1) for i in range(200)], "one")
    one = files(merge.read_newest(spark, path, KEYS))
    load(spark, path, [(str(i), f"p{i}", 1) for i in range(200, 260)], "two")
    both = merge.read_newest(spark, path, KEYS)
    assert one < files(both) and both.count() == 260
    assert merge.read_newest(spark, path, KEYS).columns == ["id", "payload", "w", "ingested_at_utc"]


def test_newest_batch_wins_retries_converge_and_folding_changes_nothing(spark):
    path = scratch_path(spark, "raw")
    load(spark, path, [("1", "a", 9), ("2", "b", 1), ("1", "c", 10), (None, "n", 1)], "one", 1)
    load(spark, path, [("1", "new", 2), ("3", "d", 1)], "two", 2)  # later batch, smaller w: it still wins
    want = sorted([("1", "new", 2, 2), ("2", "b", 1, 1), ("3", "d", 1, 2), (None, "n", 1, 1)], key=str)
    assert state(merge.read_newest(spark, path, KEYS)) == want
    load(spark, path, [("1", "a", 9), ("2", "b", 1), ("1", "c", 10), (None, "n", 1)], "one", 1)  # a late retry of the first
    assert state(merge.read_newest(spark, path, KEYS)) == want
    merge.compact(spark, path, KEYS)
    folded = merge.read_newest(spark, path, KEYS)
    assert state(folded) == want and len(versions.latest(spark, path).folders) == 1
    load(spark, path, [("1", "old again", 99)], "one", 3)  # folded in before: left alone
    assert state(merge.read_newest(spark, path, KEYS)) == want
    load(spark, path, [], "none")
    load(spark, path, [("2", "B", 0), (None, "N", 0)], "three", 4)
    assert files(folded) < files(merge.read_newest(spark, path, KEYS))
    assert state(merge.read_newest(spark, path, KEYS)) == sorted([("1", "new", 2, 2), ("2", "B", 0, 4), ("3", "d", 1, 2), (None, "N", 0, 4)], key=str)
    versions.vacuum(spark, path, keep=1)
    assert merge.read_newest(spark, path, KEYS).count() == 4


def test_base_is_joined_by_key_and_not_grouped(spark):
    path = scratch_path(spark, "raw")
    load(spark, path, [(str(i), "p", 1) for i in range(500)], "one")
    merge.compact(spark, path, KEYS)
    load(spark, path, [("7", "q", 1)], "two")
    plan = merge.read_newest(spark, path, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "SortAggregate" not in plan  # one batch since: nothing to resolve


def test_incremental_runs_from_the_last_loaded_day_and_keeps_rows_without_a_time(spark):
    schema = "ts timestamp_ntz, kind string, v int"

    def rows(sql):
        return spark.sql(f"SELECT cast(c1 AS timestamp_ntz) AS ts, c2 AS kind, c3 AS v FROM VALUES {sql} AS t(c1, c2, c3)").to(spark.createDataFrame([], schema).schema)

    def build(src):
        return src.groupBy(F.to_date("ts").alias("day"), "kind").agg(F.sum("v").alias("v")).withColumn("month", F.trunc("day", "month"))

    first = rows("('2024-01-02 10:00:00', 'a', 1), ('2024-01-31 10:00:00', 'a', 2), (NULL, 'a', 4)")
    every = rows("('2024-01-02 10:00:00', 'a', 1), ('2024-01-31 10:00:00', 'a', 2), ('2024-01-31 11:00:00', 'a', 8), ('2024-02-01 00:00:00', 'b', 16), (NULL, 'a', 4), (NULL, 'a', 32)")
    path = merge.incremental_load(None, first, "ts", "month", build, ["day", "kind"], "day")
    # Rows before the last loaded day are not built again: a change there is not seen.
    changed = every.withColumn("v", F.when(F.col("ts") < "2024-01-31", 1000).otherwise(F.col("v")))
    for _ in range(2):
        path = merge.incremental_load(path, changed, "ts", "month", build, ["day", "kind"], "day")
    assert state(versions.read(spark, path).drop("month")) == state(build(every).drop("month"))
