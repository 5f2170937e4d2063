"""The streaming zone fact: equal to the batch form, late rows left out and counted, restart without change."""

from pyspark.sql import functions as F

from lakeline.operators import gold, versions
from lakeline.session import scratch_path
from lakeline.streaming import zones


def land(spark, folder, name, rows):
    sql = ", ".join(f"({'NULL' if at is None else repr(at)}, {loc}, 'zone {loc}', {minutes}D, {amount})" for at, loc, minutes, amount in rows)
    spark.sql(f"SELECT cast(c1 AS timestamp_ntz) AS pickup_ts, c2 AS pickup_location, c3 AS pickup_location_name, c4 AS trip_duration_minutes, "
              f"cast(c5 AS decimal(10,2)) AS total_amount FROM VALUES {sql} AS t(c1, c2, c3, c4, c5)").coalesce(1).write.parquet(f"{folder}/{name}")


def state(df):
    return sorted(tuple(r) for r in df.select("pickup_date", "pickup_location", "trips", "avg_trip_duration_minutes", "total_amount").collect())


def test_late_rows_are_left_out_and_counted(spark):
    folder, fact, checkpoint = (scratch_path(spark, n) for n in ("landed", "fact", "ckpt"))

    def run():
        zones.update_fact(spark, folder, fact, checkpoint, "2 days", files_per_batch=1)

    land(spark, folder, "a", [("2024-01-01 10:00:00", 1, 4, 10), ("2024-01-01 11:00:00", 1, 8, 5.5), (None, 1, 1, 1)])
    land(spark, folder, "b", [("2024-01-10 09:00:00", 2, 3, 7)])
    run()
    first = state(versions.read(spark, fact))
    # In time for an open day, a new day of an old location, and far too late.
    land(spark, folder, "c", [("2024-01-09 23:00:00", 2, 5, 1), ("2024-01-10 10:00:00", 2, 5, 3), ("2024-01-01 12:00:00", 1, 99, 99), ("2024-01-02 12:00:00", 3, 99, 99)])
    run()
    got = state(versions.read(spark, fact))
    every = spark.read.schema(zones.SCHEMA).option("recursiveFileLookup", True).parquet(folder)
    assert got == state(gold.daily_zone_fact(every.filter("pickup_ts IS NOT NULL AND trip_duration_minutes < 99")))
    assert [r for r in got if r[0].day == 1] == [r for r in first if r[0].day == 1]
    assert tuple(zones.report(spark, folder, fact).first()) == (8, 1, 5, 2)
    before = versions.numbers(spark, fact)
    run()  # nothing new: no batch, no version
    assert versions.numbers(spark, fact) == before and state(versions.read(spark, fact)) == got


def test_stream_equals_the_batch_form(spark, tables):
    from lakeline.plans import reports, streams

    folder, fact = streams.streamed_fact(tables)
    assert state(versions.read(spark, fact)) == state(gold.daily_zone_fact(reports.joined(tables)))
    assert zones.report(spark, folder, fact).first()["rows_late"] == 0
    assert versions.read(spark, fact).filter(F.col("pickup_month") != F.trunc("pickup_date", "month")).count() == 0
