"""The daily zone fact as a streaming aggregate.

Trip files arrive in a folder; each micro-batch updates the (day, location)
groups it touches in the state store and merges these groups into the fact, a
versioned table by month.  The watermark bounds the state: a group whose day
is further back than the greatest pickup time seen less ``delay`` is closed and
forgotten, and rows that still come for it are late and left out (``report``
counts them).  A retried micro-batch finds the same state and merges the same
groups, so the fact converges; readers see whole versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline.functions.exprs import cents
from lakeline.operators import versions

KEYS = ["pickup_date", "pickup_location", "pickup_location_name"]
SCHEMA = T.StructType([T.StructField("pickup_ts", T.TimestampNTZType()), T.StructField("pickup_location", T.IntegerType()),
                       T.StructField("pickup_location_name", T.StringType()), T.StructField("trip_duration_minutes", T.DoubleType()),
                       T.StructField("total_amount", T.DecimalType(10, 2))])


def update_fact(spark: SparkSession, source_dir: str, fact: str, checkpoint: str, delay: str, files_per_batch: int = 8) -> None:
    """Bring ``fact`` up to date with the files in ``source_dir`` and stop.

    ``delay`` is how far back, against the newest trip seen, a trip may still
    come: at least the time span that files of one arrival cover."""
    trips = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).parquet(source_dir)
    day = F.window("at", "1 day")
    groups = trips.withColumn("at", F.col("pickup_ts").cast("timestamp")).withWatermark("at", delay) \
        .groupBy(day.alias("day"), "pickup_location", "pickup_location_name") \
        .agg(F.count(F.lit(1)).alias("trips"), F.avg("trip_duration_minutes").alias("mean"), F.sum("total_amount").alias("total"))
    updated = groups.select(
        F.col("day.start").cast("timestamp_ntz").cast("date").alias("pickup_date"), "pickup_location", "pickup_location_name", "trips",
        F.round("mean", 6).alias("avg_trip_duration_minutes"), cents("total").alias("total_amount"))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        versions.merge(fact, batch.withColumn("pickup_month", F.trunc("pickup_date", "month")), KEYS, "pickup_month")

    q = (updated.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def report(spark: SparkSession, source_dir: str, fact: str) -> DataFrame:
    """One row: rows that came, rows without a time, rows in the fact, and late
    rows, which are the rest."""
    came = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(source_dir) \
        .agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("pickup_ts").isNull()).alias("rows_without_time"))
    held = versions.read(spark, fact).agg(F.coalesce(F.sum("trips"), F.lit(0)).cast("bigint").alias("rows_in_fact"))
    return came.join(held).select("*", (F.col("rows_in") - F.col("rows_without_time") - F.col("rows_in_fact")).alias("rows_late"))  # one row each
