"""JDBC sinks and sources, and load reconciliation.

Writes run in parallel from the DataFrame's partitions (``numPartitions``
caps concurrent connections, ``batchsize`` sets rows per round trip);
reads of large tables split on a numeric column between bounds.  A failed
task is retried by Spark; ``replace`` makes a load re-runnable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 10_000,
               num_partitions: int | None = None, truncate: bool = True, properties: dict | None = None) -> None:
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", batchsize).option("truncate", truncate))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def create_empty(df: DataFrame, url: str, table: str) -> None:
    """Create (or replace) the target from the frame's schema, with no rows."""
    write_jdbc(df.limit(0), url, table, mode="overwrite", truncate=False)


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, properties: dict | None = None) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url)
    r = r.option("query", query) if query else r.option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """``(source_rows, target_rows, diff)`` in one row."""
    both = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        target.select(F.lit(0).alias("s"), F.lit(1).alias("t")))
    counts = both.agg(F.sum("s").cast("bigint").alias("source_rows"), F.sum("t").cast("bigint").alias("target_rows"))
    return counts.select(F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
                         F.coalesce("target_rows", F.lit(0)).alias("target_rows")).withColumn(
        "diff", F.col("source_rows") - F.col("target_rows"))
