"""File sources and sinks: Parquet, CSV, month-partitioned sets, windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """CSV with a declared schema (the default), or inferred types when asked.

    Inference costs one extra pass over the files; a declared schema with
    FAILFAST turns a malformed value into an error instead of a silent NULL.
    Large files are split by ``spark.sql.files.maxPartitionBytes``, which
    replaces the chunked reading of a single-process loader."""
    r = spark.read.option("header", header).option("mode", mode)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    """CSV with a header line and named columns (no index column exists)."""
    df.write.mode(mode).option("header", header).csv(path)
    return path


def month_columns(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})


def write_monthly(df: DataFrame, ts: str, path: str) -> str:
    """Lay out a table as one folder per (year, month).

    Range-partitioned by time first: each task writes a run of months, so
    there are about as many files as tasks and months together, not a file for
    each task and month, and a large month is split over several tasks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return write_parquet(month_columns(df.repartitionByRange(n, ts), ts), path, ["year", "month"])


def append_batches(df: DataFrame, batch: Column, path: str) -> str:
    """Append rows to a file table in batches (``batch``: a row's batch number)
    with one scan: a folder a batch, and batches that ``df`` has rows of take
    the place of their earlier load, others stay."""
    df.withColumn("batch", batch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
    return path


def read_month(spark: SparkSession, base: str, year: int, month: int) -> DataFrame:
    """One month of a monthly file set; the filter prunes folders, so only
    that month's files are listed and read."""
    return (spark.read.parquet(base)
            .filter((F.col("year") == year) & (F.col("month") == month))
            .drop("year", "month"))


def extract_window(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Records with ``start <= ts < end`` (half-open, so windows tile)."""
    lo = F.lit(_ts(start)).cast("timestamp_ntz")
    hi = F.lit(_ts(end)).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


def capped(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in a total order (a capped load)."""
    return df.orderBy(*order).limit(n)


def _ts(v) -> str:
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    return str(v)
