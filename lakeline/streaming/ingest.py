"""Incremental ingest as a Structured Streaming query.

A single-process loader reads a file and appends it in chunks; here new
files arriving in a folder are the chunks.  Each micro-batch is wrapped in
the raw envelope and appended to the raw table as a batch of its own, named by
its first and last file time, so no earlier file is written again; the newest
row of an id is found at read time (``merge.read_newest``).  A batch retried
after a failure takes its own place, and the stream checkpoint makes the run
restartable after a lost executor or driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline.operators import merge, versions

_FILE = "__file"


def upsert_stream(spark: SparkSession, source_dir: str, schema: T.StructType | str, id_col: str, ts_col: str,
                  target: str, checkpoint: str, files_per_batch: int = 1, compact_after: int = 16) -> None:
    """Run the stream over all files present now (``availableNow``) and stop.

    Each micro-batch becomes a folder of the raw table in ``target``; read it
    with ``merge.read_newest``.  A batch is named by the files it holds, so a
    retried one (same checkpoint or a fresh one) takes the place of its first
    load.  ``compact_after`` batches at a time are folded into the base."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .option("recursiveFileLookup", True).parquet(source_dir)
              .select("*", F.col("_metadata.file_path").alias(_FILE)))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # Min and max name the batch: files are taken whole, in order of arrival.
        bounds = batch.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi"), F.min(_FILE).alias("first"), F.max(_FILE).alias("last"),
                           F.count(F.lit(1)).alias("rows")).first()
        if not bounds["rows"]:
            return
        env = merge.envelope(batch.drop(_FILE), id_col, bounds["lo"], bounds["hi"])
        merge.append_batch(target, env, f"{bounds['first']}..{bounds['last']}", ["id"], ["extract_window_end_utc", "payload"],
                           stamp=F.lit(bounds["hi"]).cast("timestamp_ntz"))
        if len(versions.latest(spark, target).folders) > compact_after:
            merge.compact(spark, target, ["id"])

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def week_bounds(df: DataFrame, ts_col: str) -> list[str]:
    """Week starts from before the first to after the last time of the data."""
    lo, hi = df.agg(F.to_date(F.min(ts_col)), F.to_date(F.max(ts_col))).first()
    out = [lo] if lo else []
    while out and out[-1] <= hi:
        out.append(out[-1] + dt.timedelta(days=7))
    return [f"{d:%Y-%m-%d}" for d in out]


def land_in_chunks(df: DataFrame, ts_col: str, folder: str, bounds: list[str]) -> None:
    """Write a table as one file set per time window (the arriving chunks)."""
    for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        part = df.filter((F.col(ts_col) >= F.lit(lo).cast("timestamp_ntz")) &
                         (F.col(ts_col) < F.lit(hi).cast("timestamp_ntz")))
        part.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/chunk={i:04d}")
