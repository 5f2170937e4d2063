"""Upserts and incremental merges on plain Parquet.

Plain Parquet has no MERGE.  Tables here are made of immutable folders and a
published list of them (``versions``), so a merge never overwrites what a
reader reads:

- ``append_batch`` / ``read_newest``: the raw table as one folder a batch.  A
  load writes its own rows and nothing else; the newest row of a key is found
  at read time.  ``compact`` folds batches into one sorted base.
- ``upsert_into`` and ``incremental_load``: rows are replaced by key inside the
  folders (key buckets, days, months) that a batch touches; untouched folders
  are taken over as they are.

Batches are deduplicated per key by an aggregate (partial on the map side, so
a key repeated a million times in one batch costs one row per map task).
Every load can be repeated: it gives the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.operators import versions
from lakeline.session import scratch_path

# Keep microseconds in the payload (the default JSON format stops at millis).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def envelope(df: DataFrame, id_col: str, start, end) -> DataFrame:
    """Raw record envelope: id as text, whole record as JSON, window bounds."""
    return df.select(
        F.col(id_col).cast("string").alias("id"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias("payload"),
        F.lit(start).cast("timestamp_ntz").alias("extract_window_start_utc"),
        F.lit(end).cast("timestamp_ntz").alias("extract_window_end_utc"),
    )


def latest_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` (ties broken by the rest of the row)."""
    rest = [c for c in batch.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("__best")
    return batch.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in order + rest]) \
        .select(*batch.columns)


def upsert(target: DataFrame | None, batch: DataFrame, keys: list[str], order: list[str],
           stamp: Column | None = None, stamp_col: str = "ingested_at_utc") -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE, as a DataFrame.

    New and updated rows are stamped alike; keys absent from the batch are
    kept.  An empty batch leaves the target as it is."""
    stamp = F.current_timestamp().cast("timestamp_ntz") if stamp is None else stamp
    if batch.isEmpty():
        return target
    fresh = latest_per_key(batch, keys, order).withColumn(stamp_col, stamp)
    if target is None:
        return fresh
    kept = target.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh)


def incremental_load(table_path: str | None, source: DataFrame, ts_col: str, part_col: str,
                     build, keys: list[str], day_col: str | None = None) -> str:
    """One run of an incremental model; returns the path of its table
    (``versions.read`` reads it).

    First run: full build.  Later runs build the rows from the start of the
    last loaded day on (the greatest ``day_col``, by default ``part_col``) and
    merge them on ``keys`` into the ``part_col`` folders they fall in.  Rows
    without a time belong to no day: each run builds their groups anew from
    all such rows, as a full build does."""
    spark = source.sparkSession
    if table_path is None:
        return versions.create(build(source), scratch_path(spark, "incremental"), part_col, keys)
    last = versions.read(spark, table_path).agg(F.max(day_col or part_col)).first()[0]
    if last is not None:
        source = source.filter((F.col(ts_col) >= F.lit(last).cast("timestamp_ntz")) | F.col(ts_col).isNull())
    return versions.merge(table_path, build(source), keys, part_col)


def upsert_into(table_path: str | None, batch: DataFrame, keys: list[str], order: list[str],
                stamp: Column | None = None, buckets: int = 64,
                stamp_col: str = "ingested_at_utc", bucket_col: str = "key_bucket") -> str | None:
    """Upsert a batch into a table stored by hash bucket of the key; returns
    its path (``versions.read`` reads it).

    The buckets of the batch's keys are read and written anew, so this form
    suits tables that are read far more often than loaded; a batch of fresh
    ids touches most buckets, which ``append_batch`` avoids.

    Size ``buckets`` so one bucket is about a gigabyte (64 suits the test
    tables; a 100 TB raw table wants ~100k).  The count is part of the
    table's layout: keep it fixed for the table's life."""
    stamp = F.current_timestamp().cast("timestamp_ntz") if stamp is None else stamp
    if batch.isEmpty():
        return table_path
    fresh = (latest_per_key(batch, keys, order).withColumn(stamp_col, stamp)
             .withColumn(bucket_col, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")))
    if table_path is None:
        return versions.create(fresh, scratch_path(batch.sparkSession, "raw-table"), bucket_col, keys)
    return versions.merge(table_path, fresh, keys, bucket_col)


# --- append and resolve ----------------------------------------------------

_SEQ = "batch_seq"  # a batch's folder is batch_seq=<number>; the base is number 0
_BASE = f"{_SEQ}=0"


def append_batch(path: str, batch: DataFrame, name: str, keys: list[str], order: list[str],
                 stamp: Column | None = None, stamp_col: str = "ingested_at_utc") -> str:
    """Add a batch to the raw table in ``path``, made if it isn't there.

    The batch, one row per key, goes into a folder of its own; no other file is
    written or read.  ``name`` says which batch it is: loading it again takes
    the place of its first load, so retries converge, and a batch that was
    folded into the base since is left alone.  An empty batch changes nothing."""
    spark = batch.sparkSession
    if batch.isEmpty():
        return path
    now = versions.latest(spark, path)
    applied = dict(now.applied) if now else {}
    folder = f"{_SEQ}={applied.get(name, max(applied.values(), default=0) + 1)}"
    if name in applied and folder not in now.folders:
        return path
    stamp = F.current_timestamp().cast("timestamp_ntz") if stamp is None else stamp
    seq = applied.setdefault(name, int(folder.split("=")[1]))
    fresh = latest_per_key(batch, keys, order).withColumn(stamp_col, stamp).withColumn(_SEQ, F.lit(seq))
    number = now.number + 1 if now else 1
    folders = versions.write_folders(fresh, path, number, _SEQ, keys)
    versions.publish(spark, path, versions.Version(number, now.schema if now else fresh.schema, (now.folders if now else {}) | folders, applied))
    return path


def read_newest(spark, path: str, keys: list[str]) -> DataFrame:
    """The raw table: of each key, the row of the batch loaded last.

    Only the batches since the last compaction are grouped by key; the base,
    whose keys are unique, is joined with their keys alone and is not shuffled
    where these are few enough to broadcast."""
    now = versions.latest(spark, path)
    if now is None:
        raise FileNotFoundError(f"no table in {path}")
    later = [n for n in now.folders if n != _BASE]
    base = versions.read_folders(spark, path, now, [_BASE]).drop(_SEQ)
    if not later:
        return base
    added = versions.read_folders(spark, path, now, later)
    newest = added.drop(_SEQ) if len(later) == 1 else latest_per_key(added, keys, [_SEQ]).drop(_SEQ)
    if len(later) == len(now.folders):
        return newest
    changed = added.select(*keys).distinct()
    return base.join(changed, versions.same_keys(base, changed, keys), "left_anti").unionByName(newest)


def compact(spark, path: str, keys: list[str]) -> str:
    """Fold all batches into a new base, sorted by key; readers of the old
    version keep it until ``versions.vacuum``."""
    now = versions.latest(spark, path)
    whole = read_newest(spark, path, keys).withColumn(_SEQ, F.lit(0))
    folders = versions.write_folders(whole.select(*now.schema.names), path, now.number + 1, _SEQ, keys)
    versions.publish(spark, path, versions.Version(now.number + 1, now.schema, folders, now.applied))
    return path
