"""Tables of immutable folders, swapped by publishing a list.

Rows lie in folders that are written once.  ``_versions/<number>`` lists the
folders that make up one version of the table; the highest number is the
table.  A version is published by renaming its finished list to the next
number, after all its rows are written:

- a reader sees a version whole or not at all, and goes on reading it while
  the next one is made;
- untouched folders are listed again, not copied;
- of two writers that start from the same version, the second rename fails
  and its writer starts again from the new version (``Conflict``);
- what a failed writer left is listed nowhere, and ``vacuum`` removes it.

The list holds one entry for each folder (a partition value or a batch), which
is what the driver sees.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LISTS = "_versions"
_WRITE = "__write"  # each write has a folder __write=<number>-<random>: a partition column that readers drop


class Conflict(RuntimeError):
    """Another writer published this number first."""


@dataclass(frozen=True)
class Version:
    """``folders``: name -> path under the table.  ``applied``: what a writer
    wants to find again (batch name -> number)."""

    number: int
    schema: T.StructType
    folders: dict[str, str]
    applied: dict[str, int] = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(place)) if fs.exists(place) else []


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    return sorted(int(n) for n in _names(spark, f"{path}/{_LISTS}") if n.isdigit())


def version(spark: SparkSession, path: str, number: int) -> Version:
    fs, place = _fs(spark, f"{path}/{_LISTS}/{number:012d}")
    stream = fs.open(place)
    try:
        held = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, T.StructType.fromJson(held["schema"]), held["folders"], held["applied"])


def latest(spark: SparkSession, path: str) -> Version | None:
    known = numbers(spark, path)
    return version(spark, path, known[-1]) if known else None


def publish(spark: SparkSession, path: str, new: Version) -> Version:
    """Make ``new`` the table, if its number is still free."""
    jvm = spark.sparkContext._jvm
    body = json.dumps({"schema": new.schema.jsonValue(), "folders": new.folders, "applied": new.applied})
    fs, draft = _fs(spark, f"{path}/{_LISTS}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(body.encode()))
    out.close()
    place = jvm.org.apache.hadoop.fs.Path(f"{path}/{_LISTS}/{new.number:012d}")
    # FileContext's rename fails where the target exists (FileSystem's may not).
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(place).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(place), none)
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(place):
            raise Conflict(f"version {new.number} of {path} was published by another writer") from e
        raise
    return new


def read_folders(spark: SparkSession, path: str, held: Version, names: list[str] | None = None) -> DataFrame:
    """Rows of some of a version's folders (all by default); only these are listed."""
    paths = [f"{path}/{p}" for n, p in held.folders.items() if names is None or n in names]
    if not paths:
        return spark.createDataFrame([], held.schema)
    schema = T.StructType([*held.schema.fields, T.StructField(_WRITE, T.StringType())])
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*held.schema.names)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table's newest version, or an older one that is still kept."""
    held = latest(spark, path) if number is None else version(spark, path, number)
    if held is None:
        raise FileNotFoundError(f"no version of a table in {path}")
    return read_folders(spark, path, held)


def write_folders(df: DataFrame, path: str, number: int, part_col: str, keys: list[str]) -> dict[str, str]:
    """Write ``df`` under the table, a folder for each value of ``part_col``;
    returns the folders (name -> path), which no version lists yet.

    Range-partitioned by (part_col, keys): contiguous runs of folders in each
    task, and a large folder is still split over several."""
    spark = df.sparkSession
    own = f"{_WRITE}={number}-{uuid.uuid4().hex[:8]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, part_col, *keys).write.partitionBy(part_col).parquet(f"{path}/{own}")
    return {name: f"{own}/{name}" for name in _names(spark, f"{path}/{own}") if "=" in name}


def create(df: DataFrame, path: str, part_col: str, keys: list[str]) -> str:
    """A new table, or the next version of one, with the rows of ``df`` alone."""
    now = latest(df.sparkSession, path)
    number = now.number + 1 if now else 1
    publish(df.sparkSession, path, Version(number, df.schema, write_folders(df, path, number, part_col, keys)))
    return path


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> list:
    """Join condition on ``keys`` in which nulls are equal."""
    return [a[k].eqNullSafe(b[k]) for k in keys]


def merge(path: str, fresh: DataFrame, keys: list[str], part_col: str) -> str:
    """The next version: rows of ``fresh`` replace those of equal ``keys`` (nulls
    are equal).  Only folders that ``fresh`` has rows for are read and written
    anew.  A row whose ``part_col`` changed is not looked for elsewhere: let
    ``part_col`` follow from the keys.  Merging the same rows again gives the
    same table."""
    from lakeline.session import scratch_path

    spark = fresh.sparkSession
    now = latest(spark, path)
    if now is None:
        return create(fresh, path, part_col, keys)
    fresh = fresh.select(*now.schema.names)
    stage = scratch_path(spark, "merge")
    touched = list(write_folders(fresh, stage, 0, part_col, keys).items())
    if not touched:
        return path
    staged = Version(0, now.schema, dict(touched))
    new = read_folders(spark, stage, staged)
    old = read_folders(spark, path, now, [n for n, _ in touched])
    kept = old.join(new.select(*[F.col(k) for k in keys]), same_keys(old, new, keys), "left_anti")
    folders = write_folders(kept.unionByName(new), path, now.number + 1, part_col, keys)
    publish(spark, path, Version(now.number + 1, now.schema, now.folders | folders, now.applied))
    return path


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Forget all but the newest ``keep`` versions and delete what none of them
    lists.  Not while another writer is at work: its rows aren't listed yet."""
    known = numbers(spark, path)
    fs, _ = _fs(spark, path)
    used = {p for n in known[-keep:] for p in version(spark, path, n).folders.values()}
    for n in known[:-keep]:
        fs.delete(_fs(spark, f"{path}/{_LISTS}/{n:012d}")[1], False)
    gone = 0
    for write in (n for n in _names(spark, path) if n.startswith(f"{_WRITE}=")):
        inside = [f"{write}/{n}" for n in _names(spark, f"{path}/{write}") if "=" in n]
        for p in inside:
            if p not in used:
                gone += bool(fs.delete(_fs(spark, f"{path}/{p}")[1], True))
        if not used.intersection(inside):
            fs.delete(_fs(spark, f"{path}/{write}")[1], True)
    return gone
