"""Session settings and the shared scratch folder.

Everything that compares with DuckDB needs UTC; everything that runs at
scale needs AQE (partition coalescing, skew-join splitting, runtime
broadcast conversion).  Scratch data goes under the cluster's shared
checkpoint folder (``spark.checkpoint.dir``); a local folder is created
only when the session has none, which is the case in tests.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours should carry.  Shuffle width is left to
# the caller: 8 suits local[8]; a 1000-executor cluster wants thousands,
# and AQE coalesces the excess at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "lakeline", extra: dict | None = None,
                  max_partition_bytes: int | None = None) -> SparkSession:
    """Session with our settings.

    Sizing at scale: ``shuffle_partitions`` ~ 2-3x the total executor cores
    (AQE coalesces small ones); ``max_partition_bytes`` sets the input split
    (128 MB default), so each scan task fits in executor memory."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if max_partition_bytes:
        conf["spark.sql.files.maxPartitionBytes"] = str(max_partition_bytes)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Settings that can change on a live session (the driver hands us one)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    shared_dir(spark)
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lakeline`` importable in the Python workers, once per application.

    Pandas functions (forest build and scoring) are pickled by reference, so
    executors import this package; it is zipped on the driver and handed to
    ``addPyFile``, which serves it to every executor (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import lakeline

    pkg_dir = os.path.dirname(os.path.abspath(lakeline.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="lakeline-pkg-"), "lakeline")
    archive = shutil.make_archive(out, "zip", root_dir=os.path.dirname(pkg_dir), base_dir="lakeline")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; set a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    else:
        # Tests and single-machine runs only: the session names no folder.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lakeline-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder, in a folder of this
    application that is deleted when the driver's JVM ends."""
    sc = spark.sparkContext
    own = shared_dir(spark).rstrip("/") + "/lakeline/" + sc.applicationId
    if own not in _OWN:
        place = sc._jvm.org.apache.hadoop.fs.Path(own)
        fs = place.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(place)
        fs.deleteOnExit(place)
        _OWN.add(own)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


_OWN: set[str] = set()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the scratch folder: its lineage ends there,
    and later plans know its size in bytes, so joins with it can be broadcast
    or, where its keys are hot, split."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run inside leave no shuffle files behind: they
    go when the query ends, not when the driver collects its garbage.  For
    loops of queries that each shuffle much and are run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


_KEPT: dict[tuple, tuple] = {}
_BUILDING: dict[tuple, threading.Lock] = {}
_GUARD = threading.Lock()


def state_of(spark: SparkSession, path: str) -> tuple:
    """Bytes, files and time of change of a table's folder (or file)."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = fs.getContentSummary(place)
    return path, held.getLength(), held.getFileCount(), fs.getFileStatus(place).getModificationTime()


def stored_once(spark: SparkSession, name: str, sources: list[str], build: Callable[[], DataFrame]) -> DataFrame:
    """``stored``, once for an application and state of the tables it is made
    from: a later call reads the table that the first one wrote, as long as no
    source changed its size, number of files or time of change.  Not for a
    registered query, each call of which does its whole job."""
    key = (spark.sparkContext.applicationId, name, *(state_of(spark, s) for s in sources))
    with _GUARD:
        lock = _BUILDING.setdefault(key, threading.Lock())
    with lock:
        if key not in _KEPT:
            df = build()
            path = scratch_path(spark, name)
            df.write.parquet(path)
            _KEPT[key] = path, df.schema
    path, schema = _KEPT[key]
    return spark.read.schema(schema).parquet(path)
