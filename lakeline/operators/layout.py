"""Physical layout: range, list and hash partitioning, pruned reads, retention.

A partition value is an ordinary derived column written with
``partitionBy``; a filter on it becomes a ``PartitionFilters`` entry in the
scan, so only matching folders are listed and read.  Declared partitions
are routed with one CASE expression (no join); a row that fits no declared
partition is *unrouted*, which a database with declarative partitions and
no default would reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.functions.exprs import md5_bucket

UNROUTED = "__unrouted__"


def range_route(col: str, bounds: list[tuple[str, object, object]]) -> Column:
    """Partition name for half-open ``lo <= col < hi`` bounds, NULL if none fits."""
    expr = None
    for name, lo, hi in bounds:
        cond = (F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def month_bounds(first: str, last: str) -> list[tuple[str, str, str]]:
    """Monthly half-open bounds from ``first`` to ``last`` month (yyyy-MM), inclusive."""
    y, m = map(int, first.split("-"))
    ly, lm = map(int, last.split("-"))
    out = []
    while (y, m) <= (ly, lm):
        ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
        out.append((f"{y:04d}-{m:02d}", f"{y:04d}-{m:02d}-01 00:00:00", f"{ny:04d}-{nm:02d}-01 00:00:00"))
        y, m = ny, nm
    return out


def list_route(col: str, values: list[str]) -> Column:
    return F.when(F.col(col).isin(values), F.col(col))


def hash_route(col: str, modulus: int) -> Column:
    """Bucket from md5 of the key's text: stable across engines and runs."""
    return md5_bucket(col, modulus).cast("int")


def with_partition(df: DataFrame, part_col: str, route: Column) -> DataFrame:
    return df.withColumn(part_col, route)


def month_span(df: DataFrame, col: str) -> list[tuple[str, str, str]]:
    """Monthly bounds from the first to the last month of the data (two scalars)."""
    lo, hi = df.agg(F.date_format(F.min(col), "yyyy-MM"), F.date_format(F.max(col), "yyyy-MM")).first()
    return month_bounds(lo, hi) if lo else []


def list_values(df: DataFrame, col: str) -> list[str]:
    """Distinct values of a list-partitioned column: one for each partition folder."""
    return [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()]


def write_layout(df: DataFrame, part_col: str, path: str, strict: bool = True,
                 spread: list[str] | None = None, tasks: int | None = None, row_group_bytes: int | None = None) -> str:
    """Write routed rows partitioned by ``part_col``.

    ``strict``: fail if any row is unrouted, as declarative partitions
    without a default do.  Otherwise such rows go to the default partition
    ``UNROUTED``; none is dropped.

    ``spread``: range-partition on (part_col, *spread) before writing, so each
    task holds a contiguous run of partition values (few files per folder
    instead of one per task per folder) while a large partition value is
    still split across several tasks by the spread columns.  Rows lie in the
    order of the spread columns, so the least and greatest values of a row
    group tell a reader which groups a filter on them can skip;
    ``row_group_bytes`` sets their size.

    The strict check runs inside the write: the first unrouted row fails it,
    and no second pass over the input looks for one."""
    if strict:
        routed = F.when(F.col(part_col).isNull(), F.raise_error(F.lit(f"rows outside every declared partition of {part_col}"))).otherwise(F.col(part_col))
    else:
        routed = F.coalesce(F.col(part_col).cast("string"), F.lit(UNROUTED))
    out = df.withColumn(part_col, routed)
    if spread:
        n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartitionByRange(n, part_col, *spread).sortWithinPartitions(part_col, *spread)
    w = out.write.mode("overwrite").partitionBy(part_col)
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    try:
        w.parquet(path)
    except Exception as e:
        if strict and "outside every declared partition" in str(e):
            raise ValueError(f"rows outside every declared partition of {part_col}") from e
        raise
    return path


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A catalog table with its rows in ``buckets`` by hash of ``keys``, sorted
    by them, in ``path``: joins and aggregates on the keys need no shuffle, and
    a filter on them reads one bucket.

    Rows are dealt out by the same hash first, so each bucket is one file.  Join
    tables of equal (or multiple) bucket counts and equal key types; a key that
    holds much of the table makes its bucket as large."""
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def unrouted_count(df: DataFrame, part_col: str) -> Column:
    return F.count_if(F.col(part_col).isNull())


def partition_summary(spark: SparkSession, path: str, part_col: str, amount: str | None = None) -> DataFrame:
    """Rows (and amount) per stored partition."""
    df = spark.read.parquet(path)
    aggs = [F.count(F.lit(1)).alias("rows")]
    if amount:
        aggs.append(F.round(F.sum(amount), 2).cast("double").alias("amount"))
    return df.groupBy(part_col).agg(*aggs)


def drop_partitions_before(spark: SparkSession, path: str, part_col: str, keep_from: str) -> list[str]:
    """Retention: delete partition folders whose value sorts before ``keep_from``.

    A metadata operation on the file system (no data is read or rewritten),
    done through Hadoop's FileSystem API, which is what a path-based table
    offers in place of ``ALTER TABLE ... DROP PARTITION``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(conf)
    dropped = []
    prefix = part_col + "="
    for st in fs.listStatus(base):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            value = name[len(prefix):]
            if value < keep_from:
                fs.delete(st.getPath(), True)
                dropped.append(value)
    return sorted(dropped)
