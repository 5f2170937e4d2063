"""Distributed sequence numbers and exact order statistics.

``Window.partitionBy(g).orderBy(o)`` puts a whole group in one task, and a
global ``row_number()`` puts *everything* in one task.  Here the rows are
range-partitioned on (group, order) instead, so a hot group is spread over
many tasks; each task numbers its slice, and a per-slice offset (one row
per slice, at most the number of range partitions per group) stitches the
slices together.  The order columns must give a total order within a group
for the numbers to be deterministic.

Cost: one range shuffle, a checkpoint write of the input and one of the
numbered output; callers project the columns they need first.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PID = "__slice"


def _parts(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ordinal(df: DataFrame, order_cols: list, group_cols: list | None = None,
            name: str = "rn", partitions: int | None = None, written: bool = True) -> DataFrame:
    """Add ``name`` = 1-based position of each row in its group by ``order_cols``.

    Equivalent to ``row_number() over (partition by group order by order)``
    but no task ever holds more than one range partition of rows.

    ``written=False``: only the sliced rows are written, and each use of the
    result numbers them again (or not at all, where the number isn't read);
    for callers that write what they make of it themselves."""
    group_cols = list(group_cols or [])
    gnames = [c if isinstance(c, str) else None for c in group_cols]
    if None in gnames:
        raise TypeError("group columns must be names")
    keys = [*group_cols, *order_cols]
    n = _parts(df, partitions)
    if not gnames:
        return _global_ordinal(df, order_cols, name, n)
    # Range bounds are sampled per exchange (the seed follows the shuffle
    # id), so the sliced rows are written once to the shared checkpoint
    # folder: both branches below then see the same slices, and a lost
    # executor re-reads them instead of re-slicing.
    sliced = df.repartitionByRange(n, *keys).withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)
    # Local number inside (slice, group): bounded by the slice size.
    local_w = Window.partitionBy(_PID, *gnames).orderBy(*order_cols)
    local = sliced.withColumn("__local", F.row_number().over(local_w))
    # One row per (slice, group); offset = rows of the group in earlier slices.
    blocks = sliced.groupBy(_PID, *gnames).agg(F.count(F.lit(1)).alias("__n"))
    off_w = Window.partitionBy(*gnames).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__off", F.coalesce(F.sum("__n").over(off_w), F.lit(0))).drop("__n")
    blocks = blocks.withColumnsRenamed({c: f"__of_{c}" for c in (_PID, *gnames)})
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in (_PID, *gnames)]  # null is a group, too
    # left: a caller that doesn't read the number pays for neither join nor window
    out = local.join(blocks, same, "inner" if written else "left")
    numbered = out.select(*df.columns, (F.col("__local") + F.col("__off")).cast("bigint").alias(name))
    # written once: callers use the numbered rows in several branches, and
    # the planner would otherwise redo the window in each of them
    return numbered.checkpoint(eager=True) if written else numbered


def _global_ordinal(df: DataFrame, order_cols: list, name: str, n: int) -> DataFrame:
    """Global position: range slices sorted in place, position inside a slice
    from ``monotonically_increasing_id`` (slice index in the upper bits), plus
    the row count of earlier slices (one row per slice, broadcast)."""
    sliced = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("__mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    pid = F.shiftright("__mid", 33)
    counts = sliced.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)  # <= n rows
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    out = sliced.withColumn(_PID, pid).join(F.broadcast(offsets), _PID)
    pos = F.col("__mid") - F.shiftleft(F.col(_PID), 33)
    return out.select(*df.columns, (pos + 1 + F.col("__off")).cast("bigint").alias(name))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (as ``percentile`` /
    ``quantile_cont``) for several columns.

    Returns one row per (column, p): ``column, p, value``.  NULL and NaN are
    ignored.  Rows are first counted per (column, value), combined map-side,
    so a value that most rows share is one row.  The distinct values are cut
    into range slices; slice totals (at most slices x columns, on the driver)
    say which slices hold the wanted ranks, and only those are counted
    through."""
    spark = df.sparkSession
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("s")).select("s.column", "s.v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    values = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("m"))
    sliced = values.repartitionByRange(_parts(df, partitions), "column", "v") \
        .withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)
    totals = sorted(tuple(r) for r in sliced.groupBy("column", _PID).agg(F.sum("m")).collect())
    n: dict = {}
    for c, _, m in totals:
        n[c] = n.get(c, 0) + m
    wanted = []  # (column, p, share of the upper value, is upper, slice, rank inside it)
    for c, size in n.items():
        for p in probs:
            h = (size - 1) * float(p)
            for upper, rank in ((False, math.floor(h) + 1), (True, math.ceil(h) + 1)):
                before = 0
                for pid, m in ((pid, m) for cc, pid, m in totals if cc == c):
                    if before < rank <= before + m:
                        wanted.append((c, float(p), h - math.floor(h), upper, pid, rank - before))
                    before += m
    need = spark.createDataFrame(wanted, f"column string, p double, part double, upper boolean, {_PID} int, rank bigint")
    run = Window.partitionBy(_PID, "column").orderBy("v")
    used = sorted({w[4] for w in wanted})
    passed = sliced.filter(F.col(_PID).isin(used)).withColumn("upto", F.sum("m").over(run))
    picks = passed.join(F.broadcast(need), [_PID, "column"]).filter(  # |cols| x |probs| x 2 rows
        (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("m")))
    g = picks.groupBy("column", "p", "part").agg(
        F.max(F.when(~F.col("upper"), F.col("v"))).alias("vlo"), F.max(F.when(F.col("upper"), F.col("v"))).alias("vhi"))
    return g.select("column", "p", (F.col("vlo") + F.col("part") * (F.col("vhi") - F.col("vlo"))).alias("value"))


def quantile_map(df: DataFrame, cols: list[str], probs: list[float]) -> dict:
    """Driver-side {(column, p): value}; size is |cols| x |probs|."""
    return {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, cols, probs).collect()}

