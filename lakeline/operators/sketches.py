"""Column statistics from mergeable sketches, kept beside the data.

Each partition of a table (a month) gets one row a column: count, least,
greatest and a KLL quantile sketch, which Spark's own aggregates build and
merge.  Whole-table quantiles merge these rows and read no data; a new month
costs a scan of that month.  A quantile's rank is off by at most about
``rank_error(k)`` of the rows (with 99 % confidence), whatever their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.functions.exprs import present
from lakeline.operators import versions

K = 800


def rank_error(k: int = K) -> float:
    """The published bound of the KLL sketch, as a share of the rows."""
    return 2.446 / k ** 0.9433


def sketched(df: DataFrame, part_col: str, columns: list[str], k: int = K) -> DataFrame:
    """(part_col, column, count, min, max, sketch): a row for each partition
    value and column that has values there; NaN counts as missing."""
    wide = df.select(part_col, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), present(c).alias("x")) for c in columns])).alias("s"))
    return wide.select(part_col, "s.*").filter("x IS NOT NULL").groupBy(part_col, "column").agg(
        F.count(F.lit(1)).alias("count"), F.min("x").alias("min"), F.max("x").alias("max"), F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch"))


def refresh(df: DataFrame, path: str, part_col: str, columns: list[str], k: int = K) -> str:
    """Put the sketches of the partitions that ``df`` holds (whole) in place of
    their earlier ones, in the versioned table ``path``."""
    return versions.merge(path, sketched(df, part_col, columns, k), [part_col, "column"], part_col)


def describe(sketches: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, count, min, max, q<percent>...) from the merged sketches."""
    g = sketches.groupBy("column").agg(F.sum("count").alias("count"), F.min("min").alias("min"), F.max("max").alias("max"),
                                       F.kll_merge_agg_double("sketch").alias("sketch"))
    return g.select("column", "count", "min", "max", *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q{round(100 * p)}") for p in probs])


def rank_errors(df: DataFrame, found: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, p, error): how far a found quantile's rank is from p, as a share
    of the rows, by one scan of ``df``."""
    wanted = [(r["column"], p, r[f"q{round(100 * p)}"]) for r in found.collect() for p in probs]  # columns * probs
    aggs = []
    for i, (c, _, v) in enumerate(wanted):
        x = present(c)
        aggs += [F.count_if(x < F.lit(v)).alias(f"lo{i}"), F.count_if(x <= F.lit(v)).alias(f"hi{i}"), F.count(x).alias(f"n{i}")]
    row = df.agg(*aggs).first()
    out = [(c, p, max(0.0, row[f"lo{i}"] / row[f"n{i}"] - p, p - row[f"hi{i}"] / row[f"n{i}"])) for i, (c, p, _) in enumerate(wanted)]
    return df.sparkSession.createDataFrame(out, "column string, p double, error double")
