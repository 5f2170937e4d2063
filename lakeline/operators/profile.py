"""Column profiles: nulls, schema, numeric summary, frequencies, duplicates,
histograms, box-plot statistics, correlations, samples and 2-D grids.

Each profile is one or two aggregate passes whose *result* is small
(columns x statistics, bins, or categories); nothing row-sized reaches the
driver.  Quantiles are exact and distributed (see ``keys.exact_quantiles``);
pass ``accuracy`` to trade exactness for ``percentile_approx``'s one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline.functions.exprs import md5_unit, present
from lakeline.operators.keys import exact_quantiles
from lakeline.operators.merge import JSON_OPTIONS
from lakeline.functions import fixed

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _missing(c: str, dtype) -> Column:
    cond = F.col(c).isNull()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        cond = cond | F.isnan(c)
    return cond


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: null count, fraction and percentage (NaN counts as missing)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = columns or df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(_missing(c, types[c])).alias(c) for c in cols])
    long = row.unpivot(["__n"], cols, "column", "null_count")
    frac = F.col("null_count") / F.col("__n")
    return long.select("column", F.col("null_count").cast("bigint").alias("null_count"),
                       frac.alias("null_fraction"), (frac * 100).alias("null_pct"))


def schema_profile(df: DataFrame) -> DataFrame:
    """Column, Spark type and non-null count (one pass)."""
    spark = df.sparkSession
    row = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = row.unpivot([], df.columns, "column", "non_null")
    types = spark.createDataFrame([(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)],
                                  "column string, type string, position int")
    # both sides are column-count sized
    return F.broadcast(types).join(long, "column").select(
        "position", "column", "type", F.col("non_null").cast("bigint").alias("non_null"))


def exact_rounded_mean(c: str, decimals: int, digits: int) -> Column:
    """Mean rounded half-up to ``digits``, computed in integers.

    For data holding at most ``decimals`` decimals: the sum is exact, so the
    result does not depend on summation order, and a mean that falls exactly
    on a rounding tie is rounded the same way by any engine."""
    u = f"CAST(round(CAST(`{c}` AS DOUBLE) * {10 ** decimals}) AS BIGINT)"
    k, m = 10 ** max(digits - decimals, 0), 10 ** max(decimals - digits, 0)
    sgn = f"(CASE WHEN sum({u}) < 0 THEN -1 ELSE 1 END)"
    r = f"{sgn} * ((abs(sum({u})) * {2 * k} + count({u}) * {m}) div (count({u}) * {2 * m}))"
    return F.expr(f"CAST(CAST({r} AS DECIMAL(20,0)) / {10 ** digits} AS DOUBLE)")


def describe_numeric(df: DataFrame, columns: list[str] | None = None, digits: int = 6,
                     accuracy: int | None = None, decimals: int | None = None) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % and max per numeric column.

    ``decimals``: the inputs carry at most this many decimals (money, rates);
    the mean is then summed exactly and rounded without float ties."""
    cols = columns or numeric_columns(df)
    stats = []
    for c in cols:
        x = present(c)
        mean = exact_rounded_mean(c, decimals, digits) if decimals is not None else F.avg(x)
        stats += [F.count(x).alias(f"{c}|count"), mean.alias(f"{c}|mean"),
                  F.stddev_samp(x).alias(f"{c}|std"), F.min(x).alias(f"{c}|min"), F.max(x).alias(f"{c}|max")]
    base = df.agg(*stats)
    long = base.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}|count`").alias("count"), F.col(f"`{c}|mean`").alias("mean"),
                 F.col(f"`{c}|std`").alias("std"), F.col(f"`{c}|min`").alias("min"), F.col(f"`{c}|max`").alias("max"))
        for c in cols])).alias("s")).select("s.*")
    q = quantiles_long(df, cols, [0.25, 0.5, 0.75], accuracy)
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
                                   for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    out = long.join(qw, "column", "left")
    r = lambda c: F.round(F.col(c), digits).alias(c)
    return out.select("column", F.col("count").cast("bigint").alias("count"), r("mean"), r("std"), r("min"),
                      r("q25"), r("q50"), r("q75"), r("max"))


def quantiles_long(df: DataFrame, cols: list[str], probs: list[float], accuracy: int | None = None) -> DataFrame:
    """(column, p, value): exact by default, ``percentile_approx`` if accuracy given."""
    if accuracy is None:
        return exact_quantiles(df, cols, probs)
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c) for c in cols])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("p"), F.col(c)[i].alias("value"))
        for c in cols for i, p in enumerate(probs)])).alias("s")).select("s.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequencies of non-null values, most frequent first (ties by value)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), column))


def duplicate_count(df: DataFrame, columns: list[str] | None = None, digest: bool = True) -> DataFrame:
    """rows, distinct rows, duplicate rows (NULLs compare equal, as in pandas).

    With ``digest`` the rows are grouped by a SHA-256 of their values, so a
    shuffle carries 32 bytes per row instead of whole texts; partial
    aggregation collapses a hot duplicate before the shuffle either way."""
    cols = columns or df.columns
    if digest:
        enc = F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols]), JSON_OPTIONS), 256)
        keyed = df.select(enc.alias("__k"))
        groups = keyed.groupBy("__k").agg(F.count(F.lit(1)).alias("n"))
    else:
        groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.sum("n").cast("bigint").alias("rows"), F.count(F.lit(1)).alias("distinct_rows")).withColumn(
        "duplicate_rows", F.col("rows") - F.col("distinct_rows"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max; the last bin is closed on the right."""
    x = present(column)
    lo_hi = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()  # two scalars
    lo, hi = lo_hi["lo"], lo_hi["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, count bigint")
    w = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.lit(bins - 1), F.floor((x - F.lit(lo)) / F.lit(w)).cast("int"))
    g = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return g.select("bin", (F.lit(lo) + F.col("bin") * F.lit(w)).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("upper"), "count")


def boxplot_stats(df: DataFrame, columns: list[str], whisker: float = fixed.IQR_WHISKER, digits: int = 6) -> DataFrame:
    """Quartiles, IQR, whiskers (furthest points within 1.5 IQR) and outliers."""
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    qs = {(r["column"], r["p"]): r["value"] for r in q.collect()}  # |columns| x 3 values
    aggs = []
    rows = []
    for c in columns:
        q1, q2, q3 = qs.get((c, 0.25)), qs.get((c, 0.5)), qs.get((c, 0.75))
        if q1 is None:
            continue
        iqr = q3 - q1
        lo, hi = q1 - whisker * iqr, q3 + whisker * iqr
        x = present(c)
        inside = (x >= F.lit(lo)) & (x <= F.lit(hi))
        aggs += [F.min(F.when(inside, x)).alias(f"{c}|wlo"), F.max(F.when(inside, x)).alias(f"{c}|whi"),
                 F.count_if(x.isNotNull() & ~inside).alias(f"{c}|out")]
        rows.append((c, q1, q2, q3, iqr))
    agg = df.agg(*aggs)
    long = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(q1).alias("q1"), F.lit(q2).alias("median"), F.lit(q3).alias("q3"),
                 F.lit(iqr).alias("iqr"), F.col(f"`{c}|wlo`").alias("whisker_low"),
                 F.col(f"`{c}|whi`").alias("whisker_high"), F.col(f"`{c}|out`").alias("outliers"))
        for c, q1, q2, q3, iqr in rows])).alias("s")).select("s.*")
    r = lambda c: F.round(F.col(c), digits).alias(c)
    return long.select("column", r("q1"), r("median"), r("q3"), r("iqr"), r("whisker_low"), r("whisker_high"),
                       F.col("outliers").cast("bigint").alias("outliers"))


def _corr(a: str, b: str) -> Column:
    """Pearson correlation over rows with both values; NULL if either is
    constant there (the built-in one fails on a zero deviation)."""
    x, y = present(a), present(b)
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y)))


def corr_matrix(df: DataFrame, columns: list[str], digits: int = 8) -> DataFrame:
    """Pearson correlation of every pair (pairwise-complete rows), long form.

    d*(d-1)/2 ``corr`` aggregates in one pass; beyond ~50 columns
    ``pyspark.ml.stat.Correlation`` on a vector column scales better."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    row = df.agg(*[_corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"`{a}|{b}`").alias("corr"))
        for a, b in pairs])).alias("s")).select("s.*")
    mirrored = long.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    # A constant column has no correlation, not even with itself.
    own = df.agg(*[F.when(F.stddev_pop(present(c)) > 0, 1.0).alias(c) for c in columns])
    diag = own.unpivot([], columns, "col_a", "corr").select("col_a", F.col("col_a").alias("col_b"), "corr")
    return long.unionByName(mirrored).unionByName(diag).select(
        "col_a", "col_b", F.round("corr", digits).alias("corr"))


def corr_rank(df: DataFrame, target: str, columns: list[str] | None = None, digits: int = 8) -> DataFrame:
    """Correlation of each numeric column with the target, its own row
    included, strongest first; columns without one come last."""
    columns = numeric_columns(df) if columns is None else columns
    row = df.agg(*[_corr(c, target).alias(c) for c in columns])
    long = row.unpivot([], columns, "column", "corr")
    return long.select("column", F.round("corr", digits).alias("corr")).orderBy(F.desc_nulls_last("corr"), "column")


def scatter_sample(df: DataFrame, key: str, columns: list[str], fraction: float, limit: int) -> DataFrame:
    """Deterministic bounded sample: rows whose md5(key) falls under ``fraction``,
    the ``limit`` smallest hashes.  Same rows on any partitioning or rerun."""
    h = md5_unit(key)
    return (df.select(key, *columns, h.alias("__h")).filter(F.col("__h") < fraction)
            .orderBy("__h", key).limit(limit).drop("__h"))


def grid_density(df: DataFrame, x: str, y: str, value: str, box: tuple, cell: tuple, digits: int = 6) -> DataFrame:
    """Count and mean value per (x, y) cell inside a bounding box."""
    (x0, x1, y0, y1), (dx, dy) = box, cell
    inside = df.filter(F.col(x).between(x0, x1) & F.col(y).between(y0, y1))
    gx = F.floor((F.col(x) - F.lit(x0)) / F.lit(dx)).cast("int")
    gy = F.floor((F.col(y) - F.lit(y0)) / F.lit(dy)).cast("int")
    return inside.groupBy(gx.alias("cell_x"), gy.alias("cell_y")).agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg(value), digits).alias("mean_value"))
