"""Profiling queries (F1-F11) over a housing-shaped view of lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeline.functions import fixed
from lakeline.operators import profile as pf
from lakeline.operators import sketches, versions, wide
from lakeline.plans.registry import query
from lakeline.session import scratch_path

# housing-shaped view: numeric features, one column with missing values
# (tax = 0 read as missing), two text categories, and a unique row key.
HOUSING_TYPES = {"row_key": "string", "quantity": "double", "price": "double", "discount": "double",
                 "tax": "double", "flag": "string", "status": "string"}
NUMERIC = ["quantity", "price", "discount", "tax"]


def housing(t, *more):
    """The view, with further columns of lineitem if named."""
    li = t.lineitem
    key = F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    return li.select(
        key.alias("row_key"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("tax"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        *more,
    )


HOUSING_SQL = """
WITH housing AS (
  SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS row_key,
         l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount,
         CASE WHEN l_tax <> 0 THEN l_tax END AS tax, l_returnflag AS flag, l_linestatus AS status
  FROM lineitem)
"""


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _missing_sql(c):
    return f"({c} IS NULL OR isnan({c}))" if HOUSING_TYPES[c] == "double" else f"{c} IS NULL"


@query("null_profile", HOUSING_SQL + _union([
    f"""SELECT '{c}' AS "column", CAST(count_if({_missing_sql(c)}) AS BIGINT) AS null_count,
       count_if({_missing_sql(c)}) / count(*) AS null_fraction, count_if({_missing_sql(c)}) / count(*) * 100 AS null_pct
FROM housing""" for c in HOUSING_TYPES]))
def q_null_profile(t):
    return pf.null_profile(housing(t))


@query("schema_profile", HOUSING_SQL + _union([
    f"""SELECT {i} AS position, '{c}' AS "column", '{ty}' AS type, CAST(count({c}) AS BIGINT) AS non_null FROM housing"""
    for i, (c, ty) in enumerate(HOUSING_TYPES.items())]))
def q_schema_profile(t):
    return pf.schema_profile(housing(t))


def _exact_mean(c, decimals=2, digits=6):
    u = f"CAST(round({c} * {10 ** decimals}) AS BIGINT)"
    k, m = 10 ** max(digits - decimals, 0), 10 ** max(decimals - digits, 0)
    r = (f"(CASE WHEN sum({u}) < 0 THEN -1 ELSE 1 END) * "
         f"((abs(sum({u})) * {2 * k} + count({u}) * {m}) // (count({u}) * {2 * m}))")
    return f"CAST({r} AS DOUBLE) / {10 ** digits}"


def _r(e):
    return f"round({e}, 6)"


@query("describe_numeric", HOUSING_SQL + _union([
    f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count, {_exact_mean(c)} AS mean,
       {_r(f'stddev_samp({c})')} AS std, {_r(f'min({c})')} AS min, {_r(f'quantile_cont({c}, 0.25)')} AS q25,
       {_r(f'quantile_cont({c}, 0.5)')} AS q50, {_r(f'quantile_cont({c}, 0.75)')} AS q75, {_r(f'max({c})')} AS max
FROM housing""" for c in NUMERIC]))
def q_describe_numeric(t):
    return pf.describe_numeric(housing(t), NUMERIC, decimals=2)


@query("value_counts", HOUSING_SQL + """
SELECT flag, count(*) AS count FROM housing WHERE flag IS NOT NULL GROUP BY flag""")
def q_value_counts(t):
    return pf.value_counts(housing(t), "flag")


@query("duplicate_count", """
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT text FROM documents)) AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT text FROM documents)) AS duplicate_rows
FROM documents""")
def q_duplicate_count(t):
    """Exact-copy documents: whole texts compared through a SHA-256 digest."""
    return pf.duplicate_count(t.documents.select("text"))


HIST_BINS = fixed.HISTOGRAM_BINS


@query("histogram", HOUSING_SQL + f"""
, s AS (SELECT min(price) AS lo, max(price) AS hi FROM housing),
b AS (SELECT least({HIST_BINS - 1}, CAST(floor((price - lo) / ((hi - lo) / {HIST_BINS})) AS INTEGER)) AS bin,
             lo, (hi - lo) / {HIST_BINS} AS w
      FROM housing, s WHERE price IS NOT NULL AND NOT isnan(price))
SELECT bin, lo + bin * w AS lower, lo + (bin + 1) * w AS upper, count(*) AS count FROM b GROUP BY bin, lo, w""")
def q_histogram(t):
    return pf.histogram(housing(t), "price", HIST_BINS)


BOX_COLS = ["quantity", "price", "tax"]


@query("boxplot_stats", HOUSING_SQL + _union([f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(q2, 6) AS median,
       round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round((SELECT min({c}) FROM housing WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
       round((SELECT max({c}) FROM housing WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
       (SELECT CAST(count(*) AS BIGINT) FROM housing WHERE {c} IS NOT NULL AND NOT ({c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1))) AS outliers
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM housing)"""
                                              for c in BOX_COLS]))
def q_boxplot_stats(t):
    return pf.boxplot_stats(housing(t), BOX_COLS)


_PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]]


@query("corr_matrix", HOUSING_SQL + _union(
    [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 8) AS corr FROM housing" for a, b in _PAIRS]
    + [f"SELECT '{b}' AS col_a, '{a}' AS col_b, round(corr({a}, {b}), 8) AS corr FROM housing" for a, b in _PAIRS]
    + [f"SELECT '{c}' AS col_a, '{c}' AS col_b, 1.0 AS corr" for c in NUMERIC]))
def q_corr_matrix(t):
    return pf.corr_matrix(housing(t), NUMERIC)


@query("corr_rank", HOUSING_SQL + _union(
    [f"""SELECT '{c}' AS "column", round(corr({c}, price), 8) AS corr FROM housing""" for c in NUMERIC]))
def q_corr_rank(t):
    return pf.corr_rank(housing(t), "price")


DIMENSIONS = 64  # of the embeddings: as many columns


@query("corr_wide", f"""
WITH e AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT 'x' || a.i AS col_a, 'x' || b.i AS col_b, CASE WHEN a.i = b.i THEN 1.0 ELSE round(corr(CAST(a.v AS DOUBLE), CAST(b.v AS DOUBLE)), 8) END AS corr
FROM e a JOIN e b USING (vec_id) WHERE a.i < {DIMENSIONS} AND b.i < {DIMENSIONS} GROUP BY a.i, b.i""")
def q_corr_wide(t):
    """Correlations of all pairs of embedding dimensions, from co-moment matrices."""
    cols = [F.get("embedding", i).alias(f"x{i}") for i in range(DIMENSIONS)]
    return wide.corr_wide(t.embeddings.select(*cols), [f"x{i}" for i in range(DIMENSIONS)])


SKETCHED = ["quantity", "price", "tax"]


def sketched_months(t):
    """Sketches of the housing columns by ship month, kept in two loads."""
    rows = housing(t, F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    path = scratch_path(t.spark, "sketches")
    sketches.refresh(rows.filter("month < '1995-01'"), path, "month", SKETCHED)
    return rows, sketches.refresh(rows.filter("month >= '1995-01'"), path, "month", SKETCHED)


@query("describe_sketched", HOUSING_SQL + _union(
    [f"""SELECT '{c}' AS "column", count({c}) AS count, min({c}) AS min, max({c}) AS max, true AS within_error FROM housing""" for c in SKETCHED]))
def q_describe_sketched(t):
    """Counts, ends and quartiles of the months' merged sketches; the ranks of
    the quartiles are compared with the bound on all rows."""
    rows, path = sketched_months(t)
    found = sketches.describe(versions.read(t.spark, path))
    errors = sketches.rank_errors(rows, found).groupBy("column").agg((F.max("error") <= 2 * sketches.rank_error()).alias("within_error"))
    return found.join(errors, "column").select("column", "count", "min", "max", "within_error")


SAMPLE_FRACTION, SAMPLE_LIMIT = 0.05, 500


@query("scatter_sample", HOUSING_SQL + f"""
SELECT row_key, quantity, price FROM (
  SELECT row_key, quantity, price, CAST(('0x' || substr(md5(row_key), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0 AS h
  FROM housing)
WHERE h < {SAMPLE_FRACTION} ORDER BY h, row_key LIMIT {SAMPLE_LIMIT}""")
def q_scatter_sample(t):
    return pf.scatter_sample(housing(t), "row_key", ["quantity", "price"], SAMPLE_FRACTION, SAMPLE_LIMIT)


GRID_BOX, GRID_CELL = (1.0, 50.0, 0.0, 0.1), (5.0, 0.02)


@query("grid_density", HOUSING_SQL + f"""
SELECT CAST(floor((quantity - {GRID_BOX[0]}) / {GRID_CELL[0]}) AS INTEGER) AS cell_x,
       CAST(floor((discount - {GRID_BOX[2]}) / {GRID_CELL[1]}) AS INTEGER) AS cell_y,
       count(*) AS count, round(avg(price), 6) AS mean_value
FROM housing WHERE quantity BETWEEN {GRID_BOX[0]} AND {GRID_BOX[1]} AND discount BETWEEN {GRID_BOX[2]} AND {GRID_BOX[3]}
GROUP BY 1, 2""")
def q_grid_density(t):
    return pf.grid_density(housing(t), "quantity", "discount", "price", GRID_BOX, GRID_CELL)
