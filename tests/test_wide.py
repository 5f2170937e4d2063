"""Co-moments of many columns, sparse one-hot, mergeable sketches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeline.operators import prepare, profile, sketches, versions, wide
from lakeline.plans.profiles import NUMERIC, housing
from lakeline.session import scratch_path


def matrix(df):
    return {(r.col_a, r.col_b): r["corr"] for r in df.collect()}


def test_wide_correlations_equal_the_expression_form(tables):
    h = housing(tables)
    a, b = matrix(wide.corr_wide(h, NUMERIC, 12)), matrix(profile.corr_matrix(h, NUMERIC, 12))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_wide_correlations_of_missing_and_constant_columns(spark):
    nan = float("nan")
    rows = [(1.0, 2.0, 0.1, None, nan), (2.0, nan, 0.1, 5.0, None), (3.0, 7.0, 0.1, 4.0, nan), (4.0, 5.0, 0.1, None, None), (None, 6.0, 0.1, 3.0, nan)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(3)
    cols = ["a", "b", "c", "d", "e"]
    x, y = matrix(wide.corr_wide(df, cols)), matrix(profile.corr_matrix(df, cols))
    assert all((x[k] is None) == (y[k] is None) and (x[k] is None or x[k] == pytest.approx(y[k], abs=1e-7)) for k in y)
    assert x["c", "c"] is None and x["e", "a"] is None and x["a", "a"] == 1.0
    assert set(matrix(wide.corr_wide(df.filter("false"), cols)).values()) == {None}


def test_three_hundred_columns(spark):
    d, n = 300, 400
    rng = np.random.default_rng(6)
    base = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 1e6
    df = spark.createDataFrame([(r.tolist(),) for r in base], "v array<double>").repartition(9)
    cols = [f"x{i}" for i in range(d)]
    got = matrix(wide.corr_wide(df.select(*[F.col("v")[i].alias(c) for i, c in enumerate(cols)]), cols))
    want = np.corrcoef(base.T)
    assert len(got) == d * d and max(abs(got[a, b] - want[i, j]) for i, a in enumerate(cols) for j, b in enumerate(cols)) < 1e-6


def test_arrays_meet_in_a_tree(spark):
    rows = spark.range(1000).selectExpr("cast(id AS double) AS x").repartition(50)
    assert wide.reduce_arrays(rows, lambda x: np.array([x.sum(), len(x)]), np.add, fan=3).tolist() == [499500.0, 1000.0]
    assert wide.reduce_arrays(rows.filter("false"), lambda x: x.sum(0), np.add) is None


def test_sparse_one_hot_of_a_hundred_thousand_categories(spark):
    train = spark.range(100_000).selectExpr("concat('c', lpad(id, 6, '0')) AS c")
    enc = prepare.fit_sparse(train, "c")
    assert enc.size == 100_000
    df = spark.sql("SELECT 'c000007' AS c UNION ALL SELECT 'unseen' UNION ALL SELECT NULL UNION ALL SELECT 'c099999'")
    got = {r.c: (r.v.size, r.v.indices, r.v["values"]) for r in enc.transform(df, "v").collect()}
    assert got == {"c000007": (100_000, [7], [1.0]), "c099999": (100_000, [99_999], [1.0]), "unseen": (100_000, [], []), None: (100_000, [], [])}
    none = prepare.fit_sparse(train.filter("false"), "c")
    assert none.size == 0 and [r.v.indices for r in none.transform(df, "v").collect()] == [[]] * 4


def test_sketches_merge_within_their_bound_and_refresh_by_month(spark):
    n = 60_000
    df = spark.range(n).selectExpr("cast(id % 12 AS int) AS month", "pow(id * 7919 % 60013, 2) AS x", "if(id % 3 = 0, double('NaN'), cast(id % 5 AS double)) AS y")
    path = scratch_path(spark, "sketches")
    for half in ("month < 6", "month >= 6"):
        sketches.refresh(df.filter(half), path, "month", ["x", "y"])
    table = versions.read(spark, path)
    assert table.count() == 20  # y is missing throughout in four months
    found = sketches.describe(table, (0.01, 0.5, 0.99))
    row = {r["column"]: r for r in found.collect()}
    assert row["x"]["count"] == n and row["y"]["count"] == n - n // 3 and row["y"]["max"] == 4.0
    errors = sketches.rank_errors(df, found, (0.01, 0.5, 0.99)).agg(F.max("error")).first()[0]
    assert errors <= 2 * sketches.rank_error() < 0.02
    # One month again, with other rows: the other months' files stay.
    before = set(table.inputFiles())
    sketches.refresh(df.filter("month = 3 AND x > 1e6"), path, "month", ["x", "y"])
    after = set(versions.read(spark, path).inputFiles())
    assert len(before - after) <= 1 and versions.read(spark, path).filter("month = 3 AND column = 'x'").first()["min"] > 1e6
