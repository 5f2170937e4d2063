"""Regression solvers: exact mini-batches against the serial loop, QR on an
ill-conditioned design, missing values and empty tables."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeline.operators import forest, prepare, regress


def serial(spark, rows, epochs, size, t0, t1, seed):
    """The loop over batches, one after the other.  rows: (key, x..., y)."""
    d = len(rows[0]) - 1
    keys = spark.createDataFrame([(r[0],) for r in rows], "key long")
    theta, t = np.zeros(d), 0
    for e in range(epochs):
        h = dict(keys.select("key", F.xxhash64("key", F.lit(seed), F.lit(e).cast("long"))).collect())
        order = sorted(rows, key=lambda r: ((h[r[0]] % 2**64) >> 1, h[r[0]], r[0]))
        data = np.array([[1.0, *r[1:]] for r in order])
        for lo in range(0, len(data), size):
            x, y = data[lo:lo + size, :-1], data[lo:lo + size, -1]
            theta = theta - t0 / (t + t1) * (2.0 / len(x)) * (x.T @ (x @ theta - y))
            t += 1
    return theta


@pytest.mark.parametrize("n,size,slices,together,epochs", [(503, 20, 7, 3, 5), (60, 20, 8, 8, 4), (7, 20, 3, 1, 3), (200, 1, 5, 2, 2), (41, 13, 16, 4, 6), (40, 20, 1, 2, 3)])
def test_minibatches_equal_the_serial_loop(spark, n, size, slices, together, epochs):
    rng = np.random.default_rng(n)
    rows = [(int(k), *map(float, rng.normal(size=2)), float(rng.normal())) for k in rng.permutation(n)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y double").repartition(4)
    got = regress.fit_minibatch(df, "k", ["a", "b"], "y", epochs=epochs, batch_rows=size, t0=3.0, t1=50.0, seed=9, together=together, slices=slices)
    want = serial(spark, rows, epochs, size, 3.0, 50.0, 9)
    assert got.terms == ["intercept", "a", "b"] and np.allclose(got.coef, want, rtol=1e-9, atol=1e-12)


def test_minibatches_reshuffle_every_epoch_and_ignore_the_layout(spark):
    rows = [(k, float(k % 7), float(3 * (k % 7) + k % 3)) for k in range(300)]
    df = spark.createDataFrame(rows, "k long, x double, y double")
    args = (["x"], "y")
    one = regress.fit_minibatch(df, "k", *args, epochs=3, t0=2.0, t1=100.0).coef
    assert np.allclose(one, regress.fit_minibatch(df.repartition(9).orderBy(F.desc("k")), "k", *args, epochs=3, t0=2.0, t1=100.0, slices=3).coef, rtol=1e-9)
    assert not np.allclose(one, regress.fit_minibatch(df, "k", *args, epochs=3, t0=2.0, t1=100.0, seed=7).coef, rtol=1e-6)


def test_qr_keeps_digits_that_the_gram_form_loses(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=2000)
    x = np.column_stack([a, a + 1e-9 * rng.normal(size=2000), rng.normal(size=2000)])
    y = x @ [1.0, 2.0, 3.0] + 4.0
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, y double").repartition(40)
    design = np.column_stack([np.ones(2000), x])
    assert np.linalg.cond(design) > 5e8
    want = np.linalg.pinv(design, rcond=1e-13) @ y
    got = regress.fit_pinv(df, ["a", "b", "c"], "y").coef
    assert np.allclose(got, want, rtol=1e-5) and np.allclose(got, [4, 1, 2, 3], atol=1e-5)
    gram = np.linalg.pinv(design.T @ design, rcond=1e-13) @ (design.T @ y)
    assert not np.allclose(gram, [4, 1, 2, 3], atol=1e-2)  # the sums of squares can't tell a from b


def test_qr_tree_of_many_factors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").repartition(60)
    r = regress.qr_factor(rows, fan=4)
    assert np.allclose(r.T @ r, x.T @ x, rtol=1e-10) and np.allclose(np.tril(r, -1), 0)
    few = regress.qr_factor(rows.limit(2))
    assert few.shape == (3, 3)


def test_minimum_norm_with_equal_columns(spark):
    df = spark.createDataFrame([(float(k), 2.0 * k, 5.0 * k + 1) for k in range(50)], "x double, x2 double, y double")
    assert np.allclose(regress.fit_pinv(df, ["x", "x2"], "y").coef, [1.0, 1.0, 2.0], atol=1e-9)


@pytest.mark.parametrize("fit", [regress.fit_normal, regress.fit_pinv, lambda *a: regress.fit_gd(*a, epochs=3000),
                                 lambda df, f, y: regress.fit_minibatch(df, "k", f, y, epochs=400)])
def test_missing_values_take_no_part_in_fits(spark, fit):
    nan = float("nan")
    good = [(k, float(k) / 5, 2.0 * k / 5 + 1) for k in range(-5, 6)]
    df = spark.createDataFrame([*good, (90, nan, 1.0), (91, 1.0, nan), (92, None, 1.0), (93, 1.0, None)], "k long, x double, y double")
    assert np.allclose(fit(df, ["x"], "y").coef, [1.0, 2.0], atol=1e-3)
    with pytest.raises(ValueError):
        fit(df.filter("k >= 90"), ["x"], "y")


def test_outlier_rules_on_missing_values_and_empty_tables(spark):
    nan = float("nan")
    df = spark.createDataFrame([(float(k),) for k in range(20)] + [(1000.0,), (nan,), (None,)], "x double")
    flags = [(r.x, r.is_outlier) for r in prepare.iqr_flags(df, "x").collect()]
    assert (1000.0, True) in flags and sum(f is True for _, f in flags) == 1 and sum(f is None for _, f in flags) == 2
    none = df.filter("false")
    assert prepare.iqr_flags(none, "x").count() == 0
    assert [r.is_outlier for r in prepare.iqr_flags(df.filter("x IS NULL"), "x").collect()] == [None]
    assert forest.flag(none.withColumn("score", F.col("x")), contamination=0.01).count() == 0
    rows = spark.createDataFrame([(k, float(k % 10), float(k % 7)) for k in range(300)] + [(900, 500.0, -500.0), (901, nan, 1.0), (902, None, 1.0)], "k long, a double, b double")
    model = forest.fit(rows, "k", ["a", "b"], n_trees=20, sample_size=64)
    scored = {r.k: r.score for r in model.score(rows).collect()}
    assert scored[901] is None and scored[902] is None and max((s, k) for k, s in scored.items() if s is not None)[1] == 900
    flagged = {r.k: r.is_outlier for r in forest.flag(model.score(rows), contamination=0.01).collect()}
    assert flagged[900] is True and flagged[901] is None
    assert forest.fit(rows.filter("false"), "k", ["a", "b"], n_trees=3).score(rows.filter("false")).count() == 0


def test_minibatch_jobs_leave_no_shuffle_files_behind(spark, monkeypatch):
    """Every epoch deals out every row; the disk holds the files of one job."""
    monkeypatch.setattr(regress, "JOB_ROWS", 1)  # a job for each epoch
    df = spark.range(20_000).selectExpr("concat('a long key of the row ', id) AS k", "id % 50 / 10.0D AS x", "id % 50 * 0.3D + id % 7 AS y")
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_bytes():
        files = tracker.getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))

    one = regress.fit_minibatch(df, "k", ["x"], "y", epochs=1, t0=2.0, t1=100.0, slices=4)
    before = shuffle_bytes()
    assert len(one.coef) == 2
    regress.fit_minibatch(df, "k", ["x"], "y", epochs=6, t0=2.0, t1=100.0, slices=4)
    left, until = shuffle_bytes(), time.time() + 10
    while left > before + 100_000 and time.time() < until:  # they go in the background
        time.sleep(0.2)
        left = shuffle_bytes()
    assert left <= before + 100_000  # an epoch has 160,000 at least: 8 random bytes a row


def test_epoch_hashes_equal_those_of_spark(spark):
    keys = spark.createDataFrame([("",), ("a",), (None,), ("1|2|3|4|500",), ("a much longer key of more than thirty-two bytes",)], "key string")
    for seed in (42, 2**40):
        k = np.array([r[0] for r in keys.select(F.xxhash64("key", F.lit(seed))).collect()], np.int64).view(np.uint64)
        for e in (0, 1, 49, 10**6):
            want = [r[0] for r in keys.select(F.xxhash64("key", F.lit(seed), F.lit(e).cast("long"))).collect()]
            assert regress._hashed(k, e).view(np.int64).tolist() == want


def test_rows_are_dealt_out_in_blocks():
    """Spark moves a block for each epoch and slice of a chunk, not a row for each row and epoch."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    rows = rng.integers(0, 2**63, (5000, 3), dtype=np.uint64)
    stored = pa.RecordBatch.from_pydict({"block": pa.array([rows[:3000].tobytes(), rows[3000:].tobytes()], pa.binary())})
    heavy = np.zeros((2, 7), bool)
    heavy[1, 4] = True
    out = [r for b in regress._dealer(3, range(4, 6), 7, heavy)(iter([stored])) for r in b.to_pylist()]
    assert sorted(r["cell"] for r in out) == [*range(28, 35), *(c for c in range(35, 42) if c != 39)]
    got = np.concatenate([np.frombuffer(r["block"], np.uint64).reshape(-1, 3) for r in out if r["cell"] < 35])
    h = regress._hashed(rows[:, 0], 4)
    assert sorted(map(tuple, got.tolist())) == sorted(zip(h.tolist(), rows[:, 1].tolist(), rows[:, 2].tolist(), strict=True))
    left = [r for b in regress._heavy_rows(3, range(4, 6), 7, heavy)(iter([stored])) for r in b.to_pylist()]
    assert len(left) + sum(len(r["block"]) // 24 for r in out) == 10_000 and {r["slice"] for r in left} == {4}


@pytest.mark.parametrize("cell_bytes,chunk_bytes", [(1 << 26, 1 << 9), (1, 1 << 21), (2500, 1 << 10)])
def test_hot_keys_and_parts_of_cells_equal_the_serial_loop(spark, monkeypatch, cell_bytes, chunk_bytes):
    """Cells that are too large for a task's memory, and cells sorted part by part."""
    monkeypatch.setattr(regress, "CELL_BYTES", cell_bytes)
    monkeypatch.setattr(regress, "CHUNK_BYTES", chunk_bytes)
    rng = np.random.default_rng(5)
    keys = [*range(300), *[7] * 150, *[11] * 20]  # equal keys come in the order of their values
    rows = sorted((int(k), *map(float, rng.normal(size=2)), float(rng.normal())) for k in keys)
    df = spark.createDataFrame(rows, "k long, a double, b double, y double").repartition(4)
    got = regress.fit_minibatch(df, "k", ["a", "b"], "y", epochs=5, batch_rows=20, t0=3.0, t1=50.0, seed=9, together=2, slices=6)
    assert np.allclose(got.coef, serial(spark, rows, 5, 20, 3.0, 50.0, 9), rtol=1e-9, atol=1e-12)
