"""Invariants: allocation to the cent, idempotent upsert, incremental = full,
each row in one partition / split, scaler moments, solver agreement, and
numbering that survives a hot key."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeline.operators import keys, merge, prepare, regress, star, versions
from lakeline.plans import delivery, features, profiles


def test_allocation_reconciles_to_the_cent(tables):
    lines = delivery.allocated_lines(tables)
    pay = delivery.raw_payments(tables)
    per = lines.groupBy("order_id").agg(*[F.sum(f"allocated_{a}").alias(a)
                                          for a in ("discount_amount", "delivery_fee", "tip_amount")])
    bad = per.join(pay, "order_id").filter(
        (per["discount_amount"] != pay["discount_amount"]) | (per["delivery_fee"] != pay["delivery_fee"]) |
        (per["tip_amount"] != pay["tip_amount"]))
    assert bad.count() == 0


def test_allocation_equal_split_on_zero_weight(spark):
    lines = spark.createDataFrame([(1, 1, 0.0), (1, 2, 0.0), (1, 3, 0.0)], "o long, ln int, w double") \
        .withColumn("w", F.col("w").cast("decimal(14,2)"))
    orders = spark.createDataFrame([(1, 1.00)], "o long, amt double").withColumn("amt", F.col("amt").cast("decimal(14,2)"))
    out = star.allocate(lines, orders, "o", "ln", "w", ["amt"]).orderBy("ln").collect()
    assert [float(r["allocated_amt"]) for r in out] == [0.33, 0.33, 0.34]


def test_ordinal_matches_row_number_with_a_hot_key(spark):
    # one key holds a third of the rows
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("g"),
        F.col("id").alias("v"))
    got = keys.ordinal(df, [F.col("v")], ["g"], "rn", partitions=8)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v")).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and got.count() == 3000


def test_exact_quantiles_match_numpy(spark):
    vals = [float(x) for x in np.random.default_rng(1).normal(size=501)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    got = keys.quantile_map(df, ["x"], [0.1, 0.5, 0.9])
    for p in (0.1, 0.5, 0.9):
        assert got[("x", p)] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12)


def test_upsert_dedupes_is_idempotent_and_ignores_empty(spark):
    b1 = spark.createDataFrame([("1", "a", 1), ("2", "b", 1), ("1", "c", 2)], "id string, payload string, w int")
    one = merge.upsert(None, b1, ["id"], ["w", "payload"], stamp=F.lit(1))
    assert sorted((r["id"], r["payload"]) for r in one.collect()) == [("1", "c"), ("2", "b")]
    again = merge.upsert(one, b1, ["id"], ["w", "payload"], stamp=F.lit(1))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, one.collect()))
    empty = b1.limit(0)
    assert merge.upsert(one, empty, ["id"], ["w", "payload"]) is one


def test_incremental_two_loads_equal_full(spark, tables):
    from lakeline.plans.warehouse import daily_events, INCR_CUT
    ev = tables.events
    first = ev.filter(F.col("ts") < F.lit(INCR_CUT).cast("timestamp_ntz"))
    path = merge.incremental_load(None, first, "ts", "event_date", daily_events, ["event_date", "event_type"])
    path = merge.incremental_load(path, ev, "ts", "event_date", daily_events, ["event_date", "event_type"])
    got = versions.read(spark, path).select("event_date", "event_type", "events", "total_value", "max_value")
    assert got.exceptAll(daily_events(ev)).count() == 0 and got.count() == daily_events(ev).count()


def test_every_row_in_one_split(tables):
    f = features.feats(tables)
    assert f.filter(F.col("split").isNull()).count() == 0
    assert f.groupBy("row_key").count().filter("count > 1").count() == 0


def test_standard_scaler_moments(tables):
    h = profiles.housing(tables)
    out = prepare.fit_standard(h, ["price"]).transform(h)
    row = out.agg(F.avg("price").alias("m"), F.stddev_pop("price").alias("s")).first()
    assert abs(row["m"]) < 1e-9 and row["s"] == pytest.approx(1.0, rel=1e-9)


def test_minmax_constant_column_maps_to_lower_bound(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r["x"] for r in prepare.fit_minmax(df, ["x"]).transform(df).collect()] == [-1.0, -1.0]


def test_solvers_agree(spark, tables):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    h = profiles.housing(tables)
    a = regress.fit_normal(h, ["quantity", "discount"], "price").coef
    b = regress.fit_pinv(h, ["quantity", "discount"], "price").coef
    assert np.allclose(a, b, rtol=1e-9)
    vec = VectorAssembler(inputCols=["quantity", "discount"], outputCol="f").transform(h)
    lib = LinearRegression(featuresCol="f", labelCol="price", solver="normal", regParam=0.0).fit(vec)
    assert np.allclose(a, [lib.intercept, *lib.coefficients], rtol=1e-6)
    scaled = prepare.fit_standard(h, ["quantity"]).transform(h)
    gd = regress.fit_gd(scaled, ["quantity"], "price").coef
    closed = regress.fit_normal(scaled, ["quantity"], "price").coef
    assert np.allclose(gd, closed, rtol=1e-8)
    mb = regress.fit_minibatch(scaled, "row_key", ["quantity"], "price", epochs=5).coef
    assert abs(mb[0] - closed[0]) / abs(closed[0]) < 0.2
    # Fewer rows than batches, and rows without a feature, do no harm.
    few = spark.createDataFrame([(k, float(k), 2.0 * k + 1) for k in range(-5, 6)] + [(99, None, 1.0)], "row_key long, x double, y double")
    assert np.allclose(regress.fit_minibatch(few, "row_key", ["x"], "y", epochs=400, t0=20.0).coef, [1.0, 2.0], atol=1e-3)


def test_mixed_preparation_picks_columns_by_type(spark):
    import datetime

    day = datetime.date(2024, 1, 1)
    df = spark.createDataFrame([("k1", 1.0, 2, "a", day), ("k2", None, 4, None, day), ("k3", 3.0, 6, "b", day)],
                               "key string, x double, n int, c string, d date")
    out = prepare.fit_mixed(df, leave=["key"]).transform(df)
    assert set(out.columns) == {"key", "d", "num__x", "num__n", "cat__c_a", "cat__c_b"}
    assert out.filter("key = 'k2'").select("num__x").first()[0] == 0.0


def test_unknown_category_is_all_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    enc = prepare.fit_onehot(train, "c")
    row = enc.transform(spark.createDataFrame([("z",), (None,)], "c string")).collect()
    assert all(v == 0.0 for r in row for v in r)


def test_forest_flags_the_planted_outlier(spark):
    from lakeline.operators import forest

    rng = np.random.default_rng(0)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(2000, 2)))]
    rows.append((99999, 25.0, -25.0))
    df = spark.createDataFrame(rows, "k long, a double, b double")
    model = forest.fit(df, "k", ["a", "b"], n_trees=50, sample_size=128, seed=3)
    top = model.score(df).orderBy(F.desc("score")).first()
    assert top["k"] == 99999 and top["score"] > 0.6


def test_surrogate_keys_keep_existing_and_extend(spark):
    first = star.surrogate_keys(spark.createDataFrame([(30, "c"), (10, "a")], "id long, name string"), ["id"], "k")
    assert sorted((r["k"], r["id"]) for r in first.collect()) == [(1, 10), (2, 30)]
    batch = spark.createDataFrame([(20, "b"), (10, "a"), (40, "d"), (20, "b")], "id long, name string")
    second = star.surrogate_keys(batch, ["id"], "k", existing=first)
    assert sorted((r["k"], r["id"]) for r in second.collect()) == [(1, 10), (2, 30), (3, 20), (4, 40)]


def test_global_ordinal_distributed_path_matches_row_number(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("v"), F.col("id"))
    got = keys.ordinal(df, [F.col("v"), F.col("id")], None, "rn", partitions=8)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("v", "id")).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and got.count() == 5000
    q = keys.quantile_map(df, ["v"], [0.5])
    assert q[("v", 0.5)] == float(np.quantile(np.array([(i * 7919) % 5003 for i in range(5000)]), 0.5))


def test_upsert_into_updates_touched_buckets_and_repeats_cleanly(spark):
    schema = "id string, payload string, w int"
    b1 = spark.createDataFrame([(str(i), f"p{i}", 1) for i in range(200)], schema)
    path = merge.upsert_into(None, b1, ["id"], ["w", "payload"], stamp=F.lit(1), buckets=16)
    b2 = spark.createDataFrame([("5", "new", 2), ("999", "x", 2), ("5", "older", 1)], schema)
    path = merge.upsert_into(path, b2, ["id"], ["w", "payload"], stamp=F.lit(2), buckets=16)
    path = merge.upsert_into(path, b2, ["id"], ["w", "payload"], stamp=F.lit(2), buckets=16)  # a retry
    rows = {r["id"]: r["payload"] for r in versions.read(spark, path).collect()}
    assert len(rows) == 201 and rows["5"] == "new" and rows["999"] == "x" and rows["6"] == "p6"
    assert versions.read(spark, path).count() == 201


def test_quantiles_when_most_rows_share_one_value(spark):
    x = [5.0] * 900 + [float(k) for k in range(100)]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = keys.quantile_map(df, ["x"], [0.0, 0.02, 0.25, 0.5, 0.97, 1.0])
    assert all(got["x", p] == float(np.quantile(x, p)) for p in (0.0, 0.25, 0.5, 1.0))
    assert all(abs(got["x", p] - float(np.quantile(x, p))) < 1e-9 for p in (0.02, 0.97))
