"""Plan shape: pruning reaches the scan, small dimensions are broadcast."""

from pyspark.sql import functions as F

from lakeline.operators import layout
from lakeline.plans import layouts, reports
from lakeline.session import scratch_path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_filters_on_month_layout(spark, tables):
    path = layouts.range_layout(tables)
    df = spark.read.parquet(path).filter(F.col("order_month") == "1996-03")
    assert "PartitionFilters: [isnotnull(order_month" in _plan(df)


def test_dimension_join_is_broadcast(tables):
    assert "BroadcastHashJoin" in _plan(reports.enriched(tables))


def test_window_filter_pushed_to_parquet(tables):
    from lakeline.sources import files
    plan = _plan(files.extract_window(tables.events, "ts", "2024-01-08", "2024-01-15"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_retention_drops_only_old_partitions(spark, tables):
    path = layouts.range_layout(tables, "retain-test")
    dropped = layout.drop_partitions_before(spark, path, "order_month", "1998-01")
    assert dropped and all(d < "1998-01" for d in dropped)
    left = [r[0] for r in spark.read.parquet(path).select("order_month").distinct().collect()]
    assert min(left) >= "1998-01"


def test_strict_layout_rejects_unrouted_rows(spark):
    df = spark.createDataFrame([("AMERICA",), ("AFRICA",)], "region string")
    routed = layout.with_partition(df, "p", layout.list_route("region", ["AMERICA"]))
    try:
        layout.write_layout(routed, "p", scratch_path(spark, "strict"), strict=True)
        raise AssertionError("expected a failure")
    except ValueError:
        pass


def test_flagship_plan_pushes_rules_and_pre_aggregates(tables):
    from lakeline.operators import gold
    plan = _plan(gold.revenue_by_zone_month(reports.enriched(tables)))
    # quality rules reach the lineitem scan, only used columns are read
    assert "(l_quantity" in plan and "DataFilters: [isnotnull(l_quantity" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double" in plan
    # map-side partial aggregation before the one grouping shuffle
    assert "partial_sum(total_amount" in plan
    assert plan.count("BroadcastHashJoin") >= 2


def test_month_file_set_read_prunes_folders(spark, tables):
    from lakeline.sources import files
    base = files.write_monthly(tables.orders, "o_orderdate", scratch_path(spark, "orders-monthly-test"))
    plan = _plan(files.read_month(spark, base, 1996, 3))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan and "(month" in plan


def test_region_and_customer_reads_are_pruned(spark, tables):
    from lakeline.plans import layouts

    path = layouts.list_layout(tables)
    assert "PartitionFilters: [isnotnull(region_part" in _plan(spark.read.parquet(path).filter(F.col("region_part") == "ASIA"))
    df = spark.read.parquet(layouts.hash_layout(tables))
    one = layouts.of_customer(df, 7)
    assert "PartitionFilters: [isnotnull(cust_bucket" in _plan(one)
    assert one.count() == df.filter("o_custkey = 7").count()


def test_layouts_keep_every_row(spark, tables):
    from lakeline.plans import layouts

    n = tables.orders.count()
    for make in (layouts.range_layout, layouts.list_layout, layouts.hash_layout):
        assert spark.read.parquet(make(tables)).count() == n


def test_merge_reads_and_writes_only_touched_folders(spark):
    from lakeline.operators import versions
    from lakeline.session import scratch_path

    old = spark.range(100).selectExpr("id AS k", "id % 10 AS part", "'old' AS v")
    path = versions.create(old, scratch_path(spark, "merge-test"), "part", ["k"])
    files = lambda: {d: sorted(f for f in versions.read(spark, path).inputFiles() if f"/{d}/" in f) for d in versions.latest(spark, path).folders}
    before = files()
    versions.merge(path, spark.sql("SELECT 3L AS k, 3L AS part, 'new' AS v"), ["k"], "part")
    after = files()
    assert [d for d in before if before[d] != after[d]] == ["part=3"]
    rows = {r["k"]: r["v"] for r in versions.read(spark, path).collect()}
    assert len(rows) == 100 and rows[3] == "new" and rows[13] == "old"


def test_allocation_join_splits_a_hot_order(spark):
    from lakeline.operators import star
    from lakeline.session import stored

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    lines = stored(spark.range(60_000).repartition(6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS o", "CAST(id AS INT) AS ln", "CAST(id % 7 + 1 AS DECIMAL(14,2)) AS w"), "hot-lines")
    totals = lines.groupBy("o").agg(F.sum("w").alias("__w_total"), F.count("*").alias("__n_lines"), F.max("ln").alias("__last"))
    per_order = stored(totals.withColumn("amt", F.lit(100).cast("decimal(14,2)")), "hot-orders")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        x = star.line_shares(lines, per_order, "o", "ln", "w", ["amt"])
        assert len(x.collect()) == 60_000
        assert "skew=true" in _plan(x)
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_few_ordinal_codes_of_many_rows_are_broadcast(spark):
    """The size of the code table counts, not that of the rows it comes from:
    else all rows of a frequent value meet in one task."""
    from lakeline.operators import prepare
    from lakeline.session import stored

    rows = stored(spark.range(100_000).selectExpr("id AS k", "substr('ANR', CAST(id % 3 AS INT) + 1, 1) AS c"), "ordinal-rows")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")  # the rows are above, the codes below
        coded = prepare.fit_ordinal(rows, "c").transform(rows, "code")
        assert "BroadcastHashJoin" in _plan(coded) and "SortMergeJoin" not in _plan(coded)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.c, r.code): r["count"] for r in coded.groupBy("c", "code").count().collect()} == {("A", 0): 33_334, ("N", 1): 33_333, ("R", 2): 33_333}


def _hot(monkeypatch, most):
    from lakeline.plans import delivery

    monkeypatch.setattr(delivery, "HOT_LINES", most)


def test_allocation_of_hot_orders_equals_that_of_others(spark, tables, monkeypatch):
    from lakeline.plans import delivery
    from lakeline.plans.tables import Tables

    plain = delivery.fact_lines(Tables(spark, tables.sf_dir))
    _hot(monkeypatch, 4)
    t = Tables(spark, tables.sf_dir)
    both = delivery.fact_lines(t)
    assert 0 < delivery.hot_orders(t).count() < t.orders.count()
    assert plain.exceptAll(both).isEmpty() and both.exceptAll(plain).isEmpty()


def test_star_lines_move_to_their_part_and_their_order_only(spark, tables, monkeypatch):
    """Nothing is written on the way, and dimensions of an order are looked up
    for the order: no line moves to its customer, city, payment or promotion."""
    from lakeline.operators import star
    from lakeline.plans import delivery
    from lakeline.plans.tables import Tables

    monkeypatch.delattr(star, "stored")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(delivery.fact_lines(Tables(spark, tables.sf_dir)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(order_id") == 2  # lines, headers
    for key in ("customer_id", "customer_key"):
        assert f"Exchange hashpartitioning({key}" not in plan
