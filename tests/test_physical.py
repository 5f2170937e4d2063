"""Plans of the physical layouts: no shuffle on a bucket key, one bucket read,
folders pruned by a dimension, row groups skipped; checked writes in one pass."""

import pytest
from pyspark.sql import functions as F

from lakeline.operators import checks, layout
from lakeline.plans import delivery, layouts
from lakeline.session import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_scanned(df, having=""):
    """Rows that the scans of ``df`` (those with ``having`` in their plan) gave
    out, after running it."""
    df.write.format("noop").mode("overwrite").save()
    frame = df.select("*")
    frame.collect()
    found, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
        if name.startswith("Scan") and having in node.simpleString(10_000):
            found += node.metrics().apply("numOutputRows").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_join_and_aggregate_without_exchange(spark, tables, no_broadcast):
    orders, customers = layouts.bucketed_orders(tables), layouts.bucketed_customers(tables)
    df = layouts.revenue_by_customer_segment(orders, customers)
    assert "SortMergeJoin" in plan(df) and "Exchange" not in plan(df)
    assert len(orders.inputFiles()) <= layouts.BUCKETS
    assert df.count() == tables.orders.select("o_custkey").distinct().count()


def test_bucket_pruning(spark, tables):
    whole = layouts.bucketed_orders(tables)
    df = whole.filter("o_custkey = 7")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else a plain scan, which prunes buckets but doesn't say so
    try:
        assert f"SelectedBucketsCount: 1 out of {layouts.BUCKETS}" in plan(df.select("*"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert rows_scanned(df) < whole.count() / 4
    assert df.count() == tables.orders.filter("o_custkey = 7").count()


def test_folders_are_pruned_by_the_dimension(spark, tables):
    fact = spark.read.parquet(layouts.range_layout(tables))
    df = layouts.of_quarter(fact, delivery.dim_date(tables))
    assert "dynamicpruning" in plan(df)
    hits = tables.orders.filter("year(o_orderdate) = 1996 AND month(o_orderdate) IN (4, 5, 6)").count()
    assert df.count() == hits == rows_scanned(df, "dynamicpruning") < fact.count() / 10  # the three months' rows alone


def test_row_groups_are_skipped_by_the_order_inside_a_folder(spark):
    df = spark.range(200_000).selectExpr("id AS k", "id % 2 AS part", "cast(id AS string) AS pad").repartition(7)
    path = layout.write_layout(df, "part", scratch_path(spark, "ordered"), spread=["k"], row_group_bytes=32 << 10)
    got = spark.read.parquet(path).filter(F.col("k").between(50_000, 50_999))
    assert got.count() == 1000
    assert rows_scanned(got) < 60_000  # of 200,000
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,50000)" in plan(got)


def test_strict_layout_fails_inside_the_write(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, part string")
    with pytest.raises(ValueError, match="outside every declared partition of part"):
        layout.write_layout(df, "part", scratch_path(spark, "strict"))
    path = layout.write_layout(df, "part", scratch_path(spark, "lenient"), strict=False)
    assert {r.part for r in spark.read.parquet(path).collect()} == {"a", layout.UNROUTED}


def test_monthly_write_makes_few_files(spark, tables):
    from lakeline.sources import files

    base = files.write_monthly(tables.orders.repartition(16), "o_orderdate", scratch_path(spark, "monthly"))
    read = spark.read.parquet(base)
    months = tables.orders.select(F.trunc("o_orderdate", "month")).distinct().count()
    assert len(read.inputFiles()) <= months + int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert read.drop("year", "month").exceptAll(tables.orders).count() == 0


def test_checked_write_counts_and_puts_aside_in_one_pass(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (None, 5, "a"), (3, 9, "z"), (4, None, None), (None, 9, "b")], "k int, n int, ref string")
    to = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "ref string")
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    source = rows.mapInArrow(seen, rows.schema)
    path = scratch_path(spark, "checked")
    found = dict(checks.write_checked(source, [checks.NotNull("k"), checks.AcceptedValues("n", [5, 6]), checks.Relationship("ref", to, "ref")], path).collect())
    assert found == {"rows_in": 5, "rows_kept": 2, "rows_quarantined": 3, "not_null:k": 2, "accepted_values:n": 2, "relationships:ref->ref": 1}
    assert reads.value == 5  # the source was read once
    good = checks.kept(spark, path, rows.schema)
    assert good.columns == rows.columns and sorted(map(tuple, good.collect()), key=str) == [(1, 5, "a"), (4, None, None)]
    bad = {(r.k, r.n, r.ref): r.failed for r in checks.quarantined(spark, path, rows.schema).collect()}
    assert bad == {(None, 5, "a"): ["not_null:k"], (3, 9, "z"): ["accepted_values:n", "relationships:ref->ref"], (None, 9, "b"): ["not_null:k", "accepted_values:n"]}
    none = scratch_path(spark, "checked-none")
    empty = dict(checks.write_checked(rows.filter("false"), [checks.NotNull("k")], none).collect())
    assert empty == {"rows_in": 0, "rows_kept": 0, "rows_quarantined": 0, "not_null:k": 0} and checks.kept(spark, none, rows.schema).count() == 0
    with pytest.raises(TypeError):
        checks.write_checked(rows, [checks.Unique(["k"])], none)


def test_star_tables_are_written_once_and_read_narrow(spark, tables):
    from lakeline.plans.tables import Tables

    one, two = delivery.star_fact(Tables(spark, tables.sf_dir)), delivery.star_fact(Tables(spark, tables.sf_dir))
    assert set(one.inputFiles()) == set(two.inputFiles())
    q = delivery.star_q2(one, Tables(spark, tables.sf_dir))
    assert "ReadSchema: struct<order_id:bigint,promotion_key:int,net_revenue:decimal(14,2)>" in plan(q)


def test_each_call_of_a_star_query_does_its_whole_job(spark, tmp_path):
    """A second call reads nothing that the first one derived: it sees rows that
    changed in place, with no other size, number of files or time of change."""
    import datetime as dt
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    from lakeline.plans.registry import load_all
    from lakeline.session import state_of

    day = pa.array([dt.datetime(2024, 1, d) for d in (1, 2)], pa.timestamp("us"))
    made = {
        "region": {"r_regionkey": [0], "r_name": ["ASIA"]},
        "nation": {"n_nationkey": [0], "n_name": ["INDIA"], "n_regionkey": [0]},
        "customer": {"c_custkey": [1], "c_nationkey": pa.array([0], pa.int32()), "c_mktsegment": ["A"]},
        "supplier": {"s_suppkey": [1], "s_name": ["one"]},
        "part": {"p_partkey": [1], "p_name": ["bolt"], "p_type": ["metal"], "p_retailprice": [2.5]},
        "orders": {"o_orderkey": [1, 2], "o_custkey": [1, 1], "o_orderstatus": ["F", "F"], "o_orderdate": day,
                   "o_totalprice": [10.0, 20.0], "o_orderpriority": ["LOW", "LOW"]},
        "lineitem": {"l_orderkey": [1, 2], "l_partkey": [1, 1], "l_suppkey": [1, 1], "l_quantity": [3.0, 4.0],
                     "l_extendedprice": [7.0, 9.0], "l_shipdate": day},
    }

    def put(name):
        pq.write_table(pa.table(made[name]), tmp_path / f"{name}.parquet", compression="none", use_dictionary=False)
        os.utime(tmp_path / f"{name}.parquet", (1_700_000_000, 1_700_000_000))

    for name in made:
        put(name)
    fact, q1 = load_all()["star_fact"], load_all()["star_q1"]
    one = fact(spark, str(tmp_path))
    assert sorted((r.order_id, r.qty) for r in one.collect()) == [(1, 3), (2, 4)]
    before = q1(spark, str(tmp_path)).first().net_revenue
    state = state_of(spark, str(tmp_path / "lineitem.parquet"))
    made["lineitem"]["l_quantity"] = [5.0, 6.0]
    put("lineitem")
    assert state_of(spark, str(tmp_path / "lineitem.parquet")) == state
    two = fact(spark, str(tmp_path))
    assert sorted((r.order_id, r.qty) for r in two.collect()) == [(1, 5), (2, 6)]
    assert not set(one.inputFiles()) & set(two.inputFiles())
    assert q1(spark, str(tmp_path)).first().net_revenue == before + 4 * 2.5
