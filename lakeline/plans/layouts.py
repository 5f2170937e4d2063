"""Layout queries (L1-L6) and the three partition-aligned workloads (C9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeline.functions.exprs import money
from lakeline.operators import gold, layout
from lakeline.plans import delivery as dl
from lakeline.plans.registry import query
from lakeline.session import scratch_path
from lakeline.functions import fixed

# Fixed values of ours: declared partitions of the layout exercises.
DECLARED_FIRST, DECLARED_LAST = "1995-01", "2000-12"  # of the unrouted-rows report alone
LIST_VALUES = fixed.LIST_REGIONS
HASH_MODULUS = fixed.HASH_MODULUS
RETAIN_FROM = "1998-01"
YEAR_FILTER = ("1996-01", "1996-12")

ORDERS_REGION_SQL = """
WITH o AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, r.r_name AS region,
         CAST(o.o_totalprice AS DECIMAL(14,2)) AS amount
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


def orders_with_region(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", money("o_totalprice").alias("amount"))
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    r = t.region.select("r_regionkey", F.col("r_name").alias("region"))
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("o_orderkey", "o_custkey", "o_orderdate", "region", "amount"))


def range_layout(t, name="orders-range"):
    bounds = layout.month_span(t.orders, "o_orderdate")
    df = layout.with_partition(orders_with_region(t), "order_month", layout.range_route("o_orderdate", bounds))
    return layout.write_layout(df, "order_month", scratch_path(t.spark, name), spread=["o_orderkey"])


def list_layout(t):
    df = layout.with_partition(orders_with_region(t), "region_part", layout.list_route("region", layout.list_values(t.region, "r_name")))
    return layout.write_layout(df, "region_part", scratch_path(t.spark, "orders-list"), spread=["o_orderkey"])


def hash_layout(t):
    df = layout.with_partition(orders_with_region(t), "cust_bucket", layout.hash_route("o_custkey", HASH_MODULUS))
    return layout.write_layout(df, "cust_bucket", scratch_path(t.spark, "orders-hash"), spread=["o_custkey"])


def _summary(t, path, col, out):
    return layout.partition_summary(t.spark, path, col, "amount").withColumnRenamed(col, out).withColumnRenamed(
        "rows", "num_rows")


RANGE_SQL_WHERE = f"o_orderdate >= TIMESTAMP '{DECLARED_FIRST}-01' AND o_orderdate < TIMESTAMP '{DECLARED_LAST}-01' + INTERVAL 1 MONTH"


@query("layout_range", ORDERS_REGION_SQL + """
SELECT strftime(o_orderdate, '%Y-%m') AS order_month, count(*) AS num_rows,
       CAST(round(sum(amount), 2) AS DOUBLE) AS amount
FROM o GROUP BY 1""")
def q_layout_range(t):
    return _summary(t, range_layout(t), "order_month", "order_month")


@query("layout_list", ORDERS_REGION_SQL + """
SELECT region AS region_part, count(*) AS num_rows, CAST(round(sum(amount), 2) AS DOUBLE) AS amount
FROM o GROUP BY 1""")
def q_layout_list(t):
    return _summary(t, list_layout(t), "region_part", "region_part")


@query("layout_hash", ORDERS_REGION_SQL + f"""
SELECT CAST(('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8))::BIGINT % {HASH_MODULUS} AS INTEGER) AS cust_bucket,
       count(*) AS num_rows, CAST(round(sum(amount), 2) AS DOUBLE) AS amount
FROM o GROUP BY 1""")
def q_layout_hash(t):
    return _summary(t, hash_layout(t), "cust_bucket", "cust_bucket")


@query("layout_unrouted", ORDERS_REGION_SQL + f"""
SELECT 'range:order_month' AS layout, CAST(count_if(NOT ({RANGE_SQL_WHERE})) AS BIGINT) AS unrouted_rows FROM o
UNION ALL
SELECT 'list:region', CAST(count_if(region NOT IN ({", ".join(f"'{v}'" for v in LIST_VALUES)})) AS BIGINT) FROM o""")
def q_layout_unrouted(t):
    bounds = layout.month_bounds(DECLARED_FIRST, DECLARED_LAST)
    o = orders_with_region(t).select(
        layout.range_route("o_orderdate", bounds).alias("r"),
        layout.list_route("region", LIST_VALUES).alias("l"))
    row = o.agg(layout.unrouted_count(o, "r").alias("range:order_month"),
                layout.unrouted_count(o, "l").alias("list:region"))
    return row.unpivot([], ["range:order_month", "list:region"], "layout", "unrouted_rows").select(
        "layout", F.col("unrouted_rows").cast("bigint").alias("unrouted_rows"))


@query("revenue_by_month", ORDERS_REGION_SQL + f"""
SELECT strftime(o_orderdate, '%Y-%m') AS order_month, count(*) AS num_orders,
       CAST(round(sum(amount), 2) AS DOUBLE) AS revenue
FROM o WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '{YEAR_FILTER[0]}' AND '{YEAR_FILTER[1]}' GROUP BY 1""")
def q_revenue_by_month(t):
    """Monthly revenue for one year, read through the month layout (pruned)."""
    df = t.spark.read.parquet(range_layout(t)).filter(F.col("order_month").between(*YEAR_FILTER))
    return gold.revenue_by(df, ["order_month"])


@query("revenue_by_region", ORDERS_REGION_SQL + """
SELECT region AS region_part, count(*) AS num_orders, CAST(round(sum(amount), 2) AS DOUBLE) AS revenue
FROM o GROUP BY 1""")
def q_revenue_by_region(t):
    return gold.revenue_by(t.spark.read.parquet(list_layout(t)), ["region_part"])


@query("revenue_of_region", ORDERS_REGION_SQL + f"""
SELECT region AS region_part, count(*) AS num_orders, CAST(round(sum(amount), 2) AS DOUBLE) AS revenue
FROM o WHERE region = '{LIST_VALUES[0]}' GROUP BY 1""")
def q_revenue_of_region(t):
    """One region, read through the list layout (pruned to its folder)."""
    return gold.revenue_by(t.spark.read.parquet(list_layout(t)).filter(F.col("region_part") == LIST_VALUES[0]), ["region_part"])


def of_customer(df, customer: int):
    """One customer's orders, read through the hash layout: its bucket alone."""
    bucket = F.pmod(F.conv(F.substring(F.md5(F.lit(str(customer)).cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(HASH_MODULUS)).cast("int")
    return df.filter((F.col("cust_bucket") == bucket) & (F.col("o_custkey") == customer))


@query("revenue_of_customer", ORDERS_REGION_SQL + """
SELECT o_custkey, count(*) AS num_orders, CAST(round(sum(amount), 2) AS DOUBLE) AS revenue
FROM o WHERE o_custkey = 7 GROUP BY 1""")
def q_revenue_of_customer(t):
    return gold.revenue_by(of_customer(t.spark.read.parquet(hash_layout(t)), 7), ["o_custkey"])


@query("revenue_by_customer", ORDERS_REGION_SQL + """
SELECT o_custkey, count(*) AS num_orders, CAST(round(sum(amount), 2) AS DOUBLE) AS revenue
FROM o GROUP BY 1""")
def q_revenue_by_customer(t):
    return gold.revenue_by(t.spark.read.parquet(hash_layout(t)), ["o_custkey"])


# --- bucketed tables, dynamic pruning, row-group skipping ---------------------

BUCKETS = 16  # a bucket of a few gigabytes at scale: the count is part of the layout


def bucketed(t, df, name, key):
    """``df`` as a table of the session's catalog, its files in the scratch folder."""
    return layout.write_bucketed(df, f"{name}_{uuid.uuid4().hex[:12]}", scratch_path(t.spark, name), [key], BUCKETS)


def bucketed_orders(t):
    return bucketed(t, t.orders.select("o_orderkey", "o_custkey", money("o_totalprice").alias("amount")), "orders_bucketed", "o_custkey")


def bucketed_customers(t):
    return bucketed(t, t.customer.select("c_custkey", "c_mktsegment"), "customers_bucketed", "c_custkey")


def revenue_by_customer_segment(orders, customers):
    """One row for each customer with orders: join and aggregate on the bucket key."""
    x = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return gold.revenue_by(x.withColumnRenamed("c_mktsegment", "segment"), ["o_custkey", "segment"])


@query("bucketed_join", """
SELECT o_custkey, c_mktsegment AS segment, count(*) AS num_orders, CAST(round(sum(CAST(o_totalprice AS DECIMAL(14,2))), 2) AS DOUBLE) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def q_bucketed_join(t):
    """Orders and customers, both bucketed by customer: no shuffle is left."""
    return revenue_by_customer_segment(bucketed_orders(t), bucketed_customers(t))


@query("bucketed_lookup", """
SELECT o_custkey, count(*) AS num_orders, CAST(round(sum(CAST(o_totalprice AS DECIMAL(14,2))), 2) AS DOUBLE) AS revenue
FROM orders WHERE o_custkey = 7 GROUP BY 1""")
def q_bucketed_lookup(t):
    """One customer, read from its bucket alone."""
    return gold.revenue_by(bucketed_orders(t).filter("o_custkey = 7"), ["o_custkey"])


QUARTER = (1996, (4, 5, 6))


def of_quarter(df, dates):
    """Rows of a month layout in the quarter that the date dimension names: the
    fact's folders are pruned by the months that the dimension's filter leaves."""
    months = dates.filter((F.col("year") == QUARTER[0]) & F.col("month").isin(*QUARTER[1])).select(F.col("year_month").alias("order_month")).distinct()
    return df.join(months, "order_month")


@query("revenue_of_quarter", ORDERS_REGION_SQL + f"""
SELECT strftime(o_orderdate, '%Y-%m') AS order_month, region, count(*) AS num_orders, CAST(round(sum(amount), 2) AS DOUBLE) AS revenue
FROM o WHERE year(o_orderdate) = {QUARTER[0]} AND month(o_orderdate) IN {QUARTER[1]} GROUP BY 1, 2""")
def q_revenue_of_quarter(t):
    df = t.spark.read.parquet(range_layout(t))
    return gold.revenue_by(of_quarter(df, dl.dim_date(t)), ["order_month", "region"])


KEY_SPAN = (1000, 1999)


def ordered_layout(t, row_group_bytes=1 << 20):
    """Months, and inside a month the rows in order of their key."""
    bounds = layout.month_span(t.orders, "o_orderdate")
    df = layout.with_partition(orders_with_region(t), "order_month", layout.range_route("o_orderdate", bounds))
    return layout.write_layout(df, "order_month", scratch_path(t.spark, "orders-ordered"), spread=["o_orderkey"], row_group_bytes=row_group_bytes)


@query("revenue_of_key_span", ORDERS_REGION_SQL + f"""
SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS num_orders, CAST(round(sum(amount), 2) AS DOUBLE) AS revenue
FROM o WHERE o_orderkey BETWEEN {KEY_SPAN[0]} AND {KEY_SPAN[1]} GROUP BY 1""")
def q_revenue_of_key_span(t):
    """A span of order keys: row groups whose keys lie outside are skipped."""
    df = t.spark.read.parquet(ordered_layout(t)).filter(F.col("o_orderkey").between(*KEY_SPAN))
    return gold.revenue_by(df.withColumn("year", F.date_format("o_orderdate", "yyyy")), ["year"])


@query("retain_since", ORDERS_REGION_SQL + f"""
SELECT strftime(o_orderdate, '%Y-%m') AS order_month, count(*) AS num_rows,
       CAST(round(sum(amount), 2) AS DOUBLE) AS amount
FROM o WHERE strftime(o_orderdate, '%Y-%m') >= '{RETAIN_FROM}' GROUP BY 1""")
def q_retain_since(t):
    path = range_layout(t, "orders-retained")
    layout.drop_partitions_before(t.spark, path, "order_month", RETAIN_FROM)
    return _summary(t, path, "order_month", "order_month")
