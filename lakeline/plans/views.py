"""Trip-shaped and zone-shaped views over the test tables.

The trip layers expect trip records and a zone lookup; the test tables are
TPC-H shaped.  These views give the trip and zone column names the layers
expect (mapping in SURVEY §7.3):

    pickup ts  = o_orderdate          drop-off ts   = l_shipdate
    distance   = l_quantity           fare          = l_extendedprice
    tip        = fare * l_tax         total         = fare * (1 - l_discount)
    tolls      = fare * l_discount
    pickup loc = supplier nation      drop-off loc  = customer nation
    passengers = l_linenumber - 1

Zones are nations: LocationID = n_nationkey, Zone = n_name,
Borough = region name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.functions.exprs import AMOUNT, money, rate
from lakeline.plans.tables import Tables


def raw_trips(t: Tables) -> DataFrame:
    """Trip records as they would land from the source (raw layer).

    lineitem ⨝ orders is a big-big equi-join (sort-merge on the order key);
    supplier and customer are joined on their keys and left to the planner,
    since both grow with the data."""
    li = t.lineitem.select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    fare = money("l_extendedprice")
    return (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(c, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("l_orderkey").alias("trip_order"),
            F.col("l_linenumber").alias("trip_line"),
            F.col("l_suppkey").alias("VendorID"),
            F.col("o_orderdate").alias("tpep_pickup_datetime"),
            F.col("l_shipdate").alias("tpep_dropoff_datetime"),
            (F.col("l_linenumber") - 1).cast("bigint").alias("passenger_count"),
            F.col("l_quantity").alias("trip_distance"),
            F.col("s_nationkey").cast("bigint").alias("PULocationID"),
            F.col("c_nationkey").cast("bigint").alias("DOLocationID"),
            fare.alias("fare_amount"),
            (fare * rate("l_tax")).cast(AMOUNT).alias("tip_amount"),
            (fare * rate("l_discount")).cast(AMOUNT).alias("tolls_amount"),
            (fare * (F.lit(1) - rate("l_discount"))).cast(AMOUNT).alias("total_amount"),
        )
    )


def zones(t: Tables) -> DataFrame:
    """Zone lookup: nation ⨝ region (both fixed-size TPC-H tables)."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("Zone").alias("service_zone"),
    )
