"""Silver and gold reports as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.functions import fixed

from lakeline.functions.exprs import duration_minutes, duration_minutes_exact, money
from lakeline.operators import gold, silver
from lakeline.plans import views
from lakeline.plans.registry import query
from lakeline.plans.sqlparts import BRONZE_CTE, TRIPS_CTE, with_, RAW_TRIPS, ZONES
from lakeline.plans.tables import Tables


def silver_trips(t: Tables) -> DataFrame:
    return silver.silver_trips(views.raw_trips(t))


def enriched(t: Tables) -> DataFrame:
    return silver.enrich_zones(silver_trips(t), views.zones(t), "left")


def joined(t: Tables) -> DataFrame:
    return silver.silver_joined(silver.bronze_trips(views.raw_trips(t)),
                                silver.bronze_zones(views.zones(t)))


def _money_as_double(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query("revenue_by_zone_month", TRIPS_CTE + """
SELECT pickup_month, "PU_zone", count(*) AS num_trips,
       CAST(round(sum(total_amount), 2) AS DOUBLE) AS total_revenue,
       CAST(round(sum(fare_amount), 2) AS DOUBLE) AS total_fare,
       CAST(round(sum(tip_amount), 2) AS DOUBLE) AS total_tip,
       round(CAST(sum(tip_amount) AS DOUBLE) / nullif(CAST(sum(fare_amount) AS DOUBLE), 0), 8) AS tip_pct
FROM enriched GROUP BY pickup_month, "PU_zone"
""")
def q_revenue_by_zone_month(t):
    return gold.revenue_by_zone_month(enriched(t))


@query("trips_by_zone_month", TRIPS_CTE + """
SELECT pickup_month, "PU_zone", count(*) AS num_trips, avg(trip_distance) AS avg_trip_distance
FROM enriched GROUP BY pickup_month, "PU_zone"
""")
def q_trips_by_zone_month(t):
    return gold.trips_by_zone_month(enriched(t))


@query("silver_trips", TRIPS_CTE + """
SELECT trip_order, trip_line, "VendorID", pickup_ts, dropoff_ts, passenger_count, trip_distance,
       "PULocationID", "DOLocationID", CAST(fare_amount AS DOUBLE) AS fare_amount,
       CAST(tip_amount AS DOUBLE) AS tip_amount, CAST(tolls_amount AS DOUBLE) AS tolls_amount,
       CAST(total_amount AS DOUBLE) AS total_amount,
       pickup_date, pickup_month, pickup_hour, trip_duration_min
FROM silver_trips
""")
def q_silver_trips(t):
    return _money_as_double(silver_trips(t), ["fare_amount", "tip_amount", "tolls_amount", "total_amount"])


@query("enrich_left", TRIPS_CTE + """
SELECT trip_order, trip_line, "PULocationID", "DOLocationID", "PU_location_id", "PU_borough", "PU_zone",
       "DO_location_id", "DO_borough", "DO_zone"
FROM enriched
""")
def q_enrich_left(t):
    return enriched(t).select(
        "trip_order", "trip_line", "PULocationID", "DOLocationID", "PU_location_id", "PU_borough",
        "PU_zone", "DO_location_id", "DO_borough", "DO_zone")


@query("quality_rejects", with_(RAW_TRIPS) + """
SELECT count(*) AS rows_in,
       count_if(NOT coalesce(trip_distance >= 0, false)) AS fail_trip_distance,
       count_if(NOT coalesce(total_amount >= 0, false)) AS fail_total_amount,
       count_if(NOT coalesce(d >= 0, false)) AS fail_trip_duration_min,
       count_if(coalesce(trip_distance >= 0, false) AND coalesce(total_amount >= 0, false)
                AND coalesce(d >= 0, false)) AS rows_kept,
       count(*) - count_if(coalesce(trip_distance >= 0, false) AND coalesce(total_amount >= 0, false)
                AND coalesce(d >= 0, false)) AS rows_rejected
FROM (SELECT *, (epoch_us(tpep_dropoff_datetime) // 1000000 - epoch_us(tpep_pickup_datetime) // 1000000) / 60.0 AS d
      FROM raw_trips)
""")
def q_quality_rejects(t):
    return silver.quality_rejects(silver.derive_trip_columns(views.raw_trips(t)), silver.trip_rules())


@query("trips_per_day", TRIPS_CTE + """
SELECT pickup_date, count(*) AS num_trips FROM silver_trips GROUP BY pickup_date
""")
def q_trips_per_day(t):
    return gold.count_by(silver_trips(t), ["pickup_date"])


@query("events_per_day", """
SELECT CAST(ts AS DATE) AS event_date, count(*) AS num_events FROM events GROUP BY 1
""")
def q_events_per_day(t):
    return gold.count_by(t.events.select(F.to_date("ts").alias("event_date")), ["event_date"], "num_events")


@query("trips_per_hour", """
SELECT hour(ts) AS event_hour, count(*) AS num_events FROM events GROUP BY 1
""")
def q_trips_per_hour(t):
    return gold.count_by(t.events.select(F.hour("ts").alias("event_hour")), ["event_hour"], "num_events")


@query("trip_duration", with_(RAW_TRIPS) + """
SELECT trip_order, trip_line,
       (epoch_us(tpep_dropoff_datetime) // 1000000 - epoch_us(tpep_pickup_datetime) // 1000000) / 60.0
         AS trip_duration_min,
       (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 60000000.0 AS trip_duration_exact
FROM raw_trips
""")
def q_trip_duration(t):
    return views.raw_trips(t).select(
        "trip_order", "trip_line",
        duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("trip_duration_min"),
        duration_minutes_exact("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("trip_duration_exact"),
    )


@query("event_gaps", """
SELECT event_id,
       (epoch_us(ts) // 1000000 - epoch_us(TIMESTAMP '2024-01-01 00:00:00') // 1000000) / 60.0 AS minutes_whole,
       (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 60000000.0 AS minutes_exact
FROM events
""")
def q_event_gaps(t):
    """Duration forms on sub-second timestamps: whole seconds cut fractions."""
    e = t.events.select("event_id", "ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("t0"))
    return e.select(
        "event_id",
        duration_minutes("t0", "ts").alias("minutes_whole"),
        duration_minutes_exact("t0", "ts").alias("minutes_exact"),
    )


@query("bronze_trips", BRONZE_CTE + """
SELECT vendor_id, pickup_ts, dropoff_ts, pickup_location, dropoff_location, passengers_count,
       CAST(tip_amount AS DOUBLE) AS tip_amount, CAST(tolls_amount AS DOUBLE) AS tolls_amount,
       CAST(total_amount AS DOUBLE) AS total_amount,
       trip_duration_minutes
FROM bronze_trips
""")
def q_bronze_trips(t):
    return _money_as_double(silver.bronze_trips(views.raw_trips(t)), ["tip_amount", "tolls_amount", "total_amount"])


@query("silver_joined", BRONZE_CTE + """
SELECT vendor_id, pickup_ts, dropoff_ts, pickup_location, dropoff_location, passengers_count,
       CAST(tip_amount AS DOUBLE) AS tip_amount, CAST(tolls_amount AS DOUBLE) AS tolls_amount,
       CAST(total_amount AS DOUBLE) AS total_amount,
       trip_duration_minutes, pickup_location_name, dropoff_location_name
FROM silver_joined
""")
def q_silver_joined(t):
    return _money_as_double(joined(t), ["tip_amount", "tolls_amount", "total_amount"])


@query("daily_zone_fact", BRONZE_CTE + """
SELECT CAST(date_trunc('day', pickup_ts) AS DATE) AS pickup_date, pickup_location, pickup_location_name,
       count(*) AS trips, round(avg(trip_duration_minutes), 6) AS avg_trip_duration_minutes,
       CAST(round(sum(total_amount), 2) AS DOUBLE) AS total_amount
FROM silver_joined GROUP BY 1, 2, 3
""")
def q_daily_zone_fact(t):
    return gold.daily_zone_fact(joined(t))


@query("revenue_by_month_top10", TRIPS_CTE + """
SELECT pickup_month, count(*) AS num_trips, CAST(round(sum(total_amount), 2) AS DOUBLE) AS total_revenue
FROM silver_trips GROUP BY pickup_month ORDER BY pickup_month, total_revenue DESC LIMIT 10
""")
def q_revenue_by_month_top10(t):
    return gold.revenue_by_month_top(silver_trips(t), fixed.TOP_N)


# --- inline-orders shape over orders ---------------------------------------

def inline_orders(t: Tables) -> DataFrame:
    """The five-column inline-orders shape, built from orders ⨝ customer ⨝ nation.

    order_ts arrives as text so the silver step really parses it."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    return (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_ts"),
            F.col("n_name").alias("city"),
            money("o_totalprice").alias("amount"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0).alias("is_discounted"),
        )
    )


INLINE_ORDERS_SQL = """
WITH inline_orders AS (
  SELECT o.o_orderkey AS order_id, strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_ts, n.n_name AS city,
         CAST(o.o_totalprice AS DECIMAL(14,2)) AS amount,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_discounted
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
silver AS (
  SELECT order_id, CAST(order_ts AS TIMESTAMP) AS order_ts, strftime(CAST(order_ts AS TIMESTAMP), '%Y-%m') AS year_month,
         city, amount, CASE WHEN is_discounted = 1 THEN amount * 0.9 ELSE amount END AS net_amount, is_discounted
  FROM inline_orders WHERE amount >= 0
)
"""


@query("net_amount", INLINE_ORDERS_SQL + """
SELECT order_id, order_ts, year_month, city, CAST(amount AS DOUBLE) AS amount,
       CAST(net_amount AS DOUBLE) AS net_amount, is_discounted FROM silver
""")
def q_net_amount(t):
    return _money_as_double(silver.silver_orders(inline_orders(t)), ["amount", "net_amount"])


@query("orders_by_city_month", INLINE_ORDERS_SQL + """
SELECT year_month, city, count(*) AS num_orders, CAST(round(sum(net_amount), 2) AS DOUBLE) AS net_revenue,
       CAST(sum(net_amount) AS DOUBLE) / count(*) AS avg_ticket
FROM silver GROUP BY year_month, city
""")
def q_orders_by_city_month(t):
    return gold.orders_by_city_month(silver.silver_orders(inline_orders(t)))


@query("scan_parquet", "SELECT count(*) AS n_rows FROM lineitem")
def q_scan_parquet(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_rows"))


__all__ = ["silver_trips", "enriched", "joined", "inline_orders", "ZONES"]


def query_sql(name: str) -> str:
    from lakeline.plans.registry import REGISTRY
    return REGISTRY[name].sql


@query("daily_zone_fact_sql", BRONZE_CTE + """
SELECT CAST(date_trunc('day', pickup_ts) AS DATE) AS pickup_date, pickup_location, pickup_location_name,
       count(*) AS trips, round(avg(trip_duration_minutes), 6) AS avg_trip_duration_minutes,
       CAST(round(sum(total_amount), 2) AS DOUBLE) AS total_amount
FROM silver_joined GROUP BY 1, 2, 3
""")
def q_daily_zone_fact_sql(t):
    """The gold model in its SQL form: a CTE over the silver view and
    positional grouping, planned by Catalyst like the DataFrame form."""
    joined(t).createOrReplaceTempView("lakeline_silver_joined")
    return t.spark.sql("""
        WITH base AS (
          SELECT CAST(date_trunc('DAY', pickup_ts) AS DATE) AS pickup_date, pickup_location, pickup_location_name,
                 count(*) AS trips, round(avg(trip_duration_minutes), 6) AS avg_trip_duration_minutes,
                 CAST(round(sum(total_amount), 2) AS DOUBLE) AS total_amount
          FROM lakeline_silver_joined
          GROUP BY 1, 2, 3)
        SELECT * FROM base""")
