"""Shared DuckDB SQL fragments for the oracle forms (mirrors plans/views.py)."""

RAW_TRIPS = """
raw_trips AS (
  SELECT l.l_orderkey AS trip_order, l.l_linenumber AS trip_line, l.l_suppkey AS "VendorID",
         o.o_orderdate AS tpep_pickup_datetime, l.l_shipdate AS tpep_dropoff_datetime,
         CAST(l.l_linenumber - 1 AS BIGINT) AS passenger_count,
         l.l_quantity AS trip_distance,
         CAST(s.s_nationkey AS BIGINT) AS "PULocationID",
         CAST(c.c_nationkey AS BIGINT) AS "DOLocationID",
         CAST(l.l_extendedprice AS DECIMAL(14,2)) AS fare_amount,
         CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * CAST(l.l_tax AS DECIMAL(5,4)) AS DECIMAL(20,6)) AS tip_amount,
         CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l.l_discount AS DECIMAL(5,4))) AS DECIMAL(20,6)) AS total_amount,
         CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * CAST(l.l_discount AS DECIMAL(5,4)) AS DECIMAL(20,6)) AS tolls_amount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN customer c ON o.o_custkey = c.c_custkey
)"""

ZONES = """
zones AS (
  SELECT n.n_nationkey AS "LocationID", r.r_name AS "Borough", n.n_name AS "Zone", 'Zone' AS service_zone
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

SILVER_TRIPS = """
silver_trips AS (
  SELECT * FROM (
    SELECT trip_order, trip_line, "VendorID",
           tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
           passenger_count, trip_distance, "PULocationID", "DOLocationID",
           fare_amount, tip_amount, tolls_amount, total_amount,
           CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
           strftime(tpep_pickup_datetime, '%Y-%m') AS pickup_month,
           hour(tpep_pickup_datetime) AS pickup_hour,
           (epoch_us(tpep_dropoff_datetime) // 1000000 - epoch_us(tpep_pickup_datetime) // 1000000) / 60.0
             AS trip_duration_min
    FROM raw_trips) t
  WHERE trip_distance >= 0 AND total_amount >= 0 AND trip_duration_min >= 0
)"""

ENRICHED = """
enriched AS (
  SELECT t.*, zp."LocationID" AS "PU_location_id", zp."Borough" AS "PU_borough", zp."Zone" AS "PU_zone",
         zd."LocationID" AS "DO_location_id", zd."Borough" AS "DO_borough", zd."Zone" AS "DO_zone"
  FROM silver_trips t
  LEFT JOIN zones zp ON t."PULocationID" = zp."LocationID"
  LEFT JOIN zones zd ON t."DOLocationID" = zd."LocationID"
)"""

BRONZE = """
bronze_trips AS (
  SELECT CAST("VendorID" AS INTEGER) AS vendor_id,
         CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_ts,
         CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_ts,
         CAST("PULocationID" AS INTEGER) AS pickup_location,
         CAST("DOLocationID" AS INTEGER) AS dropoff_location,
         CAST(passenger_count AS INTEGER) AS passengers_count,
         CAST(tip_amount AS DECIMAL(10,2)) AS tip_amount,
         CAST(tolls_amount AS DECIMAL(10,2)) AS tolls_amount,
         CAST(total_amount AS DECIMAL(10,2)) AS total_amount,
         (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 60000000.0 AS trip_duration_minutes
  FROM raw_trips
),
bronze_zones AS (
  SELECT CAST("LocationID" AS INTEGER) AS location_id, "Borough" AS borough, "Zone" AS zone_name, service_zone
  FROM zones
),
silver_joined AS (
  SELECT trips.*, zp.zone_name AS pickup_location_name, zd.zone_name AS dropoff_location_name
  FROM bronze_trips trips
  JOIN bronze_zones zp ON trips.pickup_location = zp.location_id
  JOIN bronze_zones zd ON trips.dropoff_location = zd.location_id
  WHERE coalesce(trips.passengers_count, 0) >= 1
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


TRIPS_CTE = with_(RAW_TRIPS, ZONES, SILVER_TRIPS, ENRICHED)
BRONZE_CTE = with_(RAW_TRIPS, ZONES, BRONZE)
