"""Silver layer: rename, type, derive, quality-filter, enrich with dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.functions.exprs import duration_minutes, duration_minutes_exact, net_amount, year_month
from lakeline.operators.joins import role_copy

def trip_rules() -> dict[str, Column]:
    """Quality rules of the trip lab: each must hold (NULL fails the rule)."""
    return {
        "trip_distance": F.col("trip_distance") >= 0,
        "total_amount": F.col("total_amount") >= 0,
        "trip_duration_min": F.col("trip_duration_min") >= 0,
    }


def order_rules() -> dict[str, Column]:
    """Quality rules of inline orders; a timestamp that does not parse is
    kept (its month is NULL) and shows up in the reject counts only."""
    return {"amount": F.col("amount") >= 0}


def derive_order_columns(raw: DataFrame) -> DataFrame:
    """Parse the text timestamp leniently; add the month and the net amount."""
    typed = raw.withColumn("order_ts", F.expr("try_to_timestamp(order_ts)"))
    return typed.withColumns({"year_month": year_month("order_ts"), "net_amount": net_amount("amount", "is_discounted")})


ORDER_COLUMNS = ["order_id", "order_ts", "year_month", "city", "amount", "net_amount", "is_discounted"]


def silver_orders(raw: DataFrame) -> DataFrame:
    return apply_rules(derive_order_columns(raw), order_rules()).select(*ORDER_COLUMNS)


def derive_trip_columns(raw: DataFrame) -> DataFrame:
    """Rename the source timestamps and add date, month, hour, duration."""
    return raw.withColumnsRenamed({
        "tpep_pickup_datetime": "pickup_ts",
        "tpep_dropoff_datetime": "dropoff_ts",
    }).withColumns({
        "pickup_date": F.to_date("pickup_ts"),
        "pickup_month": year_month("pickup_ts"),
        "pickup_hour": F.hour("pickup_ts"),
        "trip_duration_min": duration_minutes("pickup_ts", "dropoff_ts"),
    })


def apply_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Keep rows passing every rule; stacked filters collapse into one."""
    for cond in rules.values():
        df = df.filter(cond)
    return df


def silver_trips(raw: DataFrame) -> DataFrame:
    return apply_rules(derive_trip_columns(raw), trip_rules())


def quality_rejects(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One pass: rows in, rows kept, rows rejected, and failures per rule.

    A rule fails when its condition is false or NULL, matching what a
    filter drops."""
    passed = None
    aggs = [F.count(F.lit(1)).alias("rows_in")]
    for name, cond in rules.items():
        ok = F.coalesce(cond, F.lit(False))
        passed = ok if passed is None else (passed & ok)
        aggs.append(F.count_if(~ok).alias(f"fail_{name}"))
    aggs.append(F.count_if(passed).alias("rows_kept"))
    out = df.agg(*aggs)
    return out.withColumn("rows_rejected", F.col("rows_in") - F.col("rows_kept"))


ZONE_ROLE = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}


def enrich_zones(trips: DataFrame, zones: DataFrame, how: str = "left") -> DataFrame:
    """Join the zone lookup twice (pickup and drop-off roles).

    The planner broadcasts a lookup under its byte threshold, and the trip
    side is then not shuffled for these joins."""
    z = zones.select(*ZONE_ROLE)
    pu = role_copy(z, "PU", ZONE_ROLE)
    do = role_copy(z, "DO", ZONE_ROLE)
    return (
        trips.join(pu, trips["PULocationID"] == pu["PU_location_id"], how)
        .join(do, trips["DOLocationID"] == do["DO_location_id"], how)
    )


# --- layered SQL-model form (bronze staging -> silver join) -----------------

def bronze_trips(raw: DataFrame) -> DataFrame:
    """Staging model: typed columns and an exact duration in minutes."""
    return raw.select(
        F.col("VendorID").cast("int").alias("vendor_id"),
        F.col("tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_ts"),
        F.col("tpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_ts"),
        F.col("PULocationID").cast("int").alias("pickup_location"),
        F.col("DOLocationID").cast("int").alias("dropoff_location"),
        F.col("passenger_count").cast("int").alias("passengers_count"),
        F.col("tip_amount").cast("decimal(10,2)").alias("tip_amount"),
        F.col("tolls_amount").cast("decimal(10,2)").alias("tolls_amount"),
        F.col("total_amount").cast("decimal(10,2)").alias("total_amount"),
        duration_minutes_exact("tpep_pickup_datetime", "tpep_dropoff_datetime")
        .alias("trip_duration_minutes"),
    )


def bronze_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
    )


def silver_joined(bronze: DataFrame, zones_bronze: DataFrame) -> DataFrame:
    """Inner join to zones twice, keep trips with at least one passenger."""
    z = zones_bronze.select("location_id", "zone_name")
    zp = z.select(F.col("location_id").alias("zp_id"), F.col("zone_name").alias("pickup_location_name"))
    zd = z.select(F.col("location_id").alias("zd_id"), F.col("zone_name").alias("dropoff_location_name"))
    return (
        bronze.join(zp, bronze["pickup_location"] == zp["zp_id"], "inner")
        .join(zd, bronze["dropoff_location"] == zd["zd_id"], "inner")
        .filter(F.coalesce(F.col("passengers_count"), F.lit(0)) >= 1)
        .select(bronze["*"], "pickup_location_name", "dropoff_location_name")
    )
