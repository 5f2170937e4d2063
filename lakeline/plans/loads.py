"""Load-side queries: scans, sinks, windows, envelopes, reconciliation (A1-A16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeline.functions import fixed
from pyspark.sql import types as T

from lakeline.operators import gold, merge
from lakeline.plans import reports
from lakeline.plans.registry import query
from lakeline.session import scratch_path
from lakeline.sources import files, jdbc, records

# Fixed values of ours: the extract window and month used by the load queries.
WEEK = ("2024-01-08 00:00:00", "2024-01-15 00:00:00")
MONTH = (1996, 3)
CAP_ROWS = fixed.LOAD_CHUNKS * fixed.LOAD_CHUNK_ROWS

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])


@query("scan_csv", "SELECT * FROM customer")
def q_scan_csv(t):
    """Customer written as CSV with a header, read back with inferred types."""
    path = files.write_csv(t.customer, scratch_path(t.spark, "customer-csv"))
    df = files.read_csv(t.spark, path, infer=True)
    return df.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                     F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_acctbal", "c_mktsegment")


@query("scan_csv_typed", "SELECT * FROM customer")
def q_scan_csv_typed(t):
    path = files.write_csv(t.customer, scratch_path(t.spark, "customer-csv"))
    return files.read_csv(t.spark, path, schema=CUSTOMER_SCHEMA)


@query("roundtrip_csv", "SELECT * FROM orders")
def q_roundtrip_csv(t):
    path = files.write_csv(t.orders, scratch_path(t.spark, "orders-csv"))
    return files.read_csv(t.spark, path, schema=ORDERS_SCHEMA)


@query("roundtrip_parquet", "SELECT * FROM lineitem")
def q_roundtrip_parquet(t):
    path = files.write_parquet(t.lineitem, scratch_path(t.spark, "lineitem"))
    return t.spark.read.parquet(path)


@query("roundtrip_partitioned", """
SELECT pickup_month, "PU_zone", num_trips, total_revenue, total_fare, total_tip, tip_pct FROM (
""" + reports.query_sql("revenue_by_zone_month") + ")")
def q_roundtrip_partitioned(t):
    """The flagship gold table written partitioned by month and read back."""
    gold_df = gold.revenue_by_zone_month(reports.enriched(t))
    path = files.write_parquet(gold_df, scratch_path(t.spark, "gold-months"), ["pickup_month"])
    return t.spark.read.parquet(path).select("pickup_month", "PU_zone", "num_trips", "total_revenue",
                                             "total_fare", "total_tip", "tip_pct")


@query("scan_month", f"""
SELECT * FROM orders
WHERE o_orderdate >= TIMESTAMP '{MONTH[0]}-{MONTH[1]:02d}-01'
  AND o_orderdate < TIMESTAMP '{MONTH[0]}-{MONTH[1]:02d}-01' + INTERVAL 1 MONTH""")
def q_scan_month(t):
    """Orders laid out one folder per month; one month read back with pruning."""
    base = files.write_monthly(t.orders, "o_orderdate", scratch_path(t.spark, "orders-monthly"))
    return files.read_month(t.spark, base, *MONTH)


@query("extract_window", f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{WEEK[0]}' AND ts < TIMESTAMP '{WEEK[1]}'""")
def q_extract_window(t):
    return files.extract_window(t.events, "ts", *WEEK)


@query("raw_envelope", f"""
SELECT CAST(event_id AS VARCHAR) AS id, TIMESTAMP '{WEEK[0]}' AS extract_window_start_utc,
       TIMESTAMP '{WEEK[1]}' AS extract_window_end_utc,
       event_id, ts, user_id, event_type, value, props
FROM events WHERE ts >= TIMESTAMP '{WEEK[0]}' AND ts < TIMESTAMP '{WEEK[1]}'""")
def q_raw_envelope(t):
    """Envelope of one extract window; payload fields parsed back to check it."""
    env = merge.envelope(files.extract_window(t.events, "ts", *WEEK), "event_id", *WEEK)
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    parsed = env.withColumn("p", F.from_json("payload", schema, merge.JSON_OPTIONS))
    return parsed.select("id", "extract_window_start_utc", "extract_window_end_utc", "p.*")


@query("load_reconcile", """
SELECT (SELECT count(*) FROM lineitem) AS source_rows, (SELECT count(*) FROM lineitem) AS target_rows,
       CAST(0 AS BIGINT) AS diff""")
def q_load_reconcile(t):
    """Load lineitem into a Parquet target, then count source against target."""
    path = files.write_parquet(t.lineitem, scratch_path(t.spark, "lineitem-load"))
    return jdbc.reconcile(t.lineitem, t.spark.read.parquet(path))


@query("load_capped", f"SELECT * FROM orders ORDER BY o_orderkey LIMIT {CAP_ROWS}")
def q_load_capped(t):
    return files.capped(t.orders, ["o_orderkey"], CAP_ROWS)


# --- batched and replacing loads into a file table ---------------------------

LOAD_BATCHES = 4


def _batch():
    return F.pmod(F.xxhash64("o_orderkey"), F.lit(LOAD_BATCHES)).cast("int")


@query("load_append_batches", "SELECT count(*) AS source_rows, count(*) AS target_rows, CAST(0 AS BIGINT) AS diff FROM orders")
def q_load_append_batches(t):
    """Orders appended in batches with one scan; the last batch is loaded again,
    as a retry would, takes its own place and counts once."""
    target = scratch_path(t.spark, "orders-append")
    for rows in (t.orders, t.orders.filter(_batch() == LOAD_BATCHES - 1)):
        files.append_batches(rows, _batch(), target)
    return jdbc.reconcile(t.orders, t.spark.read.parquet(target))


@query("load_source_batches", "SELECT * FROM orders")
def q_load_source_batches(t):
    """Orders loaded batch by batch through the record store's data source, the
    last batch twice; all rows read back through it."""
    records.register(t.spark)
    path = scratch_path(t.spark, "orders-records")
    for k in [*range(LOAD_BATCHES), LOAD_BATCHES - 1]:
        records.append(t.orders.filter(_batch() == k), path, f"batch-{k}")
    return records.read(t.spark, path, t.orders.schema)


@query("extract_source_window", f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{WEEK[0]}' AND ts < TIMESTAMP '{WEEK[1]}'""")
def q_extract_source_window(t):
    """One extract window read from the record store: its bounds are pushed to
    the source, which plans the parts that can hold them."""
    records.register(t.spark)
    path = scratch_path(t.spark, "event-records")
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    records.append(t.events.repartitionByRange(n, "ts"), path, "all")
    return files.extract_window(records.read(t.spark, path, t.events.schema), "ts", *WEEK)


@query("load_replace", "SELECT * FROM orders")
def q_load_replace(t):
    """An empty table of the source's schema, replaced by a full load twice:
    the second run gives the same table."""
    target = scratch_path(t.spark, "orders-replace")
    t.orders.limit(0).write.parquet(target)
    for _ in range(2):
        t.orders.write.mode("overwrite").parquet(target)
    return t.spark.read.parquet(target)


# --- streaming ingest -----------------------------------------------------

from lakeline.streaming import ingest  # noqa: E402

EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
                "props string")


@query("stream_ingest", """
SELECT CAST(event_id AS VARCHAR) AS id, ts, user_id, event_type, value, props FROM events""")
def q_stream_ingest(t):
    """Events landed as weekly files, ingested by a file stream, one file per
    micro-batch, each appended to the raw table and resolved by id."""
    spark = t.spark
    landing = scratch_path(spark, "landing")
    ingest.land_in_chunks(t.events, "ts", landing, ingest.week_bounds(t.events, "ts"))
    target = scratch_path(spark, "raw-stream")
    ingest.upsert_stream(spark, landing, EVENT_SCHEMA, "event_id", "ts", target,
                         scratch_path(spark, "stream-ckpt"), files_per_batch=1)
    env = merge.read_newest(spark, target, ["id"])
    parsed = env.withColumn("p", F.from_json("payload", EVENT_SCHEMA, merge.JSON_OPTIONS))
    return parsed.select("id", "p.ts", "p.user_id", "p.event_type", "p.value", "p.props")
