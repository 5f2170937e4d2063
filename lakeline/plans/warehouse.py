"""Warehouse queries: dimensions, allocation, fact, star questions (K, C10-C12, C16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeline.functions import fixed

from lakeline.plans import delivery as dl
from lakeline.plans.registry import query

CUISINE_SQL = "[" + ", ".join(f"'{c}'" for c in dl.CUISINES) + "]"


def _c(col: str) -> str:
    return f"CAST(CAST({col} AS DECIMAL(14,2)) * 100 AS BIGINT)"


def _from_cents(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(20,0)) / 100 AS DECIMAL(14,2))"


_ALLOC = ",\n".join(
    f"""CASE WHEN t.w_total = 0 THEN (2 * {_c('p.' + a)} + t.n_lines) // (2 * t.n_lines)
        ELSE (2 * {_c('p.' + a)} * {_c('i.gross_item_amount')} + {_c('t.w_total')}) // (2 * {_c('t.w_total')}) END AS s_{a}"""
    for a in ("discount_amount", "delivery_fee", "tip_amount"))

_ALLOC_OUT = ",\n".join(
    f"""{_from_cents(f"s_{a} + CASE WHEN line_number = last_line THEN {_c(a)} - t_{a} ELSE 0 END")} AS allocated_{a}"""
    for a in ("discount_amount", "delivery_fee", "tip_amount"))

DELIVERY_SQL = f"""
WITH last_ship AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey),
raw_orders AS (
  SELECT o.o_orderkey AS order_id, o.o_orderdate AS order_ts, o.o_custkey AS customer_id,
         o.o_custkey % {dl.COURIERS} AS courier_id, CAST(c.c_nationkey AS BIGINT) AS city_id,
         CASE WHEN o.o_orderstatus = 'F' THEN 'delivered' WHEN o.o_orderstatus = 'O' THEN 'open' ELSE 'pending' END AS status,
         CASE WHEN o.o_orderstatus = 'F' THEN ls.last_ship END AS delivered_ts
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN last_ship ls ON o.o_orderkey = ls.l_orderkey),
raw_items AS (
  SELECT l.l_orderkey AS order_id,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_partkey, l.l_suppkey, l.l_extendedprice) AS INTEGER) AS line_number,
         l.l_partkey AS product_id, l.l_suppkey AS restaurant_id, CAST(l.l_quantity AS INTEGER) AS qty,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS unit_price
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
raw_promotions AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'P' || CAST(o_orderkey % 20 AS VARCHAR) END AS promo_code
  FROM orders),
raw_payments AS (
  SELECT o_orderkey AS order_id, o_orderpriority AS payment_method,
         CAST(o_totalprice AS DECIMAL(14,2)) AS subtotal,
         {_from_cents(f"({_c('o_totalprice')} * 1 + 50) // 100")} AS delivery_fee,
         {_from_cents(f"({_c('o_totalprice')} * 5 + 50) // 100")} AS tip_amount,
         CASE WHEN o_orderkey % 3 <> 0 THEN {_from_cents(f"({_c('o_totalprice')} * 10 + 50) // 100")}
              ELSE CAST(0 AS DECIMAL(14,2)) END AS discount_amount
  FROM orders),
items AS (SELECT *, CAST(qty * unit_price AS DECIMAL(14,2)) AS gross_item_amount FROM raw_items),
tot AS (SELECT order_id, sum(gross_item_amount) AS w_total, count(*) AS n_lines, max(line_number) AS last_line
        FROM items GROUP BY order_id),
sh AS (
  SELECT i.*, t.last_line, p.discount_amount, p.delivery_fee, p.tip_amount,
  {_ALLOC}
  FROM items i JOIN tot t ON i.order_id = t.order_id JOIN raw_payments p ON i.order_id = p.order_id),
sums AS (SELECT order_id, sum(s_discount_amount) AS t_discount_amount, sum(s_delivery_fee) AS t_delivery_fee,
                sum(s_tip_amount) AS t_tip_amount FROM sh GROUP BY order_id),
alloc AS (
  SELECT sh.order_id, line_number, product_id, restaurant_id, qty, unit_price, gross_item_amount,
  {_ALLOC_OUT}
  FROM sh JOIN sums ON sh.order_id = sums.order_id),
dim_city AS (
  SELECT CAST(row_number() OVER (ORDER BY city_id) AS INTEGER) AS city_key, *
  FROM (SELECT CAST(n.n_nationkey AS BIGINT) AS city_id, n.n_name AS city_name, r.r_name AS region, n.n_name AS country
        FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)),
dim_customer AS (
  SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS customer_key, c_custkey AS customer_id,
         c_mktsegment AS segment FROM customer),
dim_restaurant AS (
  SELECT CAST(row_number() OVER (ORDER BY s_suppkey) AS INTEGER) AS restaurant_key, s_suppkey AS restaurant_id,
         s_name AS restaurant_name, {CUISINE_SQL}[CAST(s_suppkey % {len(dl.CUISINES)} AS INTEGER) + 1] AS cuisine
  FROM supplier),
dim_product AS (
  SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS INTEGER) AS product_key, p_partkey AS product_id,
         p_name AS product_name, p_type AS category FROM part),
dim_payment_method AS (
  SELECT CAST(row_number() OVER (ORDER BY payment_method) AS INTEGER) AS payment_method_key, payment_method
  FROM (SELECT DISTINCT payment_method FROM raw_payments WHERE payment_method IS NOT NULL)),
dim_promotion AS (
  SELECT CAST(row_number() OVER (ORDER BY promo_code) AS INTEGER) AS promotion_key, promo_code
  FROM (SELECT DISTINCT coalesce(promo_code, '{dl.PROMO_MEMBER}') AS promo_code FROM raw_promotions)),
span AS (SELECT min(d) AS lo, max(d) AS hi FROM (
  SELECT CAST(order_ts AS DATE) AS d FROM raw_orders UNION ALL
  SELECT CAST(delivered_ts AS DATE) FROM raw_orders WHERE delivered_ts IS NOT NULL)),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, year(d) AS year, month(d) AS month,
         strftime(d, '%Y-%m') AS year_month
  FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM span)),
fact AS (
  SELECT a.order_id, a.line_number,
         CAST(strftime(o.order_ts, '%Y%m%d') AS INTEGER) AS order_date_key,
         CAST(strftime(o.delivered_ts, '%Y%m%d') AS INTEGER) AS delivered_date_key,
         dc.city_key, cu.customer_key, dr.restaurant_key, o.courier_id, dp.product_key,
         pm.payment_method_key, pr.promotion_key, o.status, a.qty, a.unit_price, a.gross_item_amount,
         a.allocated_discount_amount, a.allocated_delivery_fee, a.allocated_tip_amount,
         CAST(a.gross_item_amount - a.allocated_discount_amount AS DECIMAL(14,2)) AS net_revenue,
         CAST(trunc((epoch_us(o.delivered_ts) // 1000000 - epoch_us(o.order_ts) // 1000000) / 60.0) AS INTEGER) AS dispatch_minutes
  FROM alloc a
  JOIN raw_orders o ON a.order_id = o.order_id
  JOIN raw_payments p ON a.order_id = p.order_id
  JOIN raw_promotions q ON a.order_id = q.order_id
  JOIN dim_city dc ON o.city_id = dc.city_id
  JOIN dim_payment_method pm ON p.payment_method = pm.payment_method
  JOIN dim_promotion pr ON coalesce(q.promo_code, '{dl.PROMO_MEMBER}') = pr.promo_code
  JOIN dim_customer cu ON o.customer_id = cu.customer_id
  JOIN dim_restaurant dr ON a.restaurant_id = dr.restaurant_id
  JOIN dim_product dp ON a.product_id = dp.product_id)
"""

FACT_COLS = ("order_id, line_number, order_date_key, delivered_date_key, city_key, customer_key, restaurant_key, "
             "courier_id, product_key, payment_method_key, promotion_key, status, qty, "
             "CAST(unit_price AS DOUBLE) AS unit_price, CAST(gross_item_amount AS DOUBLE) AS gross_item_amount, "
             "CAST(allocated_discount_amount AS DOUBLE) AS allocated_discount_amount, "
             "CAST(allocated_delivery_fee AS DOUBLE) AS allocated_delivery_fee, "
             "CAST(allocated_tip_amount AS DOUBLE) AS allocated_tip_amount, "
             "CAST(net_revenue AS DOUBLE) AS net_revenue, dispatch_minutes")

_MONEY = ["unit_price", "gross_item_amount", "allocated_discount_amount", "allocated_delivery_fee",
          "allocated_tip_amount", "net_revenue"]


def _doubles(df, cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})


@query("dim_date", DELIVERY_SQL + "SELECT * FROM dim_date")
def q_dim_date(t):
    return dl.dim_date(t)


@query("dim_city", DELIVERY_SQL + "SELECT * FROM dim_city")
def q_dim_city(t):
    return dl.dim_city(t)


@query("dim_customer", DELIVERY_SQL + "SELECT * FROM dim_customer")
def q_dim_customer(t):
    return dl.dim_customer(t)


@query("dim_restaurant", DELIVERY_SQL + "SELECT * FROM dim_restaurant")
def q_dim_restaurant(t):
    return dl.dim_restaurant(t)


@query("dim_product", DELIVERY_SQL + "SELECT * FROM dim_product")
def q_dim_product(t):
    return dl.dim_product(t)


@query("dim_payment_method", DELIVERY_SQL + "SELECT * FROM dim_payment_method")
def q_dim_payment_method(t):
    return dl.dim_payment_method(t)


@query("dim_promotion", DELIVERY_SQL + "SELECT * FROM dim_promotion")
def q_dim_promotion(t):
    return dl.dim_promotion(t)


@query("allocate_lines", DELIVERY_SQL + """
SELECT order_id, line_number, CAST(gross_item_amount AS DOUBLE) AS gross_item_amount,
       CAST(allocated_discount_amount AS DOUBLE) AS allocated_discount_amount,
       CAST(allocated_delivery_fee AS DOUBLE) AS allocated_delivery_fee,
       CAST(allocated_tip_amount AS DOUBLE) AS allocated_tip_amount
FROM alloc""")
def q_allocate_lines(t):
    a = dl.allocated_lines(t).select("order_id", "line_number", "gross_item_amount", "allocated_discount_amount",
                                     "allocated_delivery_fee", "allocated_tip_amount")
    return _doubles(a, _MONEY)


@query("star_fact", DELIVERY_SQL + f"SELECT {FACT_COLS} FROM fact")
def q_star_fact(t):
    return _doubles(dl.star_fact(t), _MONEY)


@query("star_q1", DELIVERY_SQL + """
SELECT d.year_month, c.region, r.cuisine, CAST(round(sum(f.net_revenue), 2) AS DOUBLE) AS net_revenue
FROM fact f JOIN dim_date d ON f.order_date_key = d.date_key JOIN dim_city c ON f.city_key = c.city_key
JOIN dim_restaurant r ON f.restaurant_key = r.restaurant_key
GROUP BY d.year_month, c.region, r.cuisine""")
def q_star_q1(t):
    fact, _ = dl.side_by_side(t, dl.star_fact, dl.dim_date)
    return dl.star_q1(fact, t)


@query("star_q2", DELIVERY_SQL + f"""
SELECT p.promo_code, CAST(round(sum(f.net_revenue), 2) AS DOUBLE) AS net_revenue,
       count(DISTINCT f.order_id) AS orders,
       round(count(DISTINCT f.order_id) / (SELECT count(DISTINCT order_id) FROM fact), 8) AS order_share
FROM fact f JOIN dim_promotion p ON f.promotion_key = p.promotion_key
WHERE p.promo_code <> '{dl.PROMO_MEMBER}'
GROUP BY p.promo_code ORDER BY net_revenue DESC, p.promo_code LIMIT 10""")
def q_star_q2(t):
    return dl.star_q2(dl.star_fact(t), t, fixed.TOP_N)


@query("star_q3", DELIVERY_SQL + """
SELECT courier_id, count(*) AS orders, round(avg(dispatch_minutes), 6) AS avg_cycle_minutes
FROM (SELECT DISTINCT order_id, courier_id, dispatch_minutes FROM fact WHERE status = 'delivered')
GROUP BY courier_id""")
def q_star_q3(t):
    return dl.star_q3(t)


# --- upsert and incremental merge (D1, D2) -------------------------------

from lakeline.operators import gold, merge, versions  # noqa: E402
from lakeline.plans import reports  # noqa: E402
from lakeline.plans.sqlparts import BRONZE_CTE  # noqa: E402
from lakeline.session import scratch_path  # noqa: E402

INCR_CUT = "2024-01-16 13:17:00"  # fixed value of ours: the first run's source ends here, in mid-day
RAW_ORDER = ["extract_window_end_utc", "payload"]

# Two extract windows over the data's own span, in eighths of it: they overlap,
# so records in between are loaded twice.  Rows without a time go with the
# last window.
WINDOWS = ((0, 5), (4, 8))
WINDOWS_SQL = f"""
span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) + 1 - epoch_us(min(ts)) AS size FROM events),
edges AS (SELECT make_timestamp(lo + size * {WINDOWS[0][0]} // 8) AS lo1, make_timestamp(lo + size * {WINDOWS[0][1]} // 8) AS hi1,
                 make_timestamp(lo + size * {WINDOWS[1][0]} // 8) AS lo2, make_timestamp(lo + size * {WINDOWS[1][1]} // 8) AS hi2 FROM span)"""


def extract_windows(events, parts=WINDOWS):
    """(name, rows, start, end) of each window over the span of ``ts``."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(micros), F.max(micros) + 1).first()
    if lo is None:
        return
    for a, b in parts:
        start, end = (F.timestamp_micros(F.lit(lo + (hi - lo) * k // 8)).cast("timestamp_ntz") for k in (a, b))
        inside = (F.col("ts") >= start) & (F.col("ts") < end)
        yield f"{a}-{b}", events.filter(inside | F.col("ts").isNull() if b == 8 else inside), start, end


def raw_events(t, parts=WINDOWS, again=(), compact_after=()):
    """The raw table of ``parts`` extract windows, loaded in order, each one
    appended as its own folder and resolved by id at read time.  Windows in
    ``again`` are loaded a second time, as a retry would; after those in
    ``compact_after`` the batches are folded into the base."""
    ev = t.events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    path = scratch_path(t.spark, "raw-table")
    for k, (name, rows, start, end) in enumerate(extract_windows(ev, parts)):
        for _ in range(1 + (k in again)):
            merge.append_batch(path, merge.envelope(rows, "event_id", start, end), name, ["id"], RAW_ORDER, stamp=end)
        if k in compact_after:
            merge.compact(t.spark, path, ["id"])
    return path


def _parsed(raw):
    p = F.col("payload")
    return raw.select(
        "id", "extract_window_start_utc", "extract_window_end_utc", "ingested_at_utc",
        F.get_json_object(p, "$.ts").cast("timestamp_ntz").alias("ts"),
        F.get_json_object(p, "$.user_id").cast("bigint").alias("user_id"),
        F.get_json_object(p, "$.event_type").alias("event_type"),
        F.get_json_object(p, "$.value").cast("double").alias("value"),
        F.get_json_object(p, "$.props").alias("props"),
    )


@query("upsert_raw", f"""
WITH {WINDOWS_SQL}
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN ts < lo2 THEN lo1 ELSE lo2 END AS extract_window_start_utc,
       CASE WHEN ts < lo2 THEN hi1 ELSE hi2 END AS extract_window_end_utc,
       CASE WHEN ts < lo2 THEN hi1 ELSE hi2 END AS ingested_at_utc,
       ts, user_id, event_type, value, props
FROM events, edges""")
def q_upsert_raw(t):
    """Two overlapping extract windows upserted by id."""
    return _parsed(merge.read_newest(t.spark, raw_events(t), ["id"]))


WEEKS = tuple((k, k + 2) for k in range(7))


@query("upsert_compacted", f"""
WITH span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) + 1 - epoch_us(min(ts)) AS size FROM events),
windows AS (SELECT k, make_timestamp(lo + size * k // 8) AS starts, make_timestamp(lo + size * (k + 2) // 8) AS ends
            FROM span, (SELECT unnest(range({len(WEEKS)})) AS k)),
loads AS (SELECT event_id, k, starts, ends FROM events JOIN windows ON (ts >= starts AND ts < ends) OR (ts IS NULL AND k = {len(WEEKS) - 1})),
last AS (SELECT event_id, max(k) AS k FROM loads GROUP BY 1)
SELECT CAST(e.event_id AS VARCHAR) AS id, starts AS extract_window_start_utc, ends AS extract_window_end_utc, ends AS ingested_at_utc,
       ts, user_id, event_type, value, props
FROM events e JOIN last USING (event_id) JOIN windows USING (k)""")
def q_upsert_compacted(t):
    """Seven half-overlapping windows; the batches are folded into a sorted base
    after the third and the sixth, the last one and a folded one are retried."""
    return _parsed(merge.read_newest(t.spark, raw_events(t, WEEKS, again=(2, 6), compact_after=(2, 5)), ["id"]))


def daily_events(src):
    g = src.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("value").cast("decimal(12,2)")).alias("_total"),
        F.max("value").alias("max_value"))
    return g.select("event_date", "event_type", "events",
                    F.round("_total", 2).cast("double").alias("total_value"), "max_value")


DAILY_EVENTS_SQL = """
SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS events,
       CAST(round(sum(CAST(value AS DECIMAL(12,2))), 2) AS DOUBLE) AS total_value, max(value) AS max_value
FROM events GROUP BY 1, 2"""


@query("incremental_daily", DAILY_EVENTS_SQL)
def q_incremental_daily(t):
    """Two incremental runs (source cut mid-day, then complete) = one full build."""
    ev = t.events.select("ts", "event_type", "value")
    first = ev.filter(F.col("ts") < F.lit(INCR_CUT).cast("timestamp_ntz"))
    path = merge.incremental_load(None, first, "ts", "event_date", daily_events, ["event_date", "event_type"])
    path = merge.incremental_load(path, ev, "ts", "event_date", daily_events, ["event_date", "event_type"])
    return versions.read(t.spark, path).select("event_date", "event_type", "events", "total_value", "max_value")


ZONE_CUT = "1998-02-15 00:00:00"  # first run's source ends here, in mid-month


def _zone_fact(trips):
    return gold.daily_zone_fact(trips).withColumn("pickup_month", F.trunc("pickup_date", "month"))


@query("incremental_zone_fact", BRONZE_CTE + """
SELECT CAST(date_trunc('day', pickup_ts) AS DATE) AS pickup_date, pickup_location, pickup_location_name,
       count(*) AS trips, round(avg(trip_duration_minutes), 6) AS avg_trip_duration_minutes,
       CAST(round(sum(total_amount), 2) AS DOUBLE) AS total_amount
FROM silver_joined GROUP BY 1, 2, 3""")
def q_incremental_zone_fact(t):
    """The zone fact in two runs, merged on (pickup_date, pickup_location) into
    month folders: the second builds the days from the last loaded one on."""
    trips, keys = reports.joined(t), ["pickup_date", "pickup_location"]
    first = trips.filter(F.col("pickup_ts") < F.lit(ZONE_CUT).cast("timestamp_ntz"))
    path = merge.incremental_load(None, first, "pickup_ts", "pickup_month", _zone_fact, keys, "pickup_date")
    path = merge.incremental_load(path, trips, "pickup_ts", "pickup_month", _zone_fact, keys, "pickup_date")
    return versions.read(t.spark, path).drop("pickup_month")


# --- data tests (T1-T4) ---------------------------------------------------

from lakeline.operators import checks  # noqa: E402


@query("test_not_null", BRONZE_CTE + """
SELECT 'not_null:pickup_ts' AS test, CAST(count_if(pickup_ts IS NULL) AS BIGINT) AS failures FROM silver_joined
UNION ALL SELECT 'not_null:pickup_location', CAST(count_if(pickup_location IS NULL) AS BIGINT) FROM silver_joined
UNION ALL SELECT 'not_null:passengers_count', CAST(count_if(passengers_count IS NULL) AS BIGINT) FROM silver_joined""")
def q_test_not_null(t):
    return checks.run_tests(reports.joined(t), [
        checks.NotNull("pickup_ts"), checks.NotNull("pickup_location"), checks.NotNull("passengers_count")])


@query("test_accepted_values", BRONZE_CTE + """
SELECT 'accepted_values:passengers_count' AS test,
       CAST(count_if(passengers_count IS NOT NULL AND passengers_count NOT IN (0,1,2,3,4,5,6,7,8)) AS BIGINT) AS failures
FROM silver_joined
UNION ALL
SELECT 'accepted_values:passenger_count_raw', CAST(count_if(passenger_count IS NOT NULL AND passenger_count NOT IN (0,1,2,3,4,5)) AS BIGINT)
FROM raw_trips""")
def q_test_accepted_values(t):
    from lakeline.plans import views
    a = checks.run_tests(reports.joined(t), [checks.AcceptedValues("passengers_count", fixed.ACCEPTED_PASSENGERS)])
    b = checks.run_tests(views.raw_trips(t).withColumnRenamed("passenger_count", "passenger_count_raw"),
                         [checks.AcceptedValues("passenger_count_raw", list(range(6)))])
    return a.unionByName(b)


@query("test_relationships", BRONZE_CTE + """
SELECT 'relationships:pickup_location->location_id' AS test,
       CAST(count(*) AS BIGINT) AS failures
FROM silver_joined s WHERE s.pickup_location IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM bronze_zones z WHERE z.location_id = s.pickup_location)
UNION ALL
SELECT 'relationships:l_partkey->p_partkey', CAST(count(*) AS BIGINT)
FROM lineitem l WHERE l.l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL
SELECT 'relationships:o_orderkey->l_orderkey', CAST(count(*) AS BIGINT)
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def q_test_relationships(t):
    from lakeline.operators.silver import bronze_zones
    from lakeline.plans import views
    zones = bronze_zones(views.zones(t))
    a = checks.run_tests(reports.joined(t), [checks.Relationship("pickup_location", zones, "location_id")])
    b = checks.run_tests(t.lineitem, [checks.Relationship("l_partkey", t.part, "p_partkey")])
    # orders without lines: a reverse relationship that does fail on this data
    c = checks.run_tests(t.orders, [checks.Relationship("o_orderkey", t.lineitem, "l_orderkey")])
    c = c.withColumn("test", F.lit("relationships:o_orderkey->l_orderkey"))
    return a.unionByName(b).unionByName(c)


@query("test_unique", """
SELECT 'unique:l_orderkey,l_linenumber' AS test, CAST(count(*) AS BIGINT) AS failures
FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL
SELECT 'unique:l_orderkey,l_linenumber,l_partkey,l_suppkey,l_extendedprice', CAST(count(*) AS BIGINT)
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice HAVING count(*) > 1)
UNION ALL
SELECT 'unique:event_id', CAST(count(*) AS BIGINT) FROM (SELECT event_id FROM events GROUP BY 1 HAVING count(*) > 1)""")
def q_test_unique(t):
    li = t.lineitem
    return (checks.run_tests(li, [checks.Unique(["l_orderkey", "l_linenumber"]),
                                  checks.Unique(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_extendedprice"])])
            .unionByName(checks.run_tests(t.events, [checks.Unique(["event_id"])])))


# --- tests while writing, quarantine ---------------------------------------

ACCEPTED = list(range(6))  # passenger counts that the load takes
CLOSED = "AFRICA"          # trips from this borough's zones refer to no open zone

CHECKED_SQL = BRONZE_CTE + f""",
judged AS (
  SELECT *, passenger_count IS NOT NULL AND passenger_count NOT IN ({", ".join(map(str, ACCEPTED))}) AS bad_count,
         tpep_pickup_datetime IS NULL AS bad_time,
         "PULocationID" IS NOT NULL AND "PULocationID" NOT IN (SELECT "LocationID" FROM zones WHERE "Borough" <> '{CLOSED}') AS bad_zone
  FROM raw_trips)
"""


def checked_load(t):
    from lakeline.plans import views
    rows = views.raw_trips(t)
    open_zones = views.zones(t).filter(F.col("Borough") != CLOSED)
    path = scratch_path(t.spark, "checked-trips")
    found = checks.write_checked(rows, [checks.NotNull("tpep_pickup_datetime"), checks.AcceptedValues("passenger_count", ACCEPTED),
                                        checks.Relationship("PULocationID", open_zones, "LocationID")], path)
    return found, path, rows.schema


@query("load_checked", CHECKED_SQL + """
SELECT 'rows_in' AS measure, CAST(count(*) AS BIGINT) AS rows FROM judged
UNION ALL SELECT 'rows_kept', count(*) FROM judged WHERE NOT (bad_count OR bad_time OR bad_zone)
UNION ALL SELECT 'rows_quarantined', count(*) FROM judged WHERE bad_count OR bad_time OR bad_zone
UNION ALL SELECT 'not_null:tpep_pickup_datetime', count(*) FROM judged WHERE bad_time
UNION ALL SELECT 'accepted_values:passenger_count', count(*) FROM judged WHERE bad_count
UNION ALL SELECT 'relationships:PULocationID->LocationID', count(*) FROM judged WHERE bad_zone""")
def q_load_checked(t):
    """Trips written and tested in one pass over their source."""
    return checked_load(t)[0]


@query("load_quarantine", CHECKED_SQL + """
SELECT trip_order, passenger_count, "PULocationID", CAST(fare_amount AS DOUBLE) AS fare_amount,
       array_to_string([f for f in [CASE WHEN bad_time THEN 'not_null:tpep_pickup_datetime' END, CASE WHEN bad_count THEN 'accepted_values:passenger_count' END,
                                    CASE WHEN bad_zone THEN 'relationships:PULocationID->LocationID' END] if f IS NOT NULL], ' ') AS failed
FROM judged WHERE bad_count OR bad_time OR bad_zone""")
def q_load_quarantine(t):
    """The rows that the checked load put aside, with the tests they failed."""
    _, path, schema = checked_load(t)
    return checks.quarantined(t.spark, path, schema).select(
        "trip_order", "passenger_count", "PULocationID", F.col("fare_amount").cast("double").alias("fare_amount"), F.array_join("failed", " ").alias("failed"))


CONTRACT = "trip_order bigint, tpep_pickup_datetime timestamp_ntz, passenger_count bigint, fare_amount decimal(14,2), total_amount decimal(20,6), zone_name string"


@query("test_contract", """
SELECT 'missing zone_name' AS problem, CAST(count(*) AS BIGINT) AS rows FROM lineitem
UNION ALL SELECT 'type fare_amount: double != decimal(14,2)', count(*) FROM lineitem""")
def q_test_contract(t):
    """The trips' schema against a contract that it breaks twice, beside the
    number of rows that the breach concerns."""
    from pyspark.sql import types as T

    from lakeline.plans import views
    rows = views.raw_trips(t).withColumn("fare_amount", F.col("fare_amount").cast("double"))
    problems = checks.schema_contract(rows, T.StructType.fromDDL(CONTRACT))
    return rows.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(F.array(*map(F.lit, problems))).alias("problem"), "rows")
