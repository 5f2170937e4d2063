"""Delivery-app raw tables over the test tables, and the star built on them.

Mapping (SURVEY §7.3): orders -> orders (status F = delivered, delivered
time = last ship date of the order), items -> lineitem (unit price = the
part's list price), restaurants -> supplier, products -> part (category =
p_type), customers -> customer (segment), cities -> customer nation and
region, courier -> o_custkey mod 50, payment method -> order priority,
promo code -> order-level rule, fee / tip / discount -> fixed shares of
the order total in integer cents.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeline.functions import fixed

from lakeline.functions.exprs import date_key, duration_minutes, money
from lakeline.operators import star
from lakeline.operators.keys import ordinal
from lakeline.plans.tables import Tables
from lakeline.session import stored, stored_once

def _memo(fn):
    """Build a frame once per Tables handle, so a query that needs a
    dimension twice reuses the one already keyed (and checkpointed)."""
    def wrapper(t: Tables) -> DataFrame:
        cache = t.__dict__.setdefault("_built", {})
        if fn.__name__ not in cache:
            cache[fn.__name__] = fn(t)
        return cache[fn.__name__]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


SOURCES = ("orders", "lineitem", "customer", "supplier", "part", "nation", "region")


def _stored(fn):
    """The star's tables: written once for a run of a query and read by its
    steps (their own columns alone).  Plans see their size in bytes, so a small
    dimension is broadcast and a fact is never shuffled on a key of few values.
    Only handles that aren't ``apart`` share them, for an application and state
    of the source tables."""
    def build(t: Tables) -> DataFrame:
        if t.apart:
            return stored(fn(t), fn.__name__)
        return stored_once(t.spark, fn.__name__, [t.path(s) for s in SOURCES], lambda: fn(t))
    build.__name__ = fn.__name__
    build.__doc__ = fn.__doc__
    return _memo(build)


def side_by_side(t: Tables, *made) -> list[DataFrame]:
    """Build frames that don't need each other at the same time: the small jobs
    of the dimensions fill the gaps of the large ones."""
    with ThreadPoolExecutor(len(made)) as pool:
        return list(pool.map(lambda f: f(t), made))


# Fixed values of ours: cuisine labels by s_suppkey mod 5, in this order.
CUISINES = ["italian", "mexican", "japanese", "indian", "peruvian"]
COURIERS = 50
PROMO_MEMBER = fixed.NO_PROMO


def _order_columns() -> list:
    status = (F.when(F.col("o_orderstatus") == "F", "delivered")
              .when(F.col("o_orderstatus") == "O", "open").otherwise("pending"))
    return [
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_custkey").alias("customer_id"),
        F.pmod("o_custkey", F.lit(COURIERS)).alias("courier_id"),
        F.col("c_nationkey").cast("bigint").alias("city_id"),
        status.alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.col("last_ship")).alias("delivered_ts"),
    ]


def _orders_joined(t: Tables, extra: list[str], customers: DataFrame | None = None, ends: DataFrame | None = None) -> DataFrame:
    """Orders with their customer's nation and last ship date; ``customers`` and
    ``ends``: tables that bring further columns along on the same joins."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", *extra)
    c = t.customer.select("c_custkey", "c_nationkey") if customers is None else customers
    last_ship = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship")) if ends is None else ends
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(
        last_ship, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def raw_orders(t: Tables) -> DataFrame:
    return _orders_joined(t, []).select(*_order_columns())


HOT_LINES = 100_000  # an order of more lines is not handled by one task


@_stored
def order_ends(t: Tables) -> DataFrame:
    """Last ship date and number of lines of each order."""
    return t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"), F.count(F.lit(1)).alias("n_lines"))


@_memo
def hot_orders(t: Tables) -> DataFrame | None:
    """Orders of more than ``HOT_LINES`` lines (so at most a row for that many
    lines), if any."""
    hot = order_ends(t).filter((F.col("n_lines") > HOT_LINES) & F.col("l_orderkey").isNotNull()).select(F.col("l_orderkey").alias("order_id"))
    return None if hot.isEmpty() else hot


ITEM_ORDER = ["product_id", "restaurant_id", "l_extendedprice"]


def _priced_lines(t: Tables, keyed: bool) -> DataFrame:
    """Lines with their part's prices (a list: a part may come twice, and a line
    is numbered before it meets them) and, ``keyed``, the star's keys."""
    li = t.lineitem.filter(F.col("l_orderkey").isNotNull()).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("restaurant_id"),
        "l_extendedprice", F.col("l_quantity").cast("int").alias("qty"))
    price = F.struct(F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"))
    parts = t.part.groupBy(F.col("p_partkey").alias("product_id")).agg(F.collect_list(price).alias("prices"))
    if keyed:
        parts = parts.join(dim_product(t).select("product_id", "product_key"), "product_id", "left")
        li = li.join(dim_restaurant(t).select("restaurant_id", "restaurant_key"), "restaurant_id", "left")
    return li.join(parts, "product_id", "left")


def raw_order_items(t: Tables, hot: bool = False, keyed: bool = False) -> DataFrame:
    """Items with a line number that is unique per order (the source's is not):
    those of hot orders, numbered in slices, or those of the others, numbered
    where the lines of an order meet."""
    li, many = _priced_lines(t, keyed), hot_orders(t)
    if hot:
        numbered = ordinal(li.join(F.broadcast(many), "order_id", "left_semi"), [F.col(c) for c in ITEM_ORDER], ["order_id"], "line_number", written=False)
    else:
        some = li if many is None else li.join(F.broadcast(many), "order_id", "left_anti")
        numbered = some.withColumn("line_number", F.row_number().over(Window.partitionBy("order_id").orderBy(*ITEM_ORDER)))
    return numbered.select("order_id", F.col("line_number").cast("int").alias("line_number"), "product_id", "restaurant_id", "qty",
                           *(["product_key", "restaurant_key"] if keyed else []), F.inline("prices"))


def _share_cents(cents, pct: int):
    return F.expr(f"({cents} * {pct} + 50) div 100")


def _promo_code():
    k = F.col("o_orderkey")
    return F.when(F.pmod(k, F.lit(3)) == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("P"), F.pmod(k, F.lit(20)).cast("string")))


def _payment_columns() -> list:
    cents = "CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 100 AS BIGINT)"
    has_promo = F.pmod("o_orderkey", F.lit(3)) != 0
    return [
        F.col("o_orderpriority").alias("payment_method"),
        money("o_totalprice").alias("subtotal"),
        star.from_cents(_share_cents(cents, 1)).alias("delivery_fee"),
        star.from_cents(_share_cents(cents, 5)).alias("tip_amount"),
        F.when(has_promo, star.from_cents(_share_cents(cents, 10)))
        .otherwise(F.lit(0).cast("decimal(14,2)")).alias("discount_amount"),
    ]


def raw_promotions(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("order_id"), _promo_code().alias("promo_code"))


def raw_payments(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return o.select(F.col("o_orderkey").alias("order_id"), *_payment_columns())


# --- dimensions ---------------------------------------------------------

@_stored
def dim_date(t: Tables) -> DataFrame:
    # One pass over the orders: both ends of both dates, then two rows.
    ends = raw_orders(t).agg(F.least(F.min("order_ts"), F.min("delivered_ts")).alias("lo"), F.greatest(F.max("order_ts"), F.max("delivered_ts")).alias("hi"))
    return star.date_dimension(ends.select(F.explode(F.array("lo", "hi")).alias("d")), "d")


@_stored
def dim_city(t: Tables) -> DataFrame:
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    cities = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
    )
    return star.surrogate_keys(cities, ["city_id"], "city_key")


@_stored
def dim_customer(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    return star.surrogate_keys(c, ["customer_id"], "customer_key")


def cuisine_of(suppkey) -> "F.Column":
    idx = F.pmod(suppkey, F.lit(len(CUISINES))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(c) for c in CUISINES]), idx)


@_stored
def dim_restaurant(t: Tables) -> DataFrame:
    s = t.supplier.select(
        F.col("s_suppkey").alias("restaurant_id"), F.col("s_name").alias("restaurant_name"),
        cuisine_of(F.col("s_suppkey")).alias("cuisine"))
    return star.surrogate_keys(s, ["restaurant_id"], "restaurant_key")


@_stored
def dim_product(t: Tables) -> DataFrame:
    p = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                      F.col("p_type").alias("category"))
    return star.surrogate_keys(p, ["product_id"], "product_key")


@_stored
def dim_payment_method(t: Tables) -> DataFrame:
    return star.junk_dimension(raw_payments(t), "payment_method", "payment_method", "payment_method_key")


@_stored
def dim_promotion(t: Tables) -> DataFrame:
    return star.junk_dimension(raw_promotions(t), "promo_code", "promo_code", "promotion_key", PROMO_MEMBER)


# --- fact ----------------------------------------------------------------

LINE_KEYS = ["product_key", "restaurant_key"]
ORDER_KEYS = ["city_key", "customer_key", "payment_method_key", "promotion_key"]
HEADER = ["order_ts", "courier_id", "status", "delivered_ts", *ORDER_KEYS]
AMOUNTS = ["discount_amount", "delivery_fee", "tip_amount"]


def order_header(t: Tables) -> DataFrame:
    """Every order-level attribute the fact needs (order, payment, promotion),
    from one scan of orders: they share the order key, so no joins between them.
    The keys of its dimensions are looked up here, once for an order, null where
    there is none; sides to broadcast are left to the planner, which knows their
    stored size."""
    customers = t.customer.select("c_custkey", "c_nationkey").join(
        dim_customer(t).select(F.col("customer_id").alias("c_custkey"), "customer_key"), "c_custkey", "left")
    x = _orders_joined(t, ["o_orderpriority", "o_totalprice"], customers, order_ends(t).drop("n_lines"))
    orders = x.select(*_order_columns(), *_payment_columns(),
                      F.coalesce(_promo_code(), F.lit(PROMO_MEMBER)).alias("promo_code"), "customer_key")
    return (orders.join(dim_city(t).select("city_id", "city_key"), "city_id", "left")
            .join(dim_payment_method(t), "payment_method", "left").join(dim_promotion(t), "promo_code", "left"))


def allocated_lines(t: Tables, carry: list[str] | None = None, keyed: bool = False) -> DataFrame:
    def items(hot: bool) -> DataFrame:
        return raw_order_items(t, hot, keyed).withColumn(
            "gross_item_amount", (F.col("qty") * F.col("unit_price")).cast("decimal(14,2)"))

    header = order_header(t) if carry else raw_payments(t).select("order_id", *AMOUNTS)
    how = ("order_id", "line_number", "gross_item_amount", AMOUNTS, carry)
    out, many = star.allocate_together(items(False), header, *how, dense=True), hot_orders(t)
    if many is None:
        return out
    return out.unionByName(star.allocate(items(True), header.join(F.broadcast(many), "order_id", "left_semi"), *how, dense=True))


def fact_lines(t: Tables) -> DataFrame:
    """The fact's rows: lines move to their part and to their order, with the
    keys of their dimensions, and no further."""
    side_by_side(t, order_ends, dim_city, dim_customer, dim_restaurant, dim_product, dim_payment_method, dim_promotion)
    f = allocated_lines(t, HEADER, keyed=True).dropna(subset=[*LINE_KEYS, *ORDER_KEYS])
    net = (F.col("gross_item_amount") - F.col("allocated_discount_amount")).cast("decimal(14,2)")
    return f.select(
        "order_id", "line_number",
        date_key("order_ts").alias("order_date_key"),
        date_key("delivered_ts").alias("delivered_date_key"),
        "city_key", "customer_key", "restaurant_key", "courier_id", "product_key",
        "payment_method_key", "promotion_key", "status", "qty", "unit_price",
        "gross_item_amount",
        "allocated_discount_amount",
        F.col("allocated_delivery_fee").alias("allocated_delivery_fee"),
        F.col("allocated_tip_amount").alias("allocated_tip_amount"),
        net.alias("net_revenue"),
        duration_minutes("order_ts", "delivered_ts").cast("int").alias("dispatch_minutes"),
    )


@_stored
def star_fact(t: Tables) -> DataFrame:
    return fact_lines(t)


def star_q1(fact: DataFrame, t: Tables) -> DataFrame:
    """Net revenue per month, region and cuisine."""
    dd = dim_date(t).select("date_key", "year_month")
    city = dim_city(t).select("city_key", "region")
    rest = dim_restaurant(t).select("restaurant_key", "cuisine")
    x = (fact.join(dd, fact["order_date_key"] == dd["date_key"]).join(city, "city_key")
         .join(rest, "restaurant_key"))
    return x.groupBy("year_month", "region", "cuisine").agg(
        F.round(F.sum("net_revenue"), 2).cast("double").alias("net_revenue"))


def star_q2(fact: DataFrame, t: Tables, n: int = 10) -> DataFrame:
    """Top-n promo codes by net revenue, with their share of all orders."""
    # An order has one promotion, so order grain counts orders in one pass.
    orders = fact.groupBy("order_id", "promotion_key").agg(F.sum("net_revenue").alias("_net"))
    g = orders.groupBy("promotion_key").agg(F.sum("_net").alias("_net"), F.count(F.lit(1)).alias("orders"))
    share = F.col("orders") / F.sum("orders").over(Window.partitionBy())  # one row for each promotion
    return (g.withColumn("_share", share).join(dim_promotion(t), "promotion_key").filter(F.col("promo_code") != PROMO_MEMBER)
            .select("promo_code", F.round("_net", 2).cast("double").alias("net_revenue"), "orders", F.round("_share", 8).alias("order_share"))
            .orderBy(F.desc("net_revenue"), "promo_code").limit(n))


def star_q3(t: Tables) -> DataFrame:
    """Mean order-to-delivery minutes per courier, delivered orders with lines:
    a question at order grain, so it reads the order header alone."""
    orders = raw_orders(t).filter((F.col("status") == "delivered") & F.col("delivered_ts").isNotNull()).select(
        "courier_id", duration_minutes("order_ts", "delivered_ts").cast("int").alias("dispatch_minutes"))
    return orders.groupBy("courier_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.round(F.avg("dispatch_minutes"), 6).alias("avg_cycle_minutes"))
