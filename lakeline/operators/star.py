"""Star-schema building blocks: surrogate keys, dimensions, allocation.

Allocation has two forms.  ``allocate_together`` moves the lines once, to their
order: totals, header and leftover cents meet them there, which takes an order
that fits one task.  ``allocate``, for hot orders, joins the lines with a stored
table of one row per order: no window over an order and no aggregate right
under the join, so AQE can split an order that holds a third of all lines.  The
cents that rounding leaves over concern last lines only, one row per order.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeline.functions.exprs import date_key
from lakeline.operators.keys import ordinal
from lakeline.session import stored


def surrogate_keys(df: DataFrame, natural: list[str], key: str,
                   existing: DataFrame | None = None) -> DataFrame:
    """Give each distinct natural key an integer surrogate key.

    Keys already in ``existing`` are kept; new natural keys get
    ``max(existing key) + position`` in natural-key order (an identity
    column that never reuses or renumbers)."""
    rest = [c for c in df.columns if c not in natural]
    # Of several versions of a key the greatest stays, whatever the order of rows.
    best = df.groupBy(*natural).agg(F.max(F.struct(*rest)).alias("__best")) if rest else df.distinct()
    distinct = best.select(*natural, *[F.col(f"__best.{c}").alias(c) for c in rest]).select(*df.columns)
    if existing is None:
        numbered = ordinal(distinct, [F.col(c) for c in natural], None, key)
        return numbered.withColumn(key, F.col(key).cast("int")).select(key, *df.columns)
    new = distinct.join(existing.select(*natural), natural, "left_anti")
    base = existing.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]  # one scalar
    numbered = ordinal(new, [F.col(c) for c in natural], None, "__rn")
    added = numbered.select((F.lit(base) + F.col("__rn")).cast("int").alias(key), *df.columns)
    return existing.select(key, *df.columns).unionByName(added)


def date_dimension(dates: DataFrame, col: str) -> DataFrame:
    """One row per day between the min and max of ``col`` (inclusive)."""
    span = dates.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    return days.select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
    )


def junk_dimension(df: DataFrame, col: str, out: str, key: str, null_member: str | None = None) -> DataFrame:
    """Distinct values of a low-cardinality attribute, NULL mapped to a member."""
    v = F.col(col) if null_member is None else F.coalesce(F.col(col), F.lit(null_member))
    vals = df.select(v.alias(out)).filter(F.col(out).isNotNull())
    return surrogate_keys(vals, [out], key)


def from_cents(c) -> "F.Column":
    """Integer cents to decimal(14,2), exactly."""
    return (c.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast("decimal(14,2)")


def _cents(c: str) -> str:
    return f"CAST(`{c}` * 100 AS BIGINT)"


def line_shares(lines: DataFrame, per_order: DataFrame, order_id: str, line_no: str, weight: str, amounts: list[str]) -> DataFrame:
    """Lines with each amount's share in whole cents (``__s_<amount>``).

    ``per_order``: a stored table, so both sides of the join are plain
    exchanges and AQE can split a hot order."""
    return lines.join(per_order, order_id).withColumns(
        _shares(weight, amounts) | {"__is_last": F.col(line_no) == F.col("__last")})


def _shares(weight: str, amounts: list[str]) -> dict:
    wc, tc = _cents(weight), _cents("__w_total")
    shares = {}
    for a in amounts:
        ac = _cents(a)
        # half-up of ac*wc/tc in integer cents (all amounts >= 0)
        prop = F.expr(f"(2 * {ac} * {wc} + {tc}) div (2 * {tc})")
        eq = F.expr(f"(2 * {ac} + __n_lines) div (2 * __n_lines)")
        shares[f"__s_{a}"] = F.when(F.col("__w_total") == 0, eq).otherwise(prop).cast("bigint")
    return shares


def allocate_together(lines: DataFrame, orders: DataFrame, order_id: str, line_no: str,
                      weight: str, amounts: list[str], carry: list[str] | None = None, dense: bool = False) -> DataFrame:
    """``allocate`` for orders that fit one task each: the same rows, and nothing
    is written.  Lines that are already dealt out by ``order_id`` (numbered by a
    window over it, say) don't move again."""
    whole = Window.partitionBy(order_id)
    n_lines = F.count(F.lit(1)).over(whole)
    sized = lines.withColumns({"__w_total": F.sum(weight).over(whole), "__n_lines": n_lines,
                               "__last": n_lines.cast("int") if dense else F.max(line_no).over(whole)})
    # An order with several headers: its last lines take the rest of each.
    headers = orders.select(order_id, *amounts, *(carry or [])) \
        .withColumn("__headers", F.collect_list(F.struct(*amounts)).over(whole))
    kept = [*lines.columns, *[c for c in carry or [] if c not in lines.columns]]
    x = sized.join(headers, order_id).withColumns(_shares(weight, amounts) | {"__is_last": F.col(line_no) == F.col("__last")})
    x = x.withColumns({f"__t_{a}": F.sum(f"__s_{a}").over(whole) for a in amounts})

    # One row of each line, of a last one a row for each header.
    none = F.array(F.lit(None).cast(x.schema["__headers"].dataType.elementType))
    x = x.withColumn("__header", F.explode(F.when(F.col("__is_last"), F.col("__headers")).otherwise(none)))
    over = {a: F.when(F.col("__is_last"), F.expr(f"CAST(`__header`.`{a}` * 100 AS BIGINT) - `__t_{a}`")).otherwise(F.lit(0)) for a in amounts}
    return x.select(*kept, *[from_cents(F.col(f"__s_{a}") + over[a]).alias(f"allocated_{a}") for a in amounts])


def allocate(lines: DataFrame, orders: DataFrame, order_id: str, line_no: str,
             weight: str, amounts: list[str], carry: list[str] | None = None, dense: bool = False) -> DataFrame:
    """Split order-level amounts over its lines in proportion to ``weight``.

    share = amount * weight / order weight, rounded half-up to cents with
    integer arithmetic (exact in any engine); the last line takes the
    residual so every order reconciles to the cent.  Equal split when the
    order's weight is 0.  Amounts come back as decimal(14,2) columns named
    ``allocated_<amount>``; ``carry`` order columns ride along on the same
    join, so a fact needs no second join to its order header.  ``dense``: line
    numbers run from 1, so the last one is the count, and the totals are made
    without numbering the lines.  Lines are written once, with their shares."""
    totals = lines.groupBy(order_id).agg(
        F.sum(weight).alias("__w_total"),
        F.count(F.lit(1)).alias("__n_lines"),
        (F.count(F.lit(1)).cast("int") if dense else F.max(line_no)).alias("__last"),
    )
    headers = orders.select(order_id, *amounts, *(carry or []))
    per_order = stored(totals.join(headers, order_id), "order-totals")
    kept = [*lines.columns, *[c for c in carry or [] if c not in lines.columns]]
    x = stored(line_shares(lines, per_order, order_id, line_no, weight, amounts).select(
        *kept, *[f"__s_{a}" for a in amounts], "__is_last"), "line-shares")
    sums = x.groupBy(order_id).agg(*[F.sum(f"__s_{a}").alias(f"__t_{a}") for a in amounts])
    over = per_order.join(sums, order_id).select(
        order_id, *[(F.expr(_cents(a)) - F.col(f"__t_{a}")).alias(f"__o_{a}") for a in amounts])
    outs = [from_cents(F.col(f"__s_{a}")).alias(f"allocated_{a}") for a in amounts]
    fixed_up = [from_cents(F.col(f"__s_{a}") + F.col(f"__o_{a}")).alias(f"allocated_{a}") for a in amounts]
    last = x.filter("__is_last").join(over, order_id).select(*kept, *fixed_up)
    return x.filter("NOT __is_last").select(*kept, *outs).unionByName(last)
