"""Hand-worked gold rows over a small table of our own."""

from decimal import Decimal

from lakeline.operators import gold, silver

# An unparsable time, a negative amount, a missing amount and a change of month.
ROWS = [
    (11, "2025-12-31 23:59:59", "Lima", Decimal("10.00"), 0),
    (12, "2026-01-01 00:00:00", "Lima", Decimal("40.00"), 1),
    (13, "2026-01-20 08:00:00", "Lima", Decimal("4.50"), 0),
    (14, "2026-01-21 09:30:00", "Cusco", Decimal("-3.00"), 0),
    (15, "2026-01-22 09:30:00", "Cusco", None, 1),
    (16, "no time", "Cusco", Decimal("2.00"), 0),
]


def test_city_months_worked_by_hand(spark):
    raw = spark.createDataFrame(ROWS, "order_id int, order_ts string, city string, amount decimal(14,2), is_discounted int")
    got = [tuple(r) for r in gold.orders_by_city_month(silver.silver_orders(raw)).collect()]
    assert got == [(None, "Cusco", 1, 2.0, 2.0), ("2025-12", "Lima", 1, 10.0, 10.0), ("2026-01", "Lima", 2, 40.5, 20.25)]
    rejects = silver.quality_rejects(silver.derive_order_columns(raw), silver.order_rules()).first()
    assert (rejects.rows_in, rejects.rows_kept, rejects.fail_amount) == (6, 4, 2)


def test_flagship_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["pickup_month", "PU_zone", "num_trips", "total_revenue", "total_fare", "total_tip", "tip_pct"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
