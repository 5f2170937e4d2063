"""Rows of sorted reports come in their documented order (the comparison with
DuckDB ignores it)."""

import pytest

from lakeline.plans.registry import load_all

SF = "/root/testdata/sf0.001"
# Sort columns of each report; a minus sign marks descending order.
SORTED = {
    "trips_per_day": ["pickup_date"],
    "events_per_day": ["event_date"],
    "trips_per_hour": ["event_hour"],
    "trips_by_zone_month": ["-num_trips", "pickup_month", "PU_zone"],
    "revenue_by_zone_month": ["pickup_month", "-total_revenue"],
    "revenue_by_month_top10": ["pickup_month", "-total_revenue"],
    "orders_by_city_month": ["year_month", "city"],
    "corr_rank": ["-corr"],
    "star_q2": ["-net_revenue", "promo_code"],
}


@pytest.mark.parametrize("key", SORTED)
def test_sorted_report(spark, key):
    rows = load_all()[key](spark, SF).collect()
    assert len(rows) > 1
    want = list(rows)
    for c in reversed(SORTED[key]):
        want.sort(key=lambda r: r[c.lstrip("-")], reverse=c.startswith("-"))
    assert [[r[c.lstrip("-")] for c in SORTED[key]] for r in rows] == [[r[c.lstrip("-")] for c in SORTED[key]] for r in want]
