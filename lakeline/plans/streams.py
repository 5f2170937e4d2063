"""Queries over streams of files (D2 and C8 as a streaming aggregate)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakeline.operators import versions
from lakeline.plans import reports
from lakeline.plans.registry import query
from lakeline.plans.sqlparts import BRONZE_CTE
from lakeline.session import scratch_path, stored
from lakeline.streaming import ingest, zones

CHUNK_DAYS = 366  # trips land as one set of files for each such span


def landed_trips(t) -> str:
    """The trips as files that arrive in order of their time."""
    trips = stored(reports.joined(t).select(*zones.SCHEMA.names), "trips")
    lo, hi = trips.agg(F.to_date(F.min("pickup_ts")), F.to_date(F.max("pickup_ts"))).first()
    folder = scratch_path(t.spark, "landed-trips")
    n = (hi - lo).days // CHUNK_DAYS + 2 if lo else 0
    ingest.land_in_chunks(trips, "pickup_ts", folder, [f"{lo + dt.timedelta(days=CHUNK_DAYS * k):%Y-%m-%d}" for k in range(n)])
    return folder


def streamed_fact(t) -> tuple[str, str]:
    folder, fact = landed_trips(t), scratch_path(t.spark, "zone-fact-stream")
    zones.update_fact(t.spark, folder, fact, scratch_path(t.spark, "zone-ckpt"), f"{CHUNK_DAYS + 1} days")
    return folder, fact


@query("stream_zone_fact", BRONZE_CTE + """
SELECT CAST(date_trunc('day', pickup_ts) AS DATE) AS pickup_date, pickup_location, pickup_location_name,
       count(*) AS trips, round(avg(trip_duration_minutes), 6) AS avg_trip_duration_minutes,
       CAST(round(sum(total_amount), 2) AS DOUBLE) AS total_amount
FROM silver_joined WHERE pickup_ts IS NOT NULL GROUP BY 1, 2, 3""")
def q_stream_zone_fact(t):
    """The zone fact kept up to date by a stream of trip files."""
    return versions.read(t.spark, streamed_fact(t)[1]).drop("pickup_month")


@query("stream_zone_report", BRONZE_CTE + """
SELECT count(*) AS rows_in, CAST(count_if(pickup_ts IS NULL) AS BIGINT) AS rows_without_time,
       CAST(count(pickup_ts) AS BIGINT) AS rows_in_fact, CAST(0 AS BIGINT) AS rows_late
FROM silver_joined""")
def q_stream_zone_report(t):
    """Rows that came, went into the fact, and were late."""
    return zones.report(t.spark, *streamed_fact(t))
