"""The stream ingest: complete once, and unchanged when every batch is applied again."""

from lakeline.operators import merge, versions
from lakeline.plans import loads
from lakeline.session import scratch_path
from lakeline.streaming import ingest


def test_stream_ingest_is_complete_and_reapplying_converges(spark, tables):
    landing = scratch_path(spark, "landing-test")
    ingest.land_in_chunks(tables.events, "ts", landing, ingest.week_bounds(tables.events, "ts"))
    target = scratch_path(spark, "raw-stream-test")
    ingest.upsert_stream(spark, landing, loads.EVENT_SCHEMA, "event_id", "ts", target,
                         scratch_path(spark, "ckpt-a"))
    first = sorted(tuple(r) for r in merge.read_newest(spark, target, ["id"]).select("id", "payload", "ingested_at_utc").collect())
    assert len(first) == tables.events.count() == len({r[0] for r in first})
    # a fresh checkpoint re-applies every batch, as retries would
    ingest.upsert_stream(spark, landing, loads.EVENT_SCHEMA, "event_id", "ts", target,
                         scratch_path(spark, "ckpt-b"))
    again = sorted(tuple(r) for r in merge.read_newest(spark, target, ["id"]).select("id", "payload", "ingested_at_utc").collect())
    assert again == first
    # in small steps: batches are folded into the base as they come
    target = scratch_path(spark, "raw-stream-folded")
    ingest.upsert_stream(spark, landing, loads.EVENT_SCHEMA, "event_id", "ts", target, scratch_path(spark, "ckpt-c"), compact_after=2)
    assert len(versions.latest(spark, target).folders) <= 2
    assert sorted(tuple(r) for r in merge.read_newest(spark, target, ["id"]).select("id", "payload", "ingested_at_utc").collect()) == first
