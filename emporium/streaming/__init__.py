"""Structured Streaming: idempotent ingest, de-duplication, daily counts, gauges."""

from emporium.streaming.ingest import (daily_counts, dedupe_within_watermark, event_time,
                                       ingest_if_absent, latest_gauges_stream, run_to_table)

__all__ = ["daily_counts", "dedupe_within_watermark", "event_time", "ingest_if_absent",
           "latest_gauges_stream", "run_to_table"]

stream_orders = ingest_if_absent
stream_dedupe = dedupe_within_watermark
stream_daily_counts = daily_counts
stream_latest_gauge = latest_gauges_stream
