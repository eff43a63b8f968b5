"""Structured Streaming forms of the jobs that run once per arriving file."""

from .arrivals import (
    merge_arrivals, merge_batch, read_arrivals, store_arrivals, stream_reports, stream_session,
    stream_totals, write_stream,
)

from .open_events import keep_open_events, open_event_session

__all__ = [
    "keep_open_events", "open_event_session",
    "merge_arrivals", "merge_batch", "read_arrivals", "store_arrivals", "stream_reports", "stream_session",
    "stream_totals", "write_stream",
]
