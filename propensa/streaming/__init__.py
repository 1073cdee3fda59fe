from propensa.streaming.streams import (
    as_instant, attribute, event_stream, hourly_counts, run_available_now, stream_dedup, stream_sessions,
)

__all__ = ["as_instant", "attribute", "event_stream", "hourly_counts", "run_available_now", "stream_dedup",
           "stream_sessions"]
