"""Incremental processing with Structured Streaming."""

from reviewsieve.streaming.keyed import StreamProgress, run_keyed_stream
from reviewsieve.streaming.runner import read_stats, run_preprocess_stream, stream_progress

__all__ = ["StreamProgress", "read_stats", "run_keyed_stream", "run_preprocess_stream", "stream_progress"]
