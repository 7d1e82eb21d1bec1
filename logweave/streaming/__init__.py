"""Structured Streaming: table writer, pattern matcher, restarts."""

from logweave.streaming.matcher import match_sequence_stream
from logweave.streaming.jobs import run_with_restarts, start_alerts_stream, start_tables_stream

__all__ = ["match_sequence_stream", "run_with_restarts", "start_alerts_stream", "start_tables_stream"]
