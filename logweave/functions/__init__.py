"""Column expressions (built-in Spark functions only, no UDFs)."""

from logweave.functions.body import body_info, body_severity, body_timestamp, correlation_id, severity_word
from logweave.functions.severity import accepted_level, severity_code, severity_name
from logweave.functions.timeparse import (
    age_seconds, date_piece, in_period, remaining_ttl, timeframe_minutes, to_event_time,
)
from logweave.functions.render import alert_text, entry_json

__all__ = [
    "body_info", "body_severity", "body_timestamp", "correlation_id", "severity_word",
    "accepted_level", "severity_code", "severity_name",
    "age_seconds", "date_piece", "in_period", "remaining_ttl", "timeframe_minutes", "to_event_time",
    "alert_text", "entry_json",
]
