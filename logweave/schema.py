"""Record schema and the fixed lookup values the engine must agree on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the semantics being reproduced).
# Log record fields, in serialisation order.
LOG_FIELDS = (
    "severity", "body", "spriority", "hostname", "protocol", "port",
    "sender", "service", "id", "facility", "timestamp",
)
# Syslog severity code -> name.
SEVERITY_NAMES = {
    "0": "EMERG", "1": "ALERT", "2": "CRIT", "3": "ERROR",
    "4": "WARNING", "5": "NOTICE", "6": "INFO", "7": "DEBUG",
}
# Levels that reach the tables and patterns (a list, not a threshold).
ACCEPTED_LEVELS = ("ERROR", "WARNING", "INFO")
# Retention horizons: id -> seconds ("1m" is 28 days).
HORIZONS = (
    ("1h", 3600), ("6h", 21600), ("12h", 43200),
    ("24h", 86400), ("1w", 604800), ("1m", 2419200),
)
# Text substituted when the message carries no timestamp (epoch 0).
EPOCH_TEXT = "1970-01-01 00:00:00.0"
# End of fixed values.
# ---------------------------------------------------------------------------

SEVERITY_CODES = {name: code for code, name in SEVERITY_NAMES.items()}

LOG_ENTRY = T.StructType([T.StructField(f, T.StringType(), True) for f in LOG_FIELDS])

CORRUPT_COL = "_corrupt_record"

# JSON schema used by the parser: the record plus a slot for malformed input.
LOG_ENTRY_WITH_CORRUPT = T.StructType(
    list(LOG_ENTRY.fields) + [T.StructField(CORRUPT_COL, T.StringType(), True)]
)

# Reject reasons, in the order they are tested.
REJECT_REASONS = (
    "bad_json", "missing_field", "no_timestamp", "no_severity", "no_info",
    "unknown_severity", "level_not_accepted",
)


def log_fields() -> list[str]:
    """Field list of the record (CFG3)."""
    return list(LOG_ENTRY.fieldNames())
