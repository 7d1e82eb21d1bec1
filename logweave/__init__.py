"""logweave: a Spark-native engine for cloud-platform syslog streams.

Every operator is a ``DataFrame -> DataFrame`` transformation made of built-in
Spark expressions, so the same code runs in batch and in Structured Streaming.
The names below are importable from the package root (loaded on first use).
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_EXPORTS = {
    "get_spark": "logweave.session",
    "PipelineConfig": "logweave.config",
    "read_lines": "logweave.sources.text",
    "read_kafka_lines": "logweave.sources.kafka",
    "read_table_specs": "logweave.sources.table_specs",
    "events_to_lines": "logweave.sources.fixtures",
    "parse_entries": "logweave.operators.parse",
    "validate": "logweave.operators.parse",
    "accepted_entries": "logweave.operators.parse",
    "quarantine": "logweave.operators.parse",
    "fan_out": "logweave.operators.retention",
    "live": "logweave.operators.retention",
    "ttl_left": "logweave.operators.retention",
    "latest_by_key": "logweave.operators.retention",
    "node_rows": "logweave.operators.views",
    "service_rows": "logweave.operators.views",
    "stack_rows": "logweave.operators.views",
    "raw_rows": "logweave.operators.views",
    "Step": "logweave.operators.patterns",
    "Compare": "logweave.operators.patterns",
    "SequencePattern": "logweave.operators.patterns",
    "ChainPattern": "logweave.operators.patterns",
    "consecutive_errors": "logweave.operators.patterns",
    "correlated_create_vm": "logweave.operators.patterns",
    "match_sequence": "logweave.operators.patterns",
    "read_partition": "logweave.sinks.writers",
    "read_table": "logweave.sinks.commitlog",
    "write_batch": "logweave.sinks.commitlog",
    "compact": "logweave.sinks.commitlog",
    "vacuum": "logweave.sinks.commitlog",
    "run_batch": "logweave.plans.job",
    "match_sequence_stream": "logweave.streaming.matcher",
    "start_tables_stream": "logweave.streaming.jobs",
    "start_alerts_stream": "logweave.streaming.jobs",
    "run_with_restarts": "logweave.streaming.jobs",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'logweave' has no attribute {name!r}")
