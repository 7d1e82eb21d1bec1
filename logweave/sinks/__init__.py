"""Sinks: table writers, keyed writers, alert text, Kafka and console."""

from logweave.sinks.commitlog import TableLog, compact, expire, read_table, upsert_latest, vacuum, write_batch
from logweave.sinks.writers import (
    alerts_to_outbox, alerts_to_text, merge_latest, print_rows, read_partition, write_alerts_kafka, write_alerts_text, write_keyed,
    write_micro_batch, write_table,
)

__all__ = ["TableLog", "alerts_to_outbox", "alerts_to_text", "compact", "expire", "read_table", "upsert_latest", "vacuum", "write_batch", "merge_latest", "print_rows", "read_partition", "write_alerts_kafka", "write_alerts_text", "write_keyed",
           "write_micro_batch", "write_table"]
