"""Sources: Kafka topics, text files, table specs and the events adapter."""

from logweave.sources.fixtures import events_to_lines, read_event_lines
from logweave.sources.kafka import read_kafka_lines
from logweave.sources.table_specs import read_table_specs
from logweave.sources.text import read_lines, read_primitives

__all__ = ["events_to_lines", "read_event_lines", "read_kafka_lines", "read_table_specs",
           "read_lines", "read_primitives"]
