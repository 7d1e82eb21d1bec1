"""Command-line job: ``python -m logweave --topic T --broker B --target-topic A --tables.path P``.

Starts the table stream and the alert stream from one source, under the
fixed-delay restart policy. Extra options:

* ``--source.path DIR``  read text lines from files instead of Kafka;
* ``--alerts.path DIR``  write alert text to files instead of the target topic;
* ``--once true``        process what is available and stop (``availableNow``);
* ``--time.zone Z``      the zone of log times that name none (default UTC).
"""

from __future__ import annotations

import sys

from logweave.config import PipelineConfig
from logweave.operators.views import Placement
from logweave.session import get_spark
from logweave.sources.kafka import read_kafka_lines
from logweave.sources.text import read_lines
from logweave.streaming.jobs import run_with_restarts, start_alerts_stream, start_tables_stream


class _Both:
    """Two streaming queries run and fail together."""

    def __init__(self, spark, queries):
        self.spark, self.queries = spark, queries

    def awaitTermination(self):
        """Ends when both have ended, or raises as soon as either fails; the other is stopped then."""
        try:
            while any(q.isActive for q in self.queries):
                for q in self.queries:
                    q.awaitTermination(1)
            for q in self.queries:
                q.awaitTermination()
        finally:
            for q in self.queries:
                if q.isActive:
                    q.stop()


# options of this command that are not Kafka consumer properties
LOCAL_KEYS = {"source.path", "source.max.files", "alerts.path", "once", "future.cap", "expiry.batches", "compact.batches", "alerts.outbox",
              "time.zone"}
# options of Spark's own source, passed as they are
SOURCE_KEYS = {"startingOffsets", "startingTimestamp", "maxOffsetsPerTrigger", "minOffsetsPerTrigger", "minPartitions", "failOnDataLoss"}
# settings the Spark Kafka source has no use for: the old consumer's ZooKeeper address, and the
# column-store address of the original sinks (tables go to --tables.path here)
IGNORED_KEYS = {"zookeeper.connect", "cassandra.host", "cassandra.port"}


def kafka_source_options(cfg: PipelineConfig) -> tuple[str, dict]:
    """Bootstrap servers and consumer properties for the source.

    Extra arguments are consumer properties (``--group.id g`` -> ``kafka.group.id``);
    ``--bootstrap.servers`` names the source cluster, else ``--broker`` is used.
    """
    servers = cfg.extra.get("bootstrap.servers") or cfg.broker
    opts = {k if k in SOURCE_KEYS else f"kafka.{k}": v for k, v in cfg.extra.items()
            if k not in LOCAL_KEYS | IGNORED_KEYS | {"bootstrap.servers"} and v != ""}
    return servers, opts


def _whole(cfg: PipelineConfig, key: str) -> int | None:
    return int(cfg.extra[key]) if cfg.extra.get(key) else None


def start(spark, cfg: PipelineConfig):
    once = cfg.extra.get("once", "false").lower() == "true"
    src = cfg.extra.get("source.path")
    if src:
        lines = read_lines(spark, src, streaming=True, max_files_per_trigger=_whole(cfg, "source.max.files"))
    else:
        servers, opts = kafka_source_options(cfg)
        lines = read_kafka_lines(spark, servers, cfg.topic, options=opts)
    place = Placement(cfg.az, cfg.region)
    trigger = None if once else cfg.trigger_ms
    # beside the tables, so that a new process goes on where the last one stopped
    checkpoints = f"{cfg.tables_path.rstrip('/')}/_checkpoints"
    tables = start_tables_stream(lines, cfg.tables_path, checkpoint=f"{checkpoints}/tables", parse_body=cfg.parse_body, place=place,
                                 trigger_ms=trigger, available_now=once, expire_every=_whole(cfg, "expiry.batches") or 0,
                                 compact_every=_whole(cfg, "compact.batches") or 0)
    box, alerts_path = cfg.extra.get("alerts.outbox"), cfg.extra.get("alerts.path")
    sink, target = ("outbox", box) if box else ("text", alerts_path) if alerts_path else ("kafka", cfg.target_topic)
    opts = {"kafka.bootstrap.servers": cfg.broker} if sink == "kafka" else {}
    alerts = start_alerts_stream(lines, sink, target, checkpoint=f"{checkpoints}/alerts",
                                 parse_body=cfg.parse_body, delay_s=cfg.max_out_of_order_s, options=opts,
                                 trigger_ms=trigger, available_now=once, future_cap_s=_whole(cfg, "future.cap"))
    return _Both(spark, [tables, alerts])


def main(argv: list[str] | None = None) -> int:
    cfg = PipelineConfig.from_args(list(sys.argv[1:] if argv is None else argv))
    spark = get_spark(cfg.job_name(), time_zone=cfg.extra.get("time.zone") or "UTC")
    run_with_restarts(lambda: start(spark, cfg), attempts=cfg.restart_attempts,
                      delay_s=60.0 * cfg.restart_delay_min)
    return 0


if __name__ == "__main__":
    sys.exit(main())
