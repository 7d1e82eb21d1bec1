"""Streaming job: parse -> four tables per micro-batch, and the alert stream (STR1-STR9, SNK1-SNK5).

The table query writes every accepted row (late or not: no watermark before
the append sinks) through ``foreachBatch``; each micro-batch is persisted
once, written to the four tables and the quarantine, then released. The
period test and the TTL count from the micro-batch's own time, which Spark
records with its offsets: a replay yields the same rows. Each table has a commit
log (:mod:`logweave.sinks.commitlog`) that knows the checkpoint's batches, so a
replayed batch is there once, and another checkpoint's rows are left alone.
"""

from __future__ import annotations

import hashlib
import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.errors import StreamingQueryException

from logweave.operators.parse import accepted_entries, parse_entries, validate
from logweave.operators.patterns import ChainPattern, SequencePattern, correlated_create_vm
from logweave.operators.views import RAW_KEYS, Placement, node_rows, raw_rows, service_rows, stack_rows, table_counts
from logweave.session import ensure_checkpoint_dir
from logweave.sinks.expiry import drop_expired
from logweave.sources.kafka import ARRIVAL
from logweave.sinks.commitlog import compact, run_identity, upsert_latest, vacuum, write_batch
from logweave.sinks.writers import TABLE_PARTITIONS, alerts_to_outbox, alerts_to_text
from logweave.streaming.matcher import match_sequence_stream

_LOG = logging.getLogger(__name__)


def _checkpoint(df: DataFrame, name: str, location: str | None, target: str = "") -> str:
    """A stable folder: not below the application's own sub-folder, which the next process never finds.

    By default each target (table path, topic) has one of its own, as a checkpoint knows what was taken into *its* target.
    """
    spark = df.sparkSession
    home = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return location or f"{home.rstrip('/')}/streams/{name}-{hashlib.sha256(target.encode()).hexdigest()[:16]}"


def start_tables_stream(lines: DataFrame, out_path: str, checkpoint: str | None = None, parse_body: bool = True,
                        place: Placement = Placement(), trigger_ms: int | None = None,
                        query_name: str = "logweave_tables", available_now: bool = False,
                        keep_latest: bool = False, expire_every: int = 0, compact_every: int = 0) -> StreamingQuery:
    """Start the table query; ``keep_latest`` also upserts ``raw_latest`` (last write per raw key, SNK4b).

    ``expire_every``: after every so many micro-batches, take the horizon tables' expired
    files off (0: never; readers filter expired rows with ``live`` in any case). ``compact_every``: after every so
    many, merge the small files of the five tables and delete what has been no part of them for a week. The tables
    are read with ``read_table``.
    """
    # lines of a source that knows when they were written (Kafka) carry it to the latest-row table
    arrival = ARRIVAL if set(ARRIVAL) <= set(lines.columns) else ()
    v = validate(parse_entries(lines, parse_body, keep=("seq", *arrival)))
    v = v.withColumn("batch_time", F.current_timestamp())
    # per-micro-batch row counters (UDF2), reported in StreamingQueryProgress.observedMetrics
    accepted_flag = F.col("reject_reason").isNull()
    v = v.observe("ingest", F.count(F.lit(1)).alias("lines"),
                  F.count(F.when(accepted_flag, 1)).alias("accepted"),
                  F.count(F.when(~accepted_flag, 1)).alias("rejected"),
                  *table_counts("event_time", F.col("batch_time"), accepted_flag))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            accepted = batch.where(F.col("reject_reason").isNull()).drop("raw_value", "json_error", "reject_reason")
            # one value in all rows of the batch; none if it has no rows
            now = F.timestamp_micros(F.lit(batch.agg(F.max(F.unix_micros("batch_time"))).first()[0]).cast("long"))
            tables = {
                "node_rows": node_rows(accepted, now, place),
                "service_rows": service_rows(accepted, now, place),
                "stack_rows": stack_rows(accepted, now, place),
                "raw_rows": raw_rows(accepted, place, keep=arrival),
            }
            number = F.lit(batch_id).cast("long").alias("batch_id")
            for name, df in tables.items():
                write_batch(df.drop(*arrival).select("*", number), f"{out_path}/{name}", TABLE_PARTITIONS[name], run, batch_id)
            q = batch.where(F.col("reject_reason").isNotNull()).select("seq", "raw_value", "reject_reason", number)
            write_batch(q, f"{out_path}/quarantine", [], run, batch_id)
            if keep_latest:
                # rows of one run by batch and place; of two runs by the time their batch began
                raw = tables["raw_rows"].select("*", F.unix_micros(now).alias("batch_us"), number)
                upsert_latest(raw, f"{out_path}/raw_latest", RAW_KEYS, [*arrival] or ["batch_us", "batch_id", "seq"], ["date"], run, batch_id)
            if expire_every and batch_id % expire_every == expire_every - 1:
                for name in ("node_rows", "service_rows", "stack_rows"):
                    drop_expired(batch.sparkSession, f"{out_path}/{name}", now)
            if compact_every and batch_id % compact_every == compact_every - 1:
                for name in (*tables, "quarantine"):
                    compact(batch.sparkSession, f"{out_path}/{name}")
                    vacuum(batch.sparkSession, f"{out_path}/{name}")
        finally:
            batch.unpersist()

    location = _checkpoint(v, query_name, checkpoint, out_path)
    run = run_identity(v.sparkSession, location, out_path)
    w = v.writeStream.queryName(query_name).foreachBatch(write).option("checkpointLocation", location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_ms:
        w = w.trigger(processingTime=f"{int(trigger_ms)} milliseconds")
    return w.start()


def alerts_stream(lines: DataFrame, pattern: SequencePattern | ChainPattern | None = None, parse_body: bool = True,
                  delay_s: int = 0, future_cap_s: int | None = None) -> DataFrame:
    accepted = accepted_entries(lines, parse_body)
    return match_sequence_stream(accepted, pattern or correlated_create_vm(), delay_s, future_cap_s)


def start_alerts_stream(lines: DataFrame, sink: str, path_or_topic: str, pattern: SequencePattern | ChainPattern | None = None,
                        parse_body: bool = True, delay_s: int = 0, checkpoint: str | None = None,
                        options: dict | None = None, query_name: str = "logweave_alerts",
                        trigger_ms: int | None = None, available_now: bool = False,
                        future_cap_s: int | None = None) -> StreamingQuery:
    """Alert text to ``sink``: ``"kafka"`` (topic), ``"text"`` / ``"json"`` (path), ``"memory"`` (query name) or ``"outbox"``.

    The outbox (path) is a table with a commit log: ``seqs`` (the numbers of the alert's records) and the text. It holds
    the alerts of each micro-batch once, also after a crash and a replay; ``read_table`` reads it.

    ``future_cap_s`` keeps rows dated further ahead of the batch's time away from the patterns and counts
    them in the observed metric ``future_rows``.
    """
    alerts = alerts_stream(lines, pattern, parse_body, delay_s, future_cap_s)
    text = alerts_to_outbox(alerts) if sink == "outbox" else alerts_to_text(alerts, with_key=sink == "kafka")
    # alerts per micro-batch, reported in StreamingQueryProgress.observedMetrics (UDF2)
    text = text.observe("alerts", F.count(F.lit(1)).alias("alerts"))
    location = _checkpoint(text, query_name, checkpoint, f"{sink}:{path_or_topic}")
    w = text.writeStream.queryName(query_name).outputMode("append").option("checkpointLocation", location)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_ms:
        w = w.trigger(processingTime=f"{int(trigger_ms)} milliseconds")
    if sink == "outbox":
        run = run_identity(text.sparkSession, location, path_or_topic)

        def write(batch: DataFrame, batch_id: int) -> None:
            if not write_batch(batch, path_or_topic, [], run, batch_id):
                batch.write.format("noop").mode("overwrite").save()  # the replay's state must be committed all the same
        return w.foreachBatch(write).start()
    if sink == "kafka":
        return w.format("kafka").option("topic", path_or_topic).start()
    if sink == "memory":
        return w.format("memory").start()
    return w.format(sink).start(path_or_topic)


def run_with_restarts(start: Callable[[], StreamingQuery], attempts: int = 3, delay_s: float = 600.0,
                      sleep: Callable[[float], None] = time.sleep) -> StreamingQuery:
    """Fixed-delay restart (STR8): restart a failed query up to ``attempts`` times.

    Recovery resumes from the query's checkpoint (offsets and state), so a
    restart neither loses nor repeats committed micro-batches.
    """
    failures = 0
    while True:
        q = start()
        try:
            q.awaitTermination()
            return q
        except StreamingQueryException as exc:
            failures += 1
            if failures > attempts:
                _LOG.error("streaming job failed, no restart left (%d attempts): %s", attempts, exc)
                raise
            _LOG.error("streaming job failed (restart %d of %d in %.0f s): %s", failures, attempts, delay_s, exc)
            sleep(delay_s)
