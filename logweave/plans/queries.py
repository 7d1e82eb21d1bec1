"""Driver queries: one per operator of the inventory, over the ``events`` table.

Every query reads ``events.parquet`` under ``sf_dir`` through the syslog
adapter and runs the engine's operators on the whole table; the ``document_*``
queries run the text extractors on the whole texts of ``documents``. Time columns are
rendered as ``yyyy-MM-dd HH:mm:ss.SSS`` text so results compare exactly with
the DuckDB oracles in :mod:`logweave.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logweave.functions import (
    age_seconds, body_info, body_severity, body_timestamp, correlation_id, in_period, remaining_ttl,
    severity_code, severity_name, severity_word, timeframe_minutes, to_event_time,
)
from logweave.functions.render import alert_text as alert_text_col
from logweave.operators.parse import (
    accepted_entries, parse_entries, quarantine, quarantine_counts, valid_entries, validate,
)
from logweave.operators.patterns import (
    MINUTES, ChainPattern, Compare, Step, consecutive_chain, consecutive_errors, correlated_create_vm, escalation,
    match_sequence, spreading_error,
)
from logweave.operators.retention import fan_out, latest_by_key, live, ttl_left
from logweave.operators.views import (
    NODE_KEYS, RAW_KEYS, SERVICE_KEYS, counts, node_rows, raw_rows, recent, service_rows, stack_rows,
)
from logweave.schema import HORIZONS, LOG_FIELDS
from logweave.sources.fixtures import events_to_times, read_event_lines

AS_OF = "2024-01-31 00:00:00"
# stored rows are read back half an hour after they were written
READ_AT = "2024-01-31 00:30:00"
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSS"

Query = Callable[[SparkSession, str], DataFrame]


def fmt(c: "str | Column") -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, TS_FMT)


def _lines(spark, sf_dir):
    # the table is one row group: spread, whatever its size
    return read_event_lines(spark, sf_dir, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _accepted(spark, sf_dir, parse_body=True):
    return accepted_entries(_lines(spark, sf_dir), parse_body)


def _parsed(spark, sf_dir, parse_body):
    return parse_entries(_lines(spark, sf_dir), parse_body).where(F.col("json_error").isNull())


# -- sources and parsing -----------------------------------------------------

def q_text_scan(spark, sf_dir):
    return _lines(spark, sf_dir).select("seq", "value")


def q_parse_entries(spark, sf_dir):
    return _parsed(spark, sf_dir, True).select("seq", *LOG_FIELDS)


def q_parse_entries_noparse(spark, sf_dir):
    return _parsed(spark, sf_dir, False).select("seq", *LOG_FIELDS)


def q_body_timestamp(spark, sf_dir):
    return _parsed(spark, sf_dir, False).select("seq", body_timestamp("body").alias("body_timestamp"))


def q_body_severity(spark, sf_dir):
    return _parsed(spark, sf_dir, False).select("seq", body_severity("body").alias("body_severity"))


def q_body_info(spark, sf_dir):
    return _parsed(spark, sf_dir, False).select("seq", body_info("body").alias("body_info"))


def q_severity_name(spark, sf_dir):
    return _parsed(spark, sf_dir, False).select("seq", "severity", severity_name("severity").alias("severity_name"))


def q_severity_code(spark, sf_dir):
    p = _parsed(spark, sf_dir, False).select("seq", severity_word("body").alias("severity_word"))
    return p.select("seq", "severity_word", severity_code("severity_word").alias("severity_code"))


def q_valid_entries(spark, sf_dir):
    return valid_entries(_lines(spark, sf_dir), True).select("seq", "severity", "service", "timestamp", "body")


def q_accepted_entries(spark, sf_dir):
    return _accepted(spark, sf_dir).select("seq", "level", "service", "hostname", "timestamp",
                                           fmt("event_time").alias("event_time"), "body")


def q_quarantine_counts(spark, sf_dir):
    return quarantine_counts(_lines(spark, sf_dir), True)


def q_quarantine_rows(spark, sf_dir):
    return quarantine(_lines(spark, sf_dir), True).select("seq", "reject_reason")


def q_time_flags(spark, sf_dir):
    v = validate(parse_entries(_lines(spark, sf_dir), True))
    return v.where(F.col("json_error").isNull() & F.col("time_flag").isNotNull()).select(
        "seq", "time_flag", fmt("event_time").alias("event_time"))


# parse-body off: severity and time come from the JSON fields (ISO times with an offset included)

def q_accepted_entries_noparse(spark, sf_dir):
    return _accepted(spark, sf_dir, parse_body=False).select(
        "seq", "level", "service", "timestamp", fmt("event_time").alias("event_time"))


def q_quarantine_counts_noparse(spark, sf_dir):
    return quarantine_counts(_lines(spark, sf_dir), False)


def q_stack_rows_noparse(spark, sf_dir):
    s = stack_rows(_accepted(spark, sf_dir, parse_body=False), AS_OF)
    return s.select("id", "region", "loglevel", "service", "timeframe", "tfhours", "ttl_s", "seq")


def q_to_event_time(spark, sf_dir):
    p = _parsed(spark, sf_dir, False)
    return p.select("seq", "timestamp", fmt(to_event_time("timestamp")).alias("event_time"))


def q_to_event_time_formats(spark, sf_dir):
    times = events_to_times(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts"))
    return times.select("seq", "timestamp", fmt(to_event_time("timestamp")).alias("event_time"))


def q_timeframe_minutes(spark, sf_dir):
    return _accepted(spark, sf_dir).select("seq", timeframe_minutes("event_time").alias("timeframe"))


def q_correlation_id(spark, sf_dir):
    return _parsed(spark, sf_dir, True).select("seq", correlation_id("body").alias("correlation_id"))


# -- extractors over free text: whole ``documents``, every row --------------------

def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def q_document_timestamp(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", body_timestamp("text").alias("body_timestamp"))


def q_document_severity(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", severity_word("text").alias("severity_word"),
                                            body_severity("text").alias("body_severity"))


def q_document_info(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", body_info("text").alias("body_info"))


def q_document_correlation_id(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", correlation_id("text").alias("correlation_id"))


# -- time boxes and fan-out ---------------------------------------------------

def _fanned(spark, sf_dir):
    return fan_out(_accepted(spark, sf_dir).select("seq", "event_time"))


def q_remaining_ttl(spark, sf_dir):
    return _fanned(spark, sf_dir).select(
        "seq", "horizon_id", remaining_ttl("event_time", F.col("horizon_s"), AS_OF).alias("ttl_s"))


def q_in_period(spark, sf_dir):
    return _fanned(spark, sf_dir).select(
        "seq", "horizon_id", age_seconds("event_time", AS_OF).alias("age_s"),
        in_period("event_time", F.col("horizon_s"), AS_OF).alias("in_period"))


def q_horizon_fanout(spark, sf_dir):
    return _fanned(spark, sf_dir).select("seq", "horizon_id", "horizon_s")


# -- table families -----------------------------------------------------------

def q_node_rows(spark, sf_dir):
    r = node_rows(_accepted(spark, sf_dir), AS_OF)
    return r.select(*NODE_KEYS, "seq", "ttl_s", fmt("expires_at").alias("expires_at"))


def q_service_rows(spark, sf_dir):
    r = service_rows(_accepted(spark, sf_dir), AS_OF)
    return r.select(*SERVICE_KEYS, "seq", "ttl_s", fmt("expires_at").alias("expires_at"))


def _stack(spark, sf_dir):
    return stack_rows(_accepted(spark, sf_dir), AS_OF)


def q_stack_rows(spark, sf_dir):
    return _stack(spark, sf_dir).select("id", "region", "loglevel", "service", "timeframe", "tfhours", "ttl_s", "seq")


def q_stack_lookup_24h(spark, sf_dir):
    # only the wanted horizon is fanned out
    s = stack_rows(_accepted(spark, sf_dir), AS_OF, horizons=[h for h in HORIZONS if h[0] == "24h"])
    return s.select("region", "loglevel", "service", "timeframe", "tfhours", "ttl_s",
                                                "seq")


def q_stack_ttl_left(spark, sf_dir):
    return ttl_left(_stack(spark, sf_dir), READ_AT).select("id", "seq", "ttl_left")


def _raw(spark, sf_dir):
    return raw_rows(_accepted(spark, sf_dir))


def q_raw_rows(spark, sf_dir):
    return _raw(spark, sf_dir).withColumn("log_ts", fmt("log_ts"))


def q_raw_latest(spark, sf_dir):
    latest = latest_by_key(_raw(spark, sf_dir), RAW_KEYS, ["seq"])
    return latest.select(*RAW_KEYS, "node_type", fmt("log_ts").alias("log_ts"), "payload", "seq")


def q_raw_limit(spark, sf_dir):
    # LIMIT 10 of the stored raw rows, in arrival order (top-k, no global sort)
    return _raw(spark, sf_dir).orderBy("seq").limit(10).withColumn("log_ts", fmt("log_ts"))


def _replayed(builder, spark, sf_dir):
    """Rows as if each was ingested when it happened (``ingest_ts = event_time``), read at ``AS_OF``."""
    return builder(recent(_accepted(spark, sf_dir), AS_OF), F.col("event_time"))


def q_node_live(spark, sf_dir):
    r = live(_replayed(node_rows, spark, sf_dir), AS_OF)
    return r.select(*NODE_KEYS, "seq", fmt("expires_at").alias("expires_at"))


def q_service_live(spark, sf_dir):
    r = live(_replayed(service_rows, spark, sf_dir), AS_OF)
    return r.select(*SERVICE_KEYS, "seq", fmt("expires_at").alias("expires_at"))


def q_node_counts(spark, sf_dir):
    return counts(_replayed(node_rows, spark, sf_dir), AS_OF, NODE_KEYS)


def q_service_counts(spark, sf_dir):
    return counts(_replayed(service_rows, spark, sf_dir), AS_OF, SERVICE_KEYS)


# -- sequence patterns ----------------------------------------------------------

def _alerts(spark, sf_dir, pattern, key):
    a = match_sequence(_accepted(spark, sf_dir), pattern)
    return a.select(key, F.col("first.seq").alias("first_seq"), F.col("second.seq").alias("second_seq"),
                    fmt("first.event_time").alias("first_time"), fmt("second.event_time").alias("second_time"))


def q_alerts_consecutive(spark, sf_dir):
    return _alerts(spark, sf_dir, consecutive_errors(), "service")


def q_alerts_consecutive_2h(spark, sf_dir):
    return _alerts(spark, sf_dir, consecutive_errors(120 * MINUTES), "service")


def q_alerts_correlated(spark, sf_dir):
    return _alerts(spark, sf_dir, correlated_create_vm(), "correlation_id")


def q_alerts_correlated_any(spark, sf_dir):
    return _alerts(spark, sf_dir, correlated_create_vm(contiguity="any"), "correlation_id")


def q_alerts_correlated_2h(spark, sf_dir):
    return _alerts(spark, sf_dir, correlated_create_vm(120 * MINUTES), "correlation_id")


def q_alerts_correlated_any_2h(spark, sf_dir):
    return _alerts(spark, sf_dir, correlated_create_vm(120 * MINUTES, "any"), "correlation_id")


def q_alerts_correlated_strict(spark, sf_dir):
    return _alerts(spark, sf_dir, correlated_create_vm(contiguity="strict"), "correlation_id")


def q_alert_text(spark, sf_dir):
    a = match_sequence(_accepted(spark, sf_dir), correlated_create_vm())
    return a.select(F.col("first.seq").alias("first_seq"), F.col("second.seq").alias("second_seq"),
                    alert_text_col("first", "second").alias("alert_text"))


# patterns of more steps, and conditions across rows

def _chain(spark, sf_dir, pattern, key):
    a = match_sequence(_accepted(spark, sf_dir), pattern)
    names = ("first", "second", "third")[:len(pattern.steps)]
    return a.select(*[key] * bool(key), *[F.col("events")[k]["seq"].alias(f"{n}_seq") for k, n in enumerate(names)],
                    *[fmt(F.col("events")[k]["event_time"]).alias(f"{n}_time") for k, n in enumerate(names)])


def _level(name):
    return F.col("level") == name


def q_alerts_chain_strict(spark, sf_dir):
    return _chain(spark, sf_dir, consecutive_chain(3), "service")


def q_alerts_chain_next(spark, sf_dir):
    steps = (Step("warned", _level("WARNING")), Step("failed", _level("ERROR")), Step("recovered", _level("INFO")))
    return _chain(spark, sf_dir, ChainPattern(steps, 10 * MINUTES, key=(("hostname", F.col("hostname")),)), "hostname")


def q_alerts_chain_mixed(spark, sf_dir):
    # an ERROR, later a WARNING, and right after that an INFO, over all rows in one order
    steps = (Step("failed", _level("ERROR")), Step("warned", _level("WARNING")), Step("recovered", _level("INFO"), "strict"))
    return _chain(spark, sf_dir, ChainPattern(steps, 20 * MINUTES), None)


def q_alerts_escalation(spark, sf_dir):
    return _chain(spark, sf_dir, escalation(), "hostname")


def q_alerts_spreading(spark, sf_dir):
    return _chain(spark, sf_dir, spreading_error(), "service")


def q_alerts_spreading_recovered(spark, sf_dir):
    # an ERROR, the service's earliest ERROR on another host, then the earliest INFO on the first host
    first, second = spreading_error().steps
    host = F.col("hostname")
    steps = (first, second, Step("recovered", _level("INFO"), compare=Compare("=", host, host)))
    return _chain(spark, sf_dir, ChainPattern(steps, 120 * MINUTES, key=(("service", F.col("service")),)), "service")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
