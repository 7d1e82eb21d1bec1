"""Deterministic adapter: the driver's ``events`` table -> syslog JSON lines.

One line per event, ``seq = event_id``. The rules (see FIXTURES.md section 3)
are plain column expressions, so the adapter is a single narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logweave.functions._util import literal_map
from logweave.schema import SEVERITY_CODES
from logweave.sources.balance import rebalance

# Fixed values of the adapter.
EVENT_LEVELS = {"error": "ERROR", "view": "WARNING", "click": "INFO", "signup": "NOTICE", "purchase": "DEBUG"}
SERVICES = ("Nova", "Neutron", "Keystone", "Cinder")
CONSTANT_FIELDS = {"spriority": "13", "protocol": "UDP", "port": "5514", "sender": "/10.20.30.40", "facility": "1"}
# Corruption rules by event_id divisor; the first that applies wins.
NOT_JSON, NO_SEVERITY_KEY, NO_BRACKET, NO_BODY_TIME, BAD_LEVEL_WORD = 97, 89, 83, 79, 73
EMPTY_TIME, ISO_TIME, NEWLINE_BODY = 50, 7, 61
CORRELATION_GROUP = 64


def _s(c: Column) -> Column:
    return c.cast("string")


def events_to_lines(events: DataFrame) -> DataFrame:
    """``events`` -> ``(seq bigint, value string)`` syslog JSON lines."""
    eid = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    level = F.element_at(literal_map(EVENT_LEVELS), F.col("event_type"))
    code = F.element_at(literal_map(SEVERITY_CODES), level)
    service = F.element_at(F.array(*[F.lit(s) for s in SERVICES]), (eid % 4 + 1).cast("int"))
    corr = _s(F.call_function("div", eid, F.lit(CORRELATION_GROUP)))
    ts_ms = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")
    head = F.concat(F.lower(service), F.lit(" - - - "))
    tail_user = F.concat(F.lit("user="), _s(F.col("user_id")))
    kind = (F.when(eid % NOT_JSON == 0, F.lit("bad_json"))
            .when(eid % NO_SEVERITY_KEY == 0, F.lit("missing_field"))
            .when(eid % NO_BRACKET == 0, F.lit("no_bracket"))
            .when(eid % NO_BODY_TIME == 0, F.lit("no_body_time"))
            .when(eid % BAD_LEVEL_WORD == 0, F.lit("bad_word"))
            .otherwise(F.lit("ok")))
    word = F.when(kind == "bad_word", F.lit("OVERHEATED")).otherwise(level)
    sep = F.when(eid % NEWLINE_BODY == 0, F.lit("\n")).otherwise(F.lit(" "))
    body = (
        F.when(kind == "no_bracket",
               F.concat(head, ts_ms, F.lit(" "), _s(eid), F.lit(" "), level,
                        F.lit(" mod.name ( Synthetic log CEP_ID="), corr, F.lit(" ) "), tail_user))
        .when(kind == "no_body_time",
              F.concat(head, _s(eid), F.lit(" "), level,
                       F.lit(" mod.name [ Synthetic log CEP_ID="), corr, F.lit(" ] "), tail_user))
        .otherwise(F.concat(head, ts_ms, F.lit(" "), _s(eid), F.lit(" "), word,
                            F.lit(" mod.name [ Synthetic log CEP_ID="), corr, F.lit(" ]"), sep, tail_user))
    )
    severity = (F.when(kind == "missing_field", F.lit(None).cast("string"))
                .when(eid % 2 == 1, code).otherwise(F.lit("5")))
    json_time = (F.when(eid % EMPTY_TIME == 0, F.lit(""))
                 .when(eid % ISO_TIME == 0,
                       F.concat(F.date_format(ts + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                                F.lit("+01:00")))
                 .otherwise(ts_ms))
    record = F.struct(
        severity.alias("severity"), body.alias("body"),
        F.lit(CONSTANT_FIELDS["spriority"]).alias("spriority"),
        F.concat(F.lit("host_"), _s(F.col("user_id") % 3)).alias("hostname"),
        F.lit(CONSTANT_FIELDS["protocol"]).alias("protocol"),
        F.lit(CONSTANT_FIELDS["port"]).alias("port"),
        F.lit(CONSTANT_FIELDS["sender"]).alias("sender"),
        service.alias("service"), _s(eid).alias("id"),
        F.lit(CONSTANT_FIELDS["facility"]).alias("facility"),
        json_time.alias("timestamp"),
    )
    value = F.when(kind == "bad_json", F.concat(F.lit("#corrupt line "), _s(eid), F.lit(" {severity"))) \
        .otherwise(F.to_json(record))
    return events.select(eid.alias("seq"), value.alias("value"))


# Fixed values of the adapter: how event ``i`` spells its time, by ``i % 10`` (9: no readable time).
# The offsets are those of the zone in which the time is told.
TIME_SPELLINGS = (
    ("yyyy-MM-dd HH:mm:ss.SSS", 0, ""),
    ("yyyy-M-d H:m:s.SSS", 0, ""),
    ("yyyy-MM-dd HH:mm:ss", 0, ""),
    ("MMM dd yyyy HH:mm:ss", 0, ""),
    ("MMM d yyyy H:m:s", 0, ""),
    ("yyyy/M/d H:m:s.SSS", 0, ""),
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", 60, "+01:00"),
    ("yyyy-M-d'T'H:m:s.SSSSSS", -150, "-0230"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", 0, "UTC"),
)


def events_to_times(events: DataFrame) -> DataFrame:
    """``events`` -> ``(seq bigint, timestamp string)``: every time format the parser takes, and unreadable ones."""
    eid, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    kind = eid % (len(TIME_SPELLINGS) + 1)
    text = F.concat(F.lit("about noon, day "), _s(eid % 28))
    for i, (spelling, minutes, zone) in enumerate(TIME_SPELLINGS):
        told = F.date_format(ts + F.make_interval(mins=F.lit(minutes)), spelling)
        text = F.when(kind == i, F.concat(told, F.lit(zone))).otherwise(text)
    return events.select(eid.alias("seq"), text.alias("timestamp"))


def read_event_lines(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Read ``events.parquet`` under ``sf_dir`` and adapt it to syslog lines.

    ``partitions`` rebalances its four columns first (STR5), for a table of few large row groups.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    return events_to_lines(rebalance(events, "event_id", partitions) if partitions else events)
