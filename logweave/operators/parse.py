"""Parse, validate and quarantine (PRS1, PRS2, FLT1, FLT2, FLT8).

All steps are narrow (no shuffle) and valid in batch and in streaming. The
JSON parse, the text extractors and the validation each sit behind a one-row
``inline`` (a Generate): Catalyst cannot push a filter through it, so a filter
on a derived column (``reject_reason``, the pattern key, ...) never re-runs the
costly expressions it depends on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logweave.functions.body import TIMESTAMP_PATTERN, body_info, body_severity
from logweave.functions.severity import accepted_level, severity_name
from logweave.functions.timeparse import parse_time_or_null
from logweave.schema import ACCEPTED_LEVELS, CORRUPT_COL, EPOCH_TEXT, LOG_ENTRY_WITH_CORRUPT, LOG_FIELDS

JSON_OPTIONS = {
    "allowUnquotedControlChars": "true",
    "columnNameOfCorruptRecord": CORRUPT_COL,
    "mode": "PERMISSIVE",
}


def _nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def parse_entries(lines: DataFrame, parse_body: bool = True, value_col: str = "value",
                  keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """JSON lines -> the 11-field record plus ``json_error`` (PRS1), optionally re-derived from the text (PRS2).

    ``json_error`` is ``bad_json`` for malformed text, ``missing_field`` when one of the
    11 keys is absent or null; unknown keys are ignored.
    """
    # The parse runs inside a Generate (``inline`` of a one-element array): filters on
    # the parsed fields cannot be pushed below it, so from_json runs once per line
    # instead of once in the pushed-down filter and again in the projection.
    rec = F.from_json(F.col(value_col), LOG_ENTRY_WITH_CORRUPT, JSON_OPTIONS)
    parsed = lines.select(*[F.col(k) for k in keep], F.col(value_col).alias("raw_value"),
                          F.inline(F.array(rec)))
    r = {f: F.col(f) for f in LOG_FIELDS}
    missing = reduce(lambda a, b: a | b, [r[f].isNull() for f in LOG_FIELDS])
    json_error = (F.when(F.col(CORRUPT_COL).isNotNull(), F.lit("bad_json"))
                  .when(missing, F.lit("missing_field")))
    if parse_body:
        body = r["body"]
        r["severity"] = F.when(body.isNotNull(), body_severity(body))
        # the raw first match; the epoch fallback is applied above, on the stored match
        r["timestamp"] = F.when(body.isNotNull(), F.regexp_extract(body, TIMESTAMP_PATTERN, 0))
        r["body"] = F.when(body.isNotNull(), body_info(body))
    ok = json_error.isNull()
    # again behind a Generate, so later filters on these fields do not re-run the extractors
    fields = F.struct(*[F.when(ok, r[f]).alias(f) for f in LOG_FIELDS], json_error.alias("json_error"))
    out = parsed.select(*[F.col(k) for k in keep], "raw_value", F.inline(F.array(fields)))
    if parse_body:
        ts = F.col("timestamp")
        out = out.withColumn("timestamp", F.when(ts == "", F.lit(EPOCH_TEXT)).otherwise(ts))
    return out


def validate(entries: DataFrame, accepted=ACCEPTED_LEVELS) -> DataFrame:
    """Add ``level``, ``event_time``, ``time_flag`` and ``reject_reason`` (FLT1, FLT2, FLT8, PRS8).

    Unparseable time is not a reject: it maps to epoch 0 and is flagged
    (``no_body_time`` for the epoch text, ``bad_time`` otherwise).
    """
    sev, ts, body = F.col("severity"), F.col("timestamp"), F.col("body")
    level = severity_name(sev)
    reason = (F.when(F.col("json_error").isNotNull(), F.col("json_error"))
              .when(~_nonempty(ts), F.lit("no_timestamp"))
              .when(~_nonempty(sev), F.lit("no_severity"))
              .when(~_nonempty(body), F.lit("no_info"))
              .when(level.isNull(), F.lit("unknown_severity"))
              .when(~accepted_level(level, accepted), F.lit("level_not_accepted")))
    # Computed inside a Generate (``inline`` of a one-element array), like the JSON parse:
    # a filter on ``reject_reason`` cannot be pushed below it, so the extractors and time
    # parsing it depends on run once per row instead of once in the filter and again in
    # the projection above it. The multi-format time parse is evaluated once and both the
    # event time and the flag are derived from it.
    derived = F.struct(level.alias("level"), parse_time_or_null(ts).alias("_parsed_time"),
                       reason.alias("reject_reason"))
    out = entries.select("*", F.inline(F.array(derived)))
    parsed_time = F.col("_parsed_time")
    event_time = F.when(_nonempty(ts), F.date_trunc("millisecond",
                                                    F.coalesce(parsed_time, F.timestamp_millis(F.lit(0)))))
    time_flag = (F.when(ts == EPOCH_TEXT, F.lit("no_body_time"))
                 .when(_nonempty(ts) & parsed_time.isNull(), F.lit("bad_time")))
    return out.select(*entries.columns, "level", event_time.alias("event_time"), time_flag.alias("time_flag"),
                      "reject_reason")


def accepted_entries(lines: DataFrame, parse_body: bool = True, accepted=ACCEPTED_LEVELS) -> DataFrame:
    """Rows that pass FLT1 and FLT2: ``seq``, the 11 fields, ``level``, ``event_time``, ``time_flag``."""
    v = validate(parse_entries(lines, parse_body), accepted)
    return v.where(F.col("reject_reason").isNull()).drop("raw_value", "json_error", "reject_reason")


def valid_entries(lines: DataFrame, parse_body: bool = True) -> DataFrame:
    """Rows that pass FLT1 only (fields non-empty), whatever their level."""
    v = validate(parse_entries(lines, parse_body))
    bad = ("bad_json", "missing_field", "no_timestamp", "no_severity", "no_info")
    return v.where(F.col("reject_reason").isNull() | ~F.col("reject_reason").isin(list(bad))) \
        .drop("raw_value", "json_error", "reject_reason")


def quarantine(lines: DataFrame, parse_body: bool = True, accepted=ACCEPTED_LEVELS) -> DataFrame:
    """Rejected rows with their reason and the original text (FLT8)."""
    v = validate(parse_entries(lines, parse_body), accepted)
    return v.where(F.col("reject_reason").isNotNull()).select("seq", "raw_value", "reject_reason")


def quarantine_counts(lines: DataFrame, parse_body: bool = True) -> DataFrame:
    return quarantine(lines, parse_body).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))
