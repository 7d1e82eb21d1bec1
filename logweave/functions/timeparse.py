"""Event time and the time arithmetic of the retention views (PRS8-PRS11, FLT3)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

from logweave.functions._util import col

# Accepted time formats, tried strictly in this order.
# (Spark spellings of the source formats; one-letter fields take one or two digits,
# the two ISO forms parse a six-digit fraction with an offset, with or without its
# colon, or a zone name.)
TIME_FORMATS = (
    "yyyy-M-d H:m:s.SSS",
    "yyyy-M-d H:m:s",
    "MMM dd yyyy H:m:s",
    "MMM d yyyy H:m:s",
    "yyyy/M/d H:m:s.SSS",
    "yyyy-M-d'T'H:m:s.SSSSSS[xxx][xx]",
    "yyyy-M-d'T'H:m:s.SSSSSSz",
)


def parse_time_or_null(text: "str | Column", formats=TIME_FORMATS) -> Column:
    t = col(text)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats])


def to_event_time(text: "str | Column", formats=TIME_FORMATS) -> Column:
    """First format that parses, truncated to ms; epoch 0 when none does (PRS8)."""
    parsed = parse_time_or_null(text, formats)
    return F.date_trunc("millisecond", F.coalesce(parsed, F.timestamp_millis(F.lit(0))))


def as_of_column(as_of) -> Column:
    """``as_of`` as a timestamp column: a Column, a datetime, or text."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(str(as_of)))


def age_seconds(event_time: "str | Column", as_of) -> Column:
    """Whole seconds from the event to ``as_of``, truncated toward zero (PRS10 / FLT3)."""
    diff = F.unix_millis(as_of_column(as_of)) - F.unix_millis(col(event_time))
    return F.call_function("div", diff, F.lit(1000))


def remaining_ttl(event_time: "str | Column", horizon_s: "int | Column", as_of) -> Column:
    """Horizon seconds minus the age in whole seconds (PRS10), as int."""
    h = horizon_s if isinstance(horizon_s, Column) else F.lit(horizon_s)
    return (h - age_seconds(event_time, as_of)).cast("int")


def in_period(event_time: "str | Column", horizon_s: "int | Column", as_of) -> Column:
    """0 <= age <= horizon: a row less than 1 s in the future has age 0 and passes (FLT3)."""
    h = horizon_s if isinstance(horizon_s, Column) else F.lit(horizon_s)
    return age_seconds(event_time, as_of).between(F.lit(0), h)


def timeframe_minutes(event_time: "str | Column") -> Column:
    """Minute of the day, hour*60 + minute (PRS9)."""
    t = col(event_time)
    return (F.hour(t) * 60 + F.minute(t)).cast("int")


def date_piece(event_time: "str | Column") -> Column:
    """Unpadded ``yyyy-M-d`` date text of the raw table (PRS11)."""
    return F.date_format(col(event_time), "yyyy-M-d")
