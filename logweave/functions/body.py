"""Extractors that recover severity, time and message from the log text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logweave.functions._util import col, literal_map
from logweave.schema import EPOCH_TEXT, SEVERITY_CODES

# Extraction patterns.
TIMESTAMP_PATTERN = r"[0-9]{4}-[0-9]{2}-[0-9]{2}\s[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}"
SEVERITY_PATTERN = r"[A-Z]{4,7}+"
INFO_PATTERN = r"\[.*"
CORRELATION_MARKER = "CEP_ID="


def body_timestamp(body: "str | Column") -> Column:
    """First ``yyyy-MM-dd HH:mm:ss.SSS`` in the text, else the epoch text (PRS3)."""
    # regexp_substr is null when nothing matches: one regex evaluation per row
    return F.coalesce(F.regexp_substr(col(body), F.lit(TIMESTAMP_PATTERN)), F.lit(EPOCH_TEXT))


def severity_word(body: "str | Column") -> Column:
    """First run of 4 to 7 capitals; only the first run counts."""
    return F.regexp_extract(col(body), SEVERITY_PATTERN, 0)


def body_severity(body: "str | Column") -> Column:
    """Syslog code of the first capitals run if it names a level, else ``''`` (PRS4)."""
    return F.coalesce(F.element_at(literal_map(SEVERITY_CODES), severity_word(body)), F.lit(""))


def body_info(body: "str | Column") -> Column:
    """Text from the first ``[`` to the end of that line, else ``''`` (PRS5)."""
    return F.regexp_extract(col(body), INFO_PATTERN, 0)


def correlation_id(body: "str | Column") -> Column:
    """Text after the first ``CEP_ID=`` up to whitespace or the next marker; null without one (PRS13)."""
    b = col(body)
    after = F.split_part(b, F.lit(CORRELATION_MARKER), F.lit(2))
    token = F.regexp_extract(after, r"^\S*", 0)
    return F.when(b.contains(CORRELATION_MARKER), token)
