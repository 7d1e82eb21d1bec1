"""Record and alert text (SNK11, PRS14)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logweave.schema import LOG_FIELDS

# Alert text header and the separator of the per-record summary line.
ALERT_HEADER = "ErrorAlert: "
SUMMARY_SEPARATOR = "-"


def entry_json(prefix: str = "") -> Column:
    """Record as JSON in fixed key order; null fields written as ``""`` (SNK11).

    ``prefix`` selects fields of a struct column, e.g. ``"first."``.
    """
    return F.to_json(F.struct(*[F.coalesce(F.col(prefix + f), F.lit("")).alias(f) for f in LOG_FIELDS]))


def _summary(prefix: str) -> Column:
    return F.concat_ws(SUMMARY_SEPARATOR,
                       *[F.coalesce(F.col(prefix + f), F.lit("")) for f in ("service", "severity", "timestamp")])


def alert_text(first: str = "first", second: str = "second") -> Column:
    """Alert text: header, one summary line per record, both records as JSON, trailing newline (PRS14)."""
    return F.concat(
        F.lit(ALERT_HEADER + "\n"),
        _summary(first + "."), F.lit("\n"),
        _summary(second + "."), F.lit("\n"),
        entry_json(first + "."), F.lit("\n"),
        entry_json(second + "."), F.lit("\n"),
    )


def chain_text(events: str = "events") -> Column:
    """Alert text of a match of any number of records: header, the summary lines, the records as JSON."""
    field = lambda e, f: F.coalesce(e[f], F.lit(""))
    summary = lambda e: F.concat_ws(SUMMARY_SEPARATOR, *[field(e, f) for f in ("service", "severity", "timestamp")])
    record = lambda e: F.to_json(F.struct(*[field(e, f).alias(f) for f in LOG_FIELDS]))
    return F.concat(F.lit(ALERT_HEADER + "\n"), F.array_join(F.transform(events, summary), "\n"), F.lit("\n"),
                    F.array_join(F.transform(events, record), "\n"), F.lit("\n"))
