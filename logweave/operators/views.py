"""The four table families written from accepted rows (PRS15-PRS18, SNK1-SNK4, RD8).

Each builder is a projection of ``accepted`` (plus one ``inline`` for the
horizon fan-out), so all four read one scan and stay in one codegen span.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from logweave.functions.timeparse import as_of_column, date_piece, in_period, remaining_ttl, timeframe_minutes
from logweave.operators.retention import fan_out, live, with_expiry, within_horizon
from logweave.schema import HORIZONS


@dataclass(frozen=True)
class Placement:
    """Constant columns stamped on every row (PRS12)."""
    az: str = "az1"
    region: str = "boston"


def _row_key(*cols: str):
    return F.xxhash64(*[F.col(c) for c in cols])


def _stamp(rows: DataFrame, ingest_ts) -> DataFrame:
    """Expiry from ``ingest_ts`` (processing time, or ``event_time`` for a replay), then the row key."""
    return with_expiry(rows, ingest_ts).drop("event_time").withColumn("row_key", _row_key("id", "seq"))


def node_rows(accepted: DataFrame, ingest_ts, place: Placement = Placement(), horizons=HORIZONS) -> DataFrame:
    """Per-node rows, one per horizon, TTL = horizon (PRS15, SNK1).

    ``ingest_ts``: the write time the TTL counts from: a literal / ``current_timestamp()``
    (as written by a live job) or ``F.col("event_time")`` to replay history as if each
    row had been written when it happened.
    """
    rows = fan_out(accepted.select("seq", "level", "hostname", "event_time"), horizons).select(
        F.col("horizon_id").alias("id"), F.col("level").alias("loglevel"), F.lit(place.az).alias("az"),
        F.lit(place.region).alias("region"), F.col("hostname").alias("node_type"), "seq",
        F.col("horizon_s").alias("ttl_s"), "event_time")
    return _stamp(rows, ingest_ts)


def service_rows(accepted: DataFrame, ingest_ts, place: Placement = Placement(), horizons=HORIZONS) -> DataFrame:
    """Per-service rows, one per horizon, TTL = horizon (PRS16, SNK2)."""
    rows = fan_out(accepted.select("seq", "level", "service", "event_time"), horizons).select(
        F.col("horizon_id").alias("id"), F.col("level").alias("loglevel"), F.lit(place.az).alias("az"),
        F.lit(place.region).alias("region"), "service", "seq", F.col("horizon_s").alias("ttl_s"), "event_time")
    return _stamp(rows, ingest_ts)


def stack_rows(accepted: DataFrame, as_of, place: Placement = Placement(), horizons=HORIZONS) -> DataFrame:
    """Time-boxed service rows: in-period filter, minute of day, per-row TTL (PRS17, SNK3).

    ``as_of`` is the single processing instant used both for the period test and
    the TTL (a literal in batch, ``current_timestamp()`` in a micro-batch).
    """
    base = accepted.select("seq", "level", "service", "timestamp", "event_time")
    # a row outside the longest horizon is outside every horizon: drop it before the fan-out
    base = base.where(in_period("event_time", max(s for _, s in horizons), as_of))
    rows = within_horizon(fan_out(base, horizons), as_of).select(
        F.col("horizon_id").alias("id"), F.lit(place.region).alias("region"), F.col("level").alias("loglevel"),
        "service", timeframe_minutes("event_time").alias("timeframe"), F.col("timestamp").alias("tfhours"),
        "ttl_s", "seq")
    return with_expiry(rows, as_of).withColumn("row_key", _row_key("id", "seq"))


def raw_rows(accepted: DataFrame, place: Placement = Placement(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Dated raw rows, no TTL (PRS18, SNK4); ``date`` is the unpadded day text. ``keep``: columns passed on as they are."""
    return accepted.select(
        date_piece("event_time").alias("date"), F.lit(place.region).alias("region"),
        F.col("level").alias("loglevel"), "service", F.col("hostname").alias("node_type"),
        F.col("event_time").alias("log_ts"), F.col("body").alias("payload"), "seq", *keep)


def table_counts(time_col: str, as_of, where, horizons=HORIZONS) -> list:
    """Row counts of the four families as aggregates over the rows for which ``where`` holds (UDF2).

    They follow from the builders' own rules without the fan-out: one node and service row per
    horizon, a stack row for each horizon that ``within_horizon`` keeps, one raw row.
    """
    t = F.col(time_col)
    n = F.count(F.when(where, 1))
    boxed = reduce(lambda a, b: a + b, [
        F.when(in_period(t, s, as_of) & (remaining_ttl(t, s, as_of) > 0), 1).otherwise(0) for _, s in horizons])
    return [(n * len(horizons)).alias("node_rows"), (n * len(horizons)).alias("service_rows"),
            F.coalesce(F.sum(F.when(where, boxed)), F.lit(0)).alias("stack_rows"), n.alias("raw_rows")]


def recent(accepted: DataFrame, read_at, horizons=HORIZONS) -> DataFrame:
    """Rows that can still be live at ``read_at`` when replayed with ``ingest_ts = event_time``.

    A row older than the longest horizon has expired in every horizon; dropping it
    before the fan-out saves generating six rows that ``live`` would discard.
    """
    longest = max(s for _, s in horizons)
    cutoff = F.unix_millis(as_of_column(read_at)) - F.lit(longest * 1000)
    return accepted.where(F.unix_millis(F.col("event_time")) > cutoff)


def counts(rows: DataFrame, read_at, keys: list[str]) -> DataFrame:
    """Live rows counted per counter key (RD8). Partial aggregation before the shuffle."""
    return live(rows, read_at).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


NODE_KEYS = ["id", "loglevel", "az", "region", "node_type"]
SERVICE_KEYS = ["id", "loglevel", "az", "region", "service"]
RAW_KEYS = ["date", "service", "loglevel", "region"]
