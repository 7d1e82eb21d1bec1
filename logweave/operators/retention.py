"""Horizon fan-out, row expiry and keyed latest views (FAN1, FLT3/4, RD3, RD5, RD6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logweave.functions.timeparse import as_of_column, in_period, remaining_ttl
from logweave.schema import HORIZONS


def horizon_column(horizons=HORIZONS) -> Column:
    return F.array(*[F.struct(F.lit(h).alias("horizon_id"), F.lit(s).alias("horizon_s")) for h, s in horizons])


def fan_out(df: DataFrame, horizons=HORIZONS) -> DataFrame:
    """One row per horizon: a single ``inline`` of a literal array (no join, no shuffle)."""
    return df.select("*", F.inline(horizon_column(horizons)))


def within_horizon(df: DataFrame, as_of, time_col: str = "event_time") -> DataFrame:
    """Fanned-out rows whose age is in ``[0, horizon]`` and whose remaining TTL is positive (FLT3, FLT4)."""
    t, h = F.col(time_col), F.col("horizon_s")
    return (df.where(in_period(t, h, as_of))
              .withColumn("ttl_s", remaining_ttl(t, h, as_of))
              .where(F.col("ttl_s") > 0))


def with_expiry(df: DataFrame, ingest_ts, ttl_col: str = "ttl_s") -> DataFrame:
    """Add ``ingest_ts`` and ``expires_at = ingest_ts + ttl`` (the effect of ``USING TTL``)."""
    ing = as_of_column(ingest_ts)
    return df.withColumn("ingest_ts", ing).withColumn(
        "expires_at",
        F.timestamp_micros(F.unix_micros(F.col("ingest_ts")) + F.col(ttl_col).cast("long") * 1000000))


def live(df: DataFrame, read_at) -> DataFrame:
    """Rows not yet expired at ``read_at`` (RD6)."""
    return df.where(F.col("expires_at") > as_of_column(read_at))


def ttl_left(df: DataFrame, read_at, alias: str = "ttl_left") -> DataFrame:
    """Whole seconds a stored row has left at ``read_at`` (``TTL(col)``, RD3); only live rows."""
    r = as_of_column(read_at)
    left = F.call_function("div", F.unix_millis(F.col("expires_at")) - F.unix_millis(r), F.lit(1000))
    return live(df, read_at).withColumn(alias, left.cast("int"))


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last write wins per key (RD5).

    A ``max_by`` aggregate rather than a ``row_number`` window: it combines
    map-side before the shuffle, so a hot key costs one partial row per task
    instead of a whole group in one task.
    """
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), rank).alias("_last"))
    return agg.select(*keys, "_last.*")
