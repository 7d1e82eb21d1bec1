"""Rebalance an input over the cluster (STR5)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rebalance(df: DataFrame, key: str | None = None, partitions: int | None = None) -> DataFrame:
    """Spread the rows evenly, whatever the input's size: over ``partitions`` tasks, or as many as AQE finds right for the bytes.

    For an input whose files or topic partitions split it badly: one shuffle of its columns. The caller asks
    for it; no reader of this package does so by itself. With a unique ``key`` the rows are distributed by it,
    which is the same under task retries without the local sort that a round-robin repartition needs.
    """
    by = [key] if key else []
    return df.repartition(partitions, *by) if partitions else df.hint("rebalance", *by)
