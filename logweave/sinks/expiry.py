"""Physical row expiry for the TTL tables (the storage side of ``USING TTL``).

Reads never see expired rows (``live``); this job reclaims their space. A
table written by micro-batches is partitioned by horizon ``id`` and
``batch_id``, and every row of such a partition was written at the same instant, so
whole partitions expire together. A table with a commit log holds each file's
latest ``expires_at`` there, and no data file is opened. For a plain table the job finds partitions whose latest
``expires_at`` has passed (an aggregate with one row per partition, combined
map-side) and deletes those directories; nothing else is rewritten.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession, functions as F

from logweave.functions.timeparse import as_of_column
from logweave.sinks.commitlog import TableLog, expire


def expired_partitions(spark: SparkSession, path: str, read_at, partition_cols: list[str]):
    """Partition values (one row each) whose rows have all expired at ``read_at``, as a DataFrame."""
    # with a schema, a table that has no files yet reads as empty and folder names keep their text
    names = ", ".join(f"`{c}` string" for c in partition_cols)
    df = spark.read.schema(f"{names}, expires_at timestamp").parquet(path)
    latest = df.groupBy(*partition_cols).agg(F.max("expires_at").alias("last_expiry"))
    return latest.where(F.col("last_expiry") <= as_of_column(read_at)).select(*partition_cols)


def drop_expired(spark: SparkSession, path: str, read_at, partition_cols: list[str] | None = None) -> int:
    """Delete expired partition directories under ``path`` (with a commit log: take expired files off); how many.

    Only names of partitions reach the driver; it deletes sixteen at a time.
    """
    if TableLog(spark, path).exists():
        at = spark.range(1).select(F.unix_micros(as_of_column(read_at))).first()[0]
        return expire(spark, path, at)
    cols = partition_cols or ["id", "batch_id"]
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)

    def drop(row) -> bool:
        sub = "/".join(f"{c}={row[c]}" for c in cols)
        target = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{sub}")
        return bool(fs.exists(target) and fs.delete(target, True))

    with ThreadPoolExecutor(16) as pool:
        return sum(pool.map(drop, expired_partitions(spark, path, read_at, cols).toLocalIterator()))
