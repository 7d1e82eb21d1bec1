"""Writers for the four table families and the alert stream (SNK1-SNK11).

Tables are plain Parquet directories partitioned by their lookup key (``id``
for the horizon tables, ``date`` for raw rows), so a read by key prunes
partitions. TTL is modelled with ``expires_at`` and the read-side ``live``
view; last-write-wins with ``latest_by_key``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logweave.functions.render import alert_text, chain_text
from logweave.sinks.commitlog import TableLog

TABLE_PARTITIONS = {"node_rows": ["id"], "service_rows": ["id"], "stack_rows": ["id"], "raw_rows": ["date"]}


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "append",
                fmt: str = "parquet", options: dict | None = None) -> None:
    """Append (default) a table family to ``path`` (SNK1-SNK4)."""
    w = df.write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_micro_batch(df: DataFrame, path: str, batch_id: int, partition_by: list[str] | None = None,
                      fmt: str = "parquet") -> None:
    """Idempotent write of one micro-batch into a plain table of one writer: a replayed batch id replaces its own folders.

    Batch ids of two checkpoints would clash here; the streaming job uses ``commitlog.write_batch``.

    The lookup key is the outer partition and the batch the inner one (``id=24h/batch_id=7``), so a
    read of one key lists that key's folders only (``read_partition``). What an earlier try of the
    batch left is deleted first, also below keys that the replay no longer yields.
    """
    parts = partition_by or []
    spark = df.sparkSession
    own = "/".join([path.rstrip("/"), *("*" for _ in parts), f"batch_id={int(batch_id)}"])
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(pattern) or []:
        if not fs.delete(found.getPath(), True):
            raise OSError(f"could not replace {found.getPath().toString()}")
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).write.mode("append").format(fmt)
     .partitionBy(*parts, "batch_id").save(path))


def read_partition(spark: SparkSession, path: str, key: str, value: str, fmt: str = "parquet") -> DataFrame:
    """Stored rows of one lookup key (RD1): only the folders (with a commit log: files) of that key are listed and read."""
    log = TableLog(spark, path)
    if log.exists():
        return log.read({key: value})
    base = path.rstrip("/")
    return spark.read.option("basePath", base).format(fmt).load(f"{base}/{key}={value}")


def merge_latest(df: DataFrame, path: str, keys: list[str], order: list[str],
                 partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Upsert into a keyed-latest table (SNK4b): last write wins per ``keys`` by ``order``.

    The stored table is read with the new rows' schema (partition values keep their text), and only
    if its folder exists: any other failure to read it surfaces, so stored rows are never taken for
    absent. A semi-join on the partition columns keeps the partitions that the new rows touch. The
    union is merged with ``latest_by_key`` (pre-aggregated), cut from the stored table by a reliable
    checkpoint in the shared checkpoint folder, and written back with dynamic partition overwrite.
    """
    from logweave.operators.retention import latest_by_key
    from logweave.session import ensure_checkpoint_dir

    spark = df.sparkSession
    parts = partition_by or []
    cols = df.columns
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    merged = df
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        stored = spark.read.schema(df.schema).format(fmt).load(path).select(*cols)
        if parts:
            stored = stored.join(df.select(*parts).distinct(), parts, "left_semi").select(*cols)
        merged = stored.unionByName(df)
    merged = latest_by_key(merged, keys, order).select(*cols)
    ensure_checkpoint_dir(spark)
    merged = merged.checkpoint(eager=True)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
     .partitionBy(*parts).save(path))


def write_keyed(df: DataFrame, path: str | None = None, *, target: T.StructType | None = None,
                columns: list[str] | None = None, ttl_s: int | None = None, fmt: str = "parquet",
                mode: str = "append", options: dict | None = None) -> DataFrame:
    """Write rows matched to a target table by name (SNK6) or by position (SNK7).

    * ``target``: columns are selected **by name** in the target's order (an object-mapper style insert);
    * ``columns``: the frame's columns are renamed **by position** (an explicit statement), optionally
      with a constant ``ttl_s``.

    Giving both is an error (SNK8). Returns the frame written; ``path=None`` only shapes it.
    """
    if target is not None and columns is not None:
        raise ValueError("give either a target schema (by name) or a column list (by position), not both")
    if target is None and columns is None:
        raise ValueError("a target schema or a column list is required")
    if target is not None:
        missing = [f.name for f in target.fields if f.name not in df.columns]
        if missing:
            raise ValueError(f"columns missing for the target: {missing}")
        out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
    else:
        if len(columns) != len(df.columns):
            raise ValueError(f"{len(columns)} column names for {len(df.columns)} values")
        out = df.toDF(*columns)
    if ttl_s is not None:
        out = out.withColumn("ttl_s", F.lit(int(ttl_s)))
    if path is not None:
        out.write.mode(mode).format(fmt).options(**(options or {})).save(path)
    return out


def _text_and_seqs(alerts: DataFrame):
    """The text of an alert (of two records, or of a chain's) and the numbers of its records."""
    if "events" in alerts.columns:
        return chain_text("events"), F.transform("events", lambda e: e["seq"])
    return alert_text("first", "second"), F.array(F.col("first.seq"), F.col("second.seq"))


def alerts_to_text(alerts: DataFrame, with_key: bool = False) -> DataFrame:
    """Alerts -> one ``value`` text column (PRS14).

    ``with_key`` adds a ``key`` that is the same for the same records, so a
    consumer of an at-least-once sink (Kafka) can drop an alert replayed after a failure.
    """
    text, seqs = _text_and_seqs(alerts)
    if not with_key:
        return alerts.select(text.alias("value"))
    return alerts.select(F.array_join(seqs.cast("array<string>"), "-").alias("key"), text.alias("value"))


def alerts_to_outbox(alerts: DataFrame) -> DataFrame:
    """Alerts -> ``seqs`` (the numbers of all its records: the key), ``alert_name``, ``value``."""
    text, seqs = _text_and_seqs(alerts)
    return alerts.select(seqs.alias("seqs"), "alert_name", text.alias("value"))


def write_alerts_kafka(alerts: DataFrame, bootstrap_servers: str, topic: str, options: dict | None = None):
    """Alert text to a Kafka topic (SNK5), keyed for de-duplication; a streaming frame returns the ``DataStreamWriter``."""
    out = alerts_to_text(alerts, with_key=True)
    w = out.writeStream if out.isStreaming else out.write
    w = w.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if out.isStreaming:
        return w
    w.save()
    return None


def write_alerts_text(alerts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Alert text to a text directory (SNK10). Written in parallel, one file per task, not one file."""
    alerts_to_text(alerts).write.mode(mode).text(path)


def print_rows(df: DataFrame, n: int, truncate: bool = False):
    """Print ``n`` rows (SNK9): ``show`` in batch, the console sink in streaming (``n`` of each micro-batch)."""
    if df.isStreaming:
        return df.writeStream.format("console").option("numRows", n).option("truncate", str(truncate).lower())
    df.show(n, truncate=truncate)
    return None
