"""Kafka topic as a stream of text lines (SRC1, SRC2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


ARRIVAL = ("arrival_ts", "arrival_partition", "arrival_offset")


def kafka_lines(raw: DataFrame) -> DataFrame:
    """Kafka rows -> ``(seq, value)`` and the arrival columns.

    ``seq`` is the record's unique number and breaks ties of equal event time;
    ``ARRIVAL`` (record time, partition, offset) is the order of writes across partitions.
    """
    seq = F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")
    return raw.select(seq.alias("seq"), F.col("value").cast("string").alias("value"),
                      F.col("timestamp").alias("arrival_ts"), F.col("partition").alias("arrival_partition"),
                      F.col("offset").alias("arrival_offset"))


def read_kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str, streaming: bool = True,
                     options: dict | None = None) -> DataFrame:
    """Subscribe to ``topic``. Needs the Spark Kafka connector on the classpath."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("subscribe", topic)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return kafka_lines(reader.load())
