"""Helpers shared by the operators: documents as Arrow buffers, document identity, staged tables.

A document row is identified by ``(doc_id, text_key)`` where ``text_key`` is Spark's XXH64 of the
text, so two rows that repeat a ``doc_id`` with different texts stay apart and rows that repeat
both are one document listed twice. A null text counts as the empty text everywhere.
"""

from __future__ import annotations

import gc
import time
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.session import ensure_checkpoint_dir, ship_package

#: The white space of the contracts' word pattern [^\x20\x09-\x0D]+ (also bytes.split()'s).
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame, *extra: str) -> DataFrame:
    """(doc_id, text_key, text, *extra) with null texts as empty; other columns are left behind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                       text.alias("text"), *extra)


def is_document(docs: DataFrame, judged: DataFrame):
    """Join condition of raw ``docs`` rows with ``judged(_id, _key)``; a null doc_id equals a null doc_id."""
    return (docs["doc_id"].cast("long").eqNullSafe(judged["_id"])
            & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == judged["_key"]))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame):
    """All columns as one struct column ``row``: beside it no name can clash, whatever ``docs`` calls its columns."""
    return F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row")


def unpacked(rows: DataFrame, docs: DataFrame, changed: dict | None = None) -> DataFrame:
    """The columns of ``docs`` from ``rows(row, ...)``, some with another value; types as they were."""
    changed = changed or {}
    return rows.select(*[(changed[f.name] if f.name in changed else F.col("row").getField(f.name)).cast(f.dataType).alias(f.name) for f in docs.schema.fields])


def one_of_each(docs: DataFrame, kept: DataFrame, key) -> DataFrame:
    """One row of ``docs`` for each of ``kept(_id, _key)``, ``key`` being a column of its text; a null id equals a null id.

    Rows that repeat both are merged in each task before they move, so a third of all rows in one such group costs
    a row a task; whole rows move once.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    where = lambda i: (i.isNull().alias("no_id"), F.coalesce(i, F.lit(0)).cast("long").alias("id"))
    rows = docs.select(whole_row(docs), *where(docs["doc_id"].cast("long")), key(text).alias("key"))
    rows = rows.groupBy("no_id", "id", "key").agg(F.first("row").alias("row"))
    kept = kept.select(*where(F.col("_id")), F.col("_key").alias("key"))
    return unpacked(rows.join(kept, ["no_id", "id", "key"], "left_semi"), docs)


def python_ready(spark: SparkSession) -> None:
    """Executors' Python workers import this package."""
    ship_package(spark)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage (a lost executor rereads files instead of recomputing the steps behind them)
    and computes shared inputs once. The folder is new for each call and is deleted when the
    application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps whose result is staged.

    The cleaner acts when the driver's JVM collects the unreachable plans, which on an idle driver
    may be half an hour away; the files would occupy the executors' disks until then.
    """
    for _ in range(2):  # the first frees Python's handles on the plans, the second the plans
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty. No copy per row."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off.astype(np.int64) - off[0]


def slices(offsets: np.ndarray, limit: int):
    """Row ranges of at most ``limit`` bytes of text (one row at least), to bound a task's memory."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
