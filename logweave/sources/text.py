"""Line-oriented text sources (SRC3, SRC5)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F


def _number_lines(batches):
    """Number the lines of each file split in the order the scan yields them (``mapInPandas``).

    A scan task reads its splits one after the other, so only the running count of the last
    split is carried from one Arrow batch to the next. A split's ``i``-th line starts at least
    ``i`` bytes into it, so ``start + i`` never reaches the numbers of the file's next split
    (a line that starts right on a split's end belongs to that split, hence the one added after the first).
    """
    last, seen = None, 0
    for pdf in batches:
        if pdf.empty:
            continue
        split = [pdf["base"], pdf["start"]]
        index = pdf.groupby(split, sort=False).cumcount()
        if last is not None:
            index = index + seen * ((pdf["base"] == last[0]) & (pdf["start"] == last[1]))
        last = (pdf["base"].iloc[-1], pdf["start"].iloc[-1])
        seen = int(index.iloc[-1]) + 1
        yield pd.DataFrame({"seq": pdf["base"] + pdf["start"] + (pdf["start"] > 0) + index, "value": pdf["value"]})


def read_lines(spark: SparkSession, path: str, streaming: bool = False, seq_col: str = "seq",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text file(s) as ``(seq, value)``.

    Batch: ``seq`` is ``monotonically_increasing_id`` over the scan: unique,
    and increasing in line order within a file split. Streaming: ``seq`` is a 62-bit
    hash of the file path plus the line's place in the file (split start and
    number in the split), so it increases in line order, also over identical lines
    and lines of equal time, and a replay gives the same value. Lines of different files
    with equal times have no defined order, as in the source; two files' numbers
    overlap only if their hashes are closer than a file's length in bytes.
    """
    if streaming:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        base = F.xxhash64(F.col("_metadata.file_path")).bitwiseAND(F.lit((1 << 62) - 1))
        df = reader.load(path).select(base.alias("base"), F.col("_metadata.file_block_start").alias("start"), "value")
        df = df.mapInPandas(_number_lines, "seq long, value string")
        return df.select(F.col("seq").alias(seq_col), "value")
    df = spark.read.text(path)
    return df.select(F.monotonically_increasing_id().alias(seq_col), F.col("value"))


def read_primitives(spark: SparkSession, path: str, cast: str = "string") -> DataFrame:
    """File of primitive values, one per line (SRC5)."""
    return spark.read.text(path).select(F.trim(F.col("value")).cast(cast).alias("value"))
