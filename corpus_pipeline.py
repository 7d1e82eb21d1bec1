"""The training-corpus pipeline: quality rules, exact, near and substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from logweave.llm import exact, packing, quality, queries, simhash, substring
from logweave.llm.common import documents
from logweave.session import ensure_checkpoint_dir

#: Packing cannot be expressed in SQL (tokenizer, prefix sums over partitions); tests use brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; failing lines go from the others, and n_chars follows."""
    return quality.kept_and_cleaned(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row of the largest doc_id stays."""
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row of the smallest doc_id stays."""
    return simhash.keep_one(docs, queries.SHINGLE, queries.BITS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go; a document that loses some keeps the others, joined by blanks.

    A document that loses all its words goes.
    """
    return substring.without_repeats(docs, queries.WINDOW)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences, with their token ids."""
    return packing.pack(docs, queries.tokenizer_path("byte_bpe_50k.json"), queries.LENGTH, queries.END_ID)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. The stages' tables lie in a new shared folder, which goes when the application ends."""
    docs = documents(spark, sf_dir)
    home = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(home)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{home}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
