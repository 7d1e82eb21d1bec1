"""The driver queries ``opN_<name>`` and, where SQL expresses them, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, divergence, exact, licenses, merkle, packing, pieces, quality, sharding, simhash, sql, substring, suffix, urls
from .common import documents

SHARD_BYTES = 1 << 20
LENGTH, END_ID = 2048, 1
URL_RULES = [urls.rule_of(*r) for r in (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))]
SHINGLE, BITS = 3, 2
WINDOW, BYTES = 50, 400
MIN_DOCS, TOP_TERMS = 10, 10


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), SHARD_BYTES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), LENGTH, END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return urls.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_dedup(documents(spark, sf_dir), SHINGLE, BITS)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir))
    return judged.select("doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), digest=True)
    return out.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.substring_dedup(documents(spark, sf_dir), WINDOW)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.suffix_dedup(documents(spark, sf_dir), BYTES)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir), MIN_DOCS, TOP_TERMS)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), digest=True)
    return out.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0
    out = merkle.manifest(docs, F.when(tampered, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"]))
    proof = F.array_join(F.transform("path", lambda step: F.concat(step["before"], step["after"])), "")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), F.col("version_root").alias("folded_root"),
                      (F.col("version_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_packing, op3_urls, op4_exact_dedup, op5_simhash, op6_quality, op7_licenses, op8_bpe, op9_substring, op10_suffix_array,
                              op11_divergence, op12_pieces, op13_merkle)
}
SQL = {"op1_sharding": sql.op1(SHARD_BYTES), "op3_urls": sql.op3(URL_RULES), "op4_exact_dedup": sql.OP4, "op6_quality": sql.op6(), "op7_licenses": sql.op7(),
       "op11_divergence": sql.op11(MIN_DOCS, TOP_TERMS), "op13_merkle": sql.op13()}
