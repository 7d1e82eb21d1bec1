"""Operator 1, sharding by extendible hashing, in DataFrame functions only.

A document hashes to 60 bits of the MD5 of its doc_id. A bucket is a prefix of those bits; only a
bucket over the byte limit splits, on its next bit, until every shard fits. Bytes are summed once by
a prefix some bits longer than the expected depth and rolled up to all shorter prefixes, which gives
the directory (depth and prefix of every shard) without moving a document; buckets that need more
bits go through another such pass alone. What a pass decides is written once, so that asking whether
another is due does not work it out again. Documents find their shard by depth and prefix, so a shard
far deeper than the others costs no more than they do.

Defined cases: a null text has no bytes. A null doc_id hashes like the empty string. Rows that
repeat a doc_id hash alike and share a shard; a shard that holds a single hash value may exceed the
limit, as no bit splits it, and keeps the depth of the last bit tried. No rows give no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

BITS, STEP = 60, 6


def hash_bits(doc_id: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _prefix(h: Column, depth: Column | int) -> Column:
    return F.call_function("shiftright", h, F.lit(BITS) - depth)


def _roll_up(fine: DataFrame, low: int, high: int) -> DataFrame:
    """(depth, prefix, bytes, least, most) of every prefix of ``low`` to ``high`` bits."""
    levels = fine.select("bytes", "least", "most", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    return levels.groupBy("depth", _prefix(F.col("least"), F.col("depth")).alias("prefix")).agg(
        F.sum("bytes").alias("bytes"), F.min("least").alias("least"), F.max("most").alias("most"))


def directory(hashed: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, shard_bytes) of every shard of ``hashed(h long, n_bytes long)``, read from staged files."""
    total = hashed.agg(F.sum("n_bytes")).first()[0] or 0
    high = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + STEP)
    low, left, found = 0, hashed, []
    while True:
        fine = left.groupBy(_prefix(F.col("h"), high).alias("p")).agg(F.sum("n_bytes").alias("bytes"), F.min("h").alias("least"), F.max("h").alias("most"))
        levels = _roll_up(fine, low, high)
        over = (F.col("bytes") > limit) & (F.col("least") < F.col("most"))
        # a prefix is a bucket if the one before it was split; at the pass's first level it always is
        parents = levels.where(over).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("_parent"))
        made = levels.where(F.col("depth") == low).unionByName(
            levels.join(parents, (levels["depth"] == parents["depth"]) & (F.shiftright(levels["prefix"], 1) == parents["_parent"]), "left_semi"))
        split = over & (F.col("depth") == high)
        decided = stage(made.where(~over | split).select("depth", "prefix", F.col("bytes").alias("shard_bytes"), split.alias("split")), "directory")
        found.append(decided.where(~F.col("split")).drop("split"))
        rest = decided.where("split").select(F.col("prefix").alias("_split"))
        if high == BITS or rest.isEmpty():
            break
        left = left.join(rest, _prefix(F.col("h"), high) == F.col("_split"), "left_semi")
        low, high = high + 1, min(BITS, high + 1 + STEP)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def shard(docs: DataFrame, limit: int) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, shard_bytes) of each row; ``shard`` is the prefix in binary."""
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), hash_bits(F.col("doc_id")).alias("h"),
                         F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    shards = directory(hashed.select("h", "n_bytes"), limit)
    # a document meets its shard at one of the depths that occur, which are 61 at most
    depths = [r[0] for r in shards.select("depth").distinct().collect()] or [0]
    probes = hashed.withColumn("_depth", F.explode(F.array(*[F.lit(d) for d in sorted(depths)])))
    probes = probes.withColumn("_prefix", _prefix(F.col("h"), F.col("_depth")))
    return probes.join(shards, (F.col("_depth") == F.col("depth")) & (F.col("_prefix") == F.col("prefix"))).select(
        "doc_id", "n_bytes", F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))).alias("shard"),
        F.col("depth").cast("long").alias("depth"), "shard_bytes")
