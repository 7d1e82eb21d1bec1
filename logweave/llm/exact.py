"""Operator 4, exact dedup by content-defined chunk recipes.

A document is cut where a rolling gear hash of the last 32 bytes hits a pattern, so equal texts are
cut alike whatever precedes them. A chunk's identifier is its seeded 128-bit XXH3. Identifiers are
verified: each distinct (identifier, chunk bytes) pair crosses the network once, and if any
identifier stands for two byte strings the corpus is keyed anew with the next seed. A document is
then the ordered list of its verified identifiers, and lists (one 64th of the text) are compared in
full. Only recipes meet; recipes that more than a thousandth of the rows have are sent to the rows, so
no group of copies gathers in one task. ``keep_one`` then looks the kept rows up by (doc_id, SHA-256).

Defined cases: a null text is the empty text (an empty recipe; all empty texts are equal). A null
doc_id never wins over a number; a group of null ids only has a null ``keep_id``. Rows repeating
both doc_id and text count in ``group_size`` and share one decision; ``keep_one`` returns one of
them. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import one_of_each, python_ready, slices, stage, text_buffer

MIN_CHUNK, MAX_CHUNK, CUT_BITS = 256, 8192, 10
#: Text that a task hashes at once; its distinct chunks leave together.
SLICE_BYTES = 2 << 20
#: A recipe is hot if one row in so many has it: at most so many recipes are.
HOT, HOT_BYTES = 1000, 4096
_GEAR = np.random.default_rng(20240229).integers(0, 2**32, 256, dtype=np.uint32)


def _cuts(buf: np.ndarray) -> np.ndarray:
    """Positions after which a cut is allowed: gear hash of the last 32 bytes, built by doubling."""
    h = _GEAR[buf]
    for s in (1, 2, 4, 8, 16):
        if len(h) > s:
            h[s:] += h[:-s] << np.uint32(s)
    return np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1


def _chunk_ends(cuts: list[int], lo: int, hi: int) -> list[int]:
    ends, start = [], lo
    while start < hi:
        k = bisect_left(cuts, start + MIN_CHUNK)
        end = min(cuts[k] if k < len(cuts) else hi, start + MAX_CHUNK, hi)
        ends.append(end)
        start = end
    return ends


def _slices(batch: pa.RecordBatch) -> Iterator[list[tuple[bytes, list[tuple[int, int]]]]]:
    """Text and chunk bounds of the rows of each slice. The first cut is 256 bytes in, past the hash's reach."""
    buf, off = text_buffer(batch.column(batch.schema.get_field_index("text")))
    for lo, hi in slices(off, SLICE_BYTES):
        part = buf[off[lo]:off[hi]]
        cuts, raw, o = _cuts(part).tolist(), part.tobytes(), (off[lo:hi + 1] - off[lo]).tolist()
        out = []
        for a, b in zip(o, o[1:]):
            ends = _chunk_ends(cuts, a, b)
            out.append((raw[a:b], [(s - a, e - a) for s, e in zip([a, *ends], ends)]))
        yield out


def _chunks(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _slices(batch):
                seen: dict[bytes, bytes] = {}
                clash = []
                for text, bounds in rows:
                    for s, e in bounds:
                        chunk = text[s:e]
                        key = xxhash.xxh3_128_digest(chunk, seed)
                        if seen.setdefault(key, chunk) != chunk:
                            clash.append((key, chunk))  # two texts under one key: both must be seen
                pairs = [*seen.items(), *clash]
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*pairs)], ["key", "chunk"])
    return run


def _recipes(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recipe, sha = [], []
            for rows in _slices(batch):
                for text, bounds in rows:
                    recipe.append(b"".join([xxhash.xxh3_128_digest(text[s:e], seed) for s, e in bounds]))
                    sha.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(recipe, pa.binary()), pa.array(sha)], ["doc_id", "recipe", "sha"])
    return run


def chunk_seed(docs: DataFrame, first: int = 0, attempts: int = 8) -> int:
    """The first seed under which no identifier stands for two different chunks."""
    for seed in range(first, first + attempts):
        pairs = docs.select("text").mapInArrow(_chunks(seed), "key binary, chunk binary").groupBy("key", "chunk").agg(F.lit(1).alias("one"))
        if pairs.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
            return seed
    raise RuntimeError(f"chunk identifiers collided under {attempts} seeds")


def _recipes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, recipe, sha) of each row, staged; texts stay behind."""
    python_ready(docs.sparkSession)
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return stage(own.mapInArrow(_recipes(chunk_seed(own)), "doc_id long, recipe binary, sha string"), "recipes")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row: of equal texts the largest doc_id stays."""
    rows = _recipes_of(docs)
    groups = stage(rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    groups = groups.withColumnRenamed("recipe", "same")
    # the few recipes that many rows have are sent to the rows: at most HOT of them, of HOT_BYTES each
    hot = F.broadcast(groups.where((F.col("group_size") * HOT > rows.count()) & (F.octet_length("same") <= HOT_BYTES)))
    out = rows.join(hot, F.col("recipe") == F.col("same"), "left")
    found = out.where("same is not null").drop("same").unionByName(
        out.where("same is null").drop("same", "keep_id", "group_size").join(groups, F.col("recipe") == F.col("same")).drop("same"))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each text: of the largest doc_id, and one of the rows that repeat it or have none."""
    kept = _recipes_of(docs).groupBy("recipe").agg(F.max("doc_id").alias("_id"), F.first("sha").alias("_key")).select("_id", "_key")
    return one_of_each(docs, kept, lambda text: F.sha2(text, 256))
