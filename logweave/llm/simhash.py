"""Operator 5, SimHash near-dedup by anchor points of a covering code.

The 64 fingerprint bits are cut into segments, each with a perfect code: two Golay [23,12] codes
(covering radius 3) and six repetition [3,1] codes (radius 1). Anchors are the product code's
words. Every fingerprint has one home anchor (the nearest word of each segment) and is replicated
to every anchor within covering radius plus threshold, measured by segment: the excess of each
segment's distance over its radius, summed, is at most the threshold. If t lies within the
threshold of s, the excess of t from s's home is at most the threshold, so t is replicated there
and the pair is compared at that anchor, and at no other. About 115 replicas at threshold 2;
2^30 anchors. Only distinct fingerprints are replicated, so copies cost one row.

Defined cases: a null or empty text has fingerprint zero and is linked like any other. A null
doc_id joins its component but never names it unless all ids there are null. Repeated rows are
returned each, by ``keep_one`` once. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, one_of_each, python_ready, stage, text_buffer
from .components import components

SEED = 42
#: Generator polynomial of the binary Golay code (fixed value).
GOLAY = 0b101011100011


def _fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[:len(words) - shingle] + 1).tolist()]
    ends = [*gaps[shingle - 1:].tolist(), len(joined)]
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for lo in range(0, n, 65536):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[lo:lo + 65536], ends[lo:lo + 65536])], np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column(2))
            fp = np.array([_fingerprint(buf[a:b].tobytes(), shingle) for a, b in zip(off[:-1], off[1:])], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_key", "fp"])
    return run


class Segment:
    """A linear binary code: ``columns`` holds the syndrome of each bit, ``radius`` its covering radius."""

    def __init__(self, columns: list[int], radius: int, threshold: int):
        self.bits = bits = len(columns)
        self.tables = []  # syndrome of each byte, to be combined by exclusive or
        for lo in range(0, bits, 8):
            table = np.zeros(256, np.int64)
            for k, column in enumerate(columns[lo:lo + 8]):
                table[np.arange(256) >> k & 1 == 1] ^= column
            self.tables.append(table)
        patterns = [np.zeros(1, np.int64)]  # error patterns by weight
        single = 1 << np.arange(bits, dtype=np.int64)
        for _ in range(radius + threshold):
            grown = (patterns[-1][:, None] | single[None, :])[single[None, :] > patterns[-1][:, None]]
            patterns.append(np.unique(grown))
        errors = np.concatenate(patterns)
        cost = np.repeat([max(0, w - radius) for w in range(len(patterns))], [len(p) for p in patterns])
        of = self.syndrome(errors)
        #: by[c]: (first, last, patterns): for each syndrome the patterns of excess c.
        self.by = []
        for c in range(threshold + 1):
            pick = np.flatnonzero(cost == c)
            pick = pick[np.argsort(of[pick], kind="stable")]
            edges = np.searchsorted(of[pick], np.arange(int(of.max()) + 2))
            self.by.append((edges[:-1], edges[1:], errors[pick]))

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for k, table in enumerate(self.tables):
            out ^= table[x >> 8 * k & 255]
        return out

    def words(self, x: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, code word) for each code word at excess ``c`` of each x."""
        first, last, errors = self.by[c]
        s = self.syndrome(x)
        n = last[s] - first[s]
        row = np.repeat(np.arange(len(x)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[s], n)
        return row, x[row] ^ errors[at]


@lru_cache(maxsize=4)
def covering_code(threshold: int) -> tuple[Segment, ...]:
    """23 + 23 + 6 x 3 bits make 64 (one Golay code twice, the repetition code six times)."""
    columns, rest = [], 1  # powers of x modulo the generator polynomial
    for _ in range(23):
        columns.append(rest)
        rest = rest << 1 ^ (GOLAY if rest >> 10 & 1 else 0)
    golay = Segment(columns, 3, threshold)
    triple = Segment([1, 3, 2], 1, threshold)
    return (golay, golay, *[triple] * 6)


def anchors(fp: np.ndarray, threshold: int, home: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for each anchor within covering radius plus threshold; or the home anchors only."""
    code, rest = covering_code(threshold), fp.view(np.uint64)
    row, anchor, spent = np.arange(len(fp)), np.zeros(len(fp), np.uint64), np.zeros(len(fp), np.int64)
    shift = 0
    for seg in code:
        part = (rest >> np.uint64(shift) & np.uint64((1 << seg.bits) - 1)).astype(np.int64)
        found = []
        for c in range(1 if home else threshold + 1):
            live = np.flatnonzero(spent + c <= (0 if home else threshold))
            k, word = seg.words(part[row[live]], c)
            found.append((row[live][k], anchor[live][k] | word.astype(np.uint64) << np.uint64(shift), spent[live][k] + c))
        row, anchor, spent = (np.concatenate(x) for x in zip(*found))
        shift += seg.bits
    return row, anchor.view(np.int64)


def _anchored(threshold: int, home: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo in range(0, len(fps), 2048):
                fp = fps[lo:lo + 2048]
                row, anchor = anchors(fp, threshold, home)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[row])], ["anchor", "fp"])
    return run


def links(fps: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fps(fp long)`` at ``threshold`` bits or fewer, once each."""
    slim = fps.select("fp")
    home = slim.mapInArrow(_anchored(threshold, True), "anchor long, a long").withColumnRenamed("fp", "a")
    near = slim.mapInArrow(_anchored(threshold, False), "anchor long, b long")
    return home.join(near, "anchor").where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold).select("a", "b")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_key, fp) of each row."""
    python_ready(docs.sparkSession)
    return keyed(docs).mapInArrow(_fingerprints(shingle), "doc_id long, text_key long, fp long")


def _rooted(docs: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """(doc_id, text_key, fp, component_id, root): the root tells components of one name apart."""
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    comp = components(links(distinct, threshold))
    named = distinct.join(comp, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(names, "root").select(F.col("fp").alias("_fp"), "component_id", "root")
    return prints.join(by_fp, F.col("fp") == F.col("_fp")).select("doc_id", "text_key", "fp", "component_id", "root")


def near_dedup(docs: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """(doc_id, text_key, fp, component_id) of each row; fingerprints within ``threshold`` bits are linked."""
    return _rooted(docs, shingle, threshold).select("doc_id", "text_key", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """One row of ``docs`` for each component: of the doc_id that names it (null if all ids there are null)."""
    judged = _rooted(docs, shingle, threshold).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    judged = judged.groupBy("root").agg(F.max("doc_id").alias("_id"), F.min("text_key").alias("_key")).select("_id", "_key")
    return one_of_each(docs, judged, F.xxhash64)
