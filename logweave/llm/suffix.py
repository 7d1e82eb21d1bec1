"""Operator 10, dedup of repeated byte strings by a difference cover, with hash grouping for the sort.

The dealt method sorts sampled tuples, recurses on their names, merges the other suffixes in and compares
adjacent prefixes. Here only the first ``length`` bytes of a suffix decide, and only whether they occur again,
not in which order they stand; so equal prefixes are brought together by their hash instead of a sort. A full
sort by modulus 3 would send two thirds of all positions, at 16 bytes each, through the shuffle: over ten times the
text (calculated). What is kept of the method is the difference cover: modulus 273 with 17 residues
(any two positions have a common shift below 273 that puts both on sampled residues).

1. The 128 = 400 - 272 bytes at each sampled position are hashed (their name), and names that occur once are
   dropped: no repeat passes through such a sample.
2. Two equal prefixes share a sampled position with equal names within their first 272 bytes. So the suffixes
   that matter are those up to 272 bytes before a repeated name; their full prefixes are hashed and grouped.
3. Bytes under a prefix that begins twice or more anywhere are removed.

There is no recursion, as a name and its shift span the whole prefix. Texts that stand in the table more than
once are named once. Prefixes count as equal if their 64-bit hashes are, after equal names of a shared sample;
their bytes are not compared.

Defined cases: a null or empty text has no bytes. A null doc_id is a document like any other, as
are repeated rows (copies of each other). Texts below ``length`` bytes lose nothing. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .common import is_document, keyed, python_ready, release, stage, text_buffer
from .substring import covered

#: A perfect difference set modulo 273 (fixed value).
MODULUS = 273
COVER = (1, 2, 4, 8, 16, 32, 64, 91, 117, 128, 137, 182, 195, 205, 234, 239, 256)
#: Step 2 takes the prefixes in turns, by hash, so that no more than half of them wait on disk at once.
TURNS = 2


def _offsets(off: np.ndarray, length: int, step: np.ndarray | None):
    """Buffer places, rows and positions of windows of ``length`` bytes (at the cover's residues if given)."""
    n = np.maximum(np.diff(off) - length + 1, 0)
    if step is not None:
        periods = -(-n // MODULUS)
        row = np.repeat(np.arange(len(n)), periods)
        k = np.arange(len(row)) - np.repeat(np.cumsum(periods) - periods, periods)
        pos = (k[:, None] * MODULUS + step[None, :]).reshape(-1)
        row = np.repeat(row, len(step))
        inside = pos < n[row]
        row, pos = row[inside], pos[inside]
    else:
        row = np.repeat(np.arange(len(n)), n)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return off[row] + pos, row, pos


def _names(length: int, n: int):
    """Sampled names; the ones met twice in this task are settled, each name is sent once."""
    depth, step = length - MODULUS + 1, np.array(COVER)

    def windows(buf, off, *_):
        at, row, pos = _offsets(off, depth, step)
        return X.Rolling(buf)(at, at + depth), row, pos

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, doc, pos, ids, keys in X.hashed(batches, windows):
            yield from _once(h, doc, pos, ids, keys, n, False)
    return run


def _once(h, doc, pos, ids, keys, n: int, wide: bool) -> Iterator[pa.RecordBatch]:
    order, starts = X.runs(h)
    twice, sent = np.zeros(len(h), bool), np.zeros(len(h), bool)
    twice[order] = X.per_entry(starts, len(h), np.diff(np.append(starts, len(h))) > 1)
    sent[order[starts]] = True
    for mark, through in ((sent, False), (twice, True)):
        k = np.flatnonzero(mark)
        if len(k):
            yield X.pack(h[k], doc[k], pos[k], ids, keys, n, wide, np.full(len(k), through))


def _twice(rem: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Equal neighbours in sorted order."""
    order, starts = X.runs(rem)
    keep = np.zeros(len(rem), bool)
    keep[order] = X.per_entry(starts, len(rem), np.diff(np.append(starts, len(rem))) > 1)
    return keep


def _merge(length: int, n: int, turn: int):
    """Full prefixes of the suffixes up to a modulus before a repeated name, the turn's share of them."""
    def windows(buf, off, batch, lo, hi):
        at, row, pos = [], [], []
        for k, packed in enumerate(batch.column("_pos").slice(lo, hi - lo).to_pylist()):
            last = int(off[k + 1] - off[k]) - length
            if last >= 0:
                marked = np.zeros(last + 2, np.int64)  # a name at p marks p - 272 to p
                p = X.positions(packed)
                p = p[p - MODULUS + 1 <= last]
                np.add.at(marked, np.maximum(p - MODULUS + 1, 0), 1)
                np.add.at(marked, np.minimum(p, last) + 1, -1)
                own = np.flatnonzero(np.cumsum(marked[:last + 1]) > 0)
                pos.append(own)
                row.append(np.full(len(own), k))
                at.append(own + off[k])
        if not at:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, row, pos = map(np.concatenate, (at, row, pos))
        h = X.Rolling(buf)(at, at + length)
        mine = h % np.uint64(TURNS) == turn
        return h[mine], row[mine], pos[mine]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, doc, pos, ids, keys in X.hashed(batches, windows, 4 << 20):
            yield from _once(h, doc, pos, ids, keys, n, True)
    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            copies, packed = batch.column(2).to_pylist(), batch.column(3)
            out: list[tuple] = []
            for k, (a, b) in enumerate(zip(off[:-1], off[1:])):
                own = buf[a:b]
                if copies[k] > 1:
                    gone = np.full(len(own), len(own) >= length)
                else:
                    gone = covered(X.positions(b"".join(packed[k].as_py() or [])), length, len(own))
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                out.append((len(own), int(gone.sum()), [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])], own[~gone].tobytes()))
            cols = list(zip(*out)) or [(), (), (), ()]
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], spans), pa.array(cols[3], pa.binary())],
                                             ["doc_id", "n_bytes", "n_removed", "spans", "kept"])
    return run


def suffix_dedup(docs: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of each row: removed byte ranges and the bytes left."""
    if length < MODULUS + 32:
        raise ValueError(f"length must be {MODULUS + 32} at least")
    spark = docs.sparkSession
    python_ready(spark)
    own = X.identified(keyed(docs))
    n = X.buckets(own)
    size = F.octet_length("text").alias("_size")
    copies = own.select("doc_id", "text_key", size).groupBy("text_key", "_size").agg(F.count("*").alias("_copies"), F.min("doc_id").alias("_least"))
    copies = stage(copies.where("_copies > 1"), "copies")
    names = X.exchange(own.mapInArrow(_names(length, n), X.ENTRY), _twice, False, n)
    # of a text in many rows, the smallest doc_id names the suffixes for all
    names = names.join(copies, (names["_key"] == copies["text_key"]), "left").where("_least is null or _id = _least").select("_id", "_key", "_pos")
    names = stage(names.dropDuplicates(["_id", "_key"]), "names")
    release(spark)
    once = own.join(names, (own["doc_id"] == names["_id"]) & (own["text_key"] == names["_key"])).select("doc_id", "text_key", "text", "_pos")
    found = None
    for turn in range(TURNS):
        some = stage(X.exchange(once.mapInArrow(_merge(length, n, turn), X.ENTRY), _twice, True, n), "prefixes")
        release(spark)
        found = some if found is None else found.unionByName(some)
    found = found.groupBy("_id", "_key").agg(F.collect_list("_pos").alias("_pos"))
    marks = found.withColumn("_copies", F.lit(1).cast("long"))
    text = F.coalesce(docs["text"], F.lit(""))
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"), F.octet_length(text).alias("_size"))
    many = copies.select(F.col("text_key").alias("_many"), F.col("_size").alias("_many_size"), "_copies")
    placed = slim.join(marks.select("_id", "_key", "_pos"), F.coalesce(slim["doc_id"], F.lit(X.NO_ID)).eqNullSafe(F.col("_id")) & (slim["text_key"] == F.col("_key")), "left")
    placed = placed.join(many, (F.col("text_key") == F.col("_many")) & (F.col("_size") == F.col("_many_size")), "left")
    return placed.select("doc_id", "text", F.coalesce("_copies", F.lit(1)).alias("_copies"), "_pos").mapInArrow(
        _cut(length), "doc_id long, n_bytes long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept binary")
