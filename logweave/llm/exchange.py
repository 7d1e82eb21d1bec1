"""Finding equal windows across a corpus: rolling hashes, packed exchange, one judgement a bucket.

A task hashes the windows of some megabytes of text, merges equal ones (pre-aggregation: a window
that a third of all documents share leaves a task once), and writes the rest as packed rows, one
for each hash bucket: documents, positions as small differences, hashes. Rows of a bucket meet in
one group, whose size follows from the number of buckets and not from the data's skew; the judge
decides there which entries are returned. Nothing is capped or sampled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTRY = "bucket int, docs binary, counts binary, pos binary, rem binary"
HITS = "part int, docs binary, counts binary, pos binary"
#: Stands for a null doc_id in the exchange.
NO_ID = -2**63
#: Bytes of text behind one bucket, and behind one packed row's task slice.
BUCKET_BYTES, SLICE_BYTES, HASH_BYTES = 32 << 20, 16 << 20, 2 << 20

_rng = np.random.default_rng(977)
_TABLE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(2**62, 2**63)) | 1
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64, up to n."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            step = np.full(n + 1, np.uint64(base))
            step[0] = 1
            _powers[k] = np.multiply.accumulate(step)
    return _powers


class Rolling:
    """Hashes of any windows of a byte buffer, from one pass of prefix sums."""

    def __init__(self, buf: np.ndarray):
        up, self.down = _powers_to(len(buf))
        self.prefix = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_TABLE[buf] * up[:len(buf)], out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.prefix[ends] - self.prefix[starts]) * self.down[starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ h >> np.uint64(32)


def buckets(docs: DataFrame) -> int:
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_BYTES))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first index of each run of equal values in that order)."""
    order = np.argsort(values, kind="stable")
    v = values[order]
    return order, np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.int64)


def per_entry(starts: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    """A value of each run, repeated for its entries (in run order)."""
    return np.repeat(values, np.diff(np.append(starts, n)))


def _parts(ids: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """The part of each document, by id and text: copies of a text under many ids spread over all parts."""
    h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ keys.astype(np.int64).view(np.uint64)
    for _ in range(2):
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def pack(h: np.ndarray, doc: np.ndarray, pos: np.ndarray, ids: np.ndarray, keys: np.ndarray, n: int, wide: bool,
         settled: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of entries in (doc, pos) order; those in ``settled`` go straight to their document's part, without hashes."""
    if settled is None:
        settled = np.zeros(len(h), bool)
    bucket = ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)
    group = np.where(settled, n + _parts(ids, keys, n)[doc], bucket)
    order = np.argsort(group, kind="stable")
    group, doc, pos, h = group[order], doc[order], pos[order], h[order]
    head = np.concatenate([[True], (doc[1:] != doc[:-1]) | (group[1:] != group[:-1])]) if len(doc) else np.zeros(0, bool)
    step = np.diff(pos, prepend=0)
    step[head] = pos[head]
    heads = np.flatnonzero(head)
    who = np.stack([ids[doc[heads]], keys[doc[heads]]], axis=1).astype("<i8")
    count = np.diff(np.append(heads, len(doc))).astype("<u4")
    edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(group) else np.zeros(1, np.int64)
    cols: list[list] = [[], [], [], [], []]
    for a, b in zip(edges[:-1], edges[1:]):
        i, j = np.searchsorted(heads, [a, b])
        g, s = int(group[a]), step[a:b]
        cols[0].append(g % n)
        cols[1].append(who[i:j].tobytes())
        cols[2].append(count[i:j].tobytes())
        cols[3].append(s.astype("<u2" if s.max() < 65536 else "<u4").tobytes())
        cols[4].append(b"" if g >= n else h[a:b].astype("<u8").tobytes() if wide else (h[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], ["bucket", "docs", "counts", "pos", "rem"])


def _unpack(table: pa.Table, dtype: str):
    """Of the rows with hashes (True) and without (False): documents, entries of each, positions, hashes."""
    parts: dict[bool, list] = {True: [], False: []}
    for docs, counts, pos, rem in zip(*(table.column(c).to_pylist() for c in ("docs", "counts", "pos", "rem"))):
        count = np.frombuffer(counts, "<u4").astype(np.int64)
        total = int(count.sum())
        step = np.frombuffer(pos, "<u2" if len(pos) == 2 * total else "<u4").astype(np.int64)
        run = np.cumsum(step)
        first = np.cumsum(count) - count
        parts[len(rem) > 0].append((np.frombuffer(docs, "<i8").reshape(-1, 2), count, run - np.repeat(run[first] - step[first], count), np.frombuffer(rem, dtype)))
    return {k: tuple(map(np.concatenate, zip(*v))) if v else None for k, v in parts.items()}


def _hits(who: np.ndarray, count: np.ndarray, pos: np.ndarray, keep: np.ndarray, n: int) -> list[tuple[int, bytes, bytes, bytes]]:
    """The kept entries as one packed row for each part of the documents."""
    kept = np.add.reduceat(keep, np.cumsum(count) - count, dtype=np.int64) if len(keep) else np.zeros(0, np.int64)
    part = _parts(who[:, 0], who[:, 1], n)
    of_entry = np.repeat(part, kept)
    pos = pos[keep][np.argsort(of_entry, kind="stable")].astype("<u4")
    order = np.argsort(part, kind="stable")
    order = order[kept[order] > 0]
    who, kept, part = np.ascontiguousarray(who[order]), kept[order], part[order]
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, np.int64)
    at = np.concatenate([[0], np.cumsum(kept)])
    return [(int(part[a]), who[a:b].astype("<i8").tobytes(), kept[a:b].astype("<u4").tobytes(), pos[at[a]:at[b]].tobytes()) for a, b in zip(edges[:-1], edges[1:])]


def _merged(table: pa.Table) -> pa.Table:
    """One row for each document of a part, with all its positions."""
    cols = [b"".join(table.column(c).to_pylist()) for c in ("docs", "counts", "pos")]
    who, count, pos = np.frombuffer(cols[0], "<i8").reshape(-1, 2), np.frombuffer(cols[1], "<u4").astype(np.int64), np.frombuffer(cols[2], "<u4")
    docs, row = np.unique(who, axis=0, return_inverse=True)
    row = np.repeat(row.reshape(-1), count)
    order = np.argsort(row, kind="stable")
    edge = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(docs)))])
    pos = pos[order]
    return pa.table([pa.array(docs[:, 0], pa.int64()), pa.array(docs[:, 1], pa.int64()),
                     pa.array([pos[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())], ["_id", "_key", "_pos"])


def exchange(entries: DataFrame, judge: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], wide: bool, n: int) -> DataFrame:
    """(_id, _key, _pos): the positions of the entries that ``judge(hashes, doc ids, positions)`` keeps,
    one row for each document. Hits leave a bucket packed by parts of the documents, ``n`` in all."""
    def run(table: pa.Table) -> pa.Table:
        parts = _unpack(table, "<u8" if wide else "<u4")
        out = []
        if parts[True]:
            who, count, pos, rem = parts[True]
            out += _hits(who, count, pos, judge(rem, np.repeat(who[:, 0], count), pos), n)
        if parts[False]:
            who, count, pos, _ = parts[False]
            out += _hits(who, count, pos, np.ones(len(pos), bool), n)
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.table([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], ["part", "docs", "counts", "pos"])
    return entries.groupBy("bucket").applyInArrow(run, HITS).groupBy("part").applyInArrow(_merged, "_id long, _key long, _pos binary")


def positions(packed: bytes | None) -> np.ndarray:
    return np.unique(np.frombuffer(packed, "<u4")).astype(np.int64) if packed else np.zeros(0, np.int64)


def identified(docs: DataFrame) -> DataFrame:
    """``keyed`` documents with null ids replaced for the exchange."""
    return docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))


def hashed(batches: Iterator[pa.RecordBatch], windows: Callable, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """(hashes, doc rows, positions, ids, keys) of some megabytes of documents at a time.

    ``windows(buf, offsets, batch, lo, hi)`` gives the first three for rows lo to hi. Of rows that
    repeat both id and text, a slice yields the first only: the others would say the same again.
    """
    from .common import slices, text_buffer
    for batch in batches:
        buf, off = text_buffer(batch.column(2))
        ids, keys = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
        for lo, hi in slices(off, limit):
            parts = []
            for a, b in slices(off[lo:hi + 1], HASH_BYTES):
                h, doc, pos = windows(buf[off[lo + a]:off[lo + b]], off[lo + a:lo + b + 1] - off[lo + a], batch, lo + a, lo + b)
                parts.append((h, doc + lo + a, pos))
            h, doc, pos = map(np.concatenate, zip(*parts))
            _, first = np.unique(np.stack([ids[lo:hi], keys[lo:hi]], axis=1), axis=0, return_index=True)
            if len(first) < hi - lo:
                own = np.isin(doc, first + lo)
                h, doc, pos = h[own], doc[own], pos[own]
            if len(h):
                yield h, doc, pos, ids, keys
