"""Operator 9, substring dedup by fixed-block anchors.

A repeat of ``window`` words holds at least one whole block of half that length from the
reference's grid of non-overlapping blocks. So (1) every block is indexed by its hash and probed
with every rolling window of a block's length; hits are all positions of a hash that two entries
share, one of them a block. (2) Around the hits, in probing and reference documents alike, the
windows of full length are compared: that extends each hit to its maximal exact repeat, once for
each distinct window instead of once for each pair of documents. A window is removed if a document
with a smaller doc_id has it. (3) The removed words are cut from the documents.

Defined cases: a null or empty text has no words. Documents with a null doc_id neither lose words
nor count as references. Rows repeating a doc_id are compared with other doc_ids only. Windows never
cross documents. No rows give no rows. Windows are equal if their 64-bit hashes are, after a hit of
the blocks' own hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from . import exchange as X
from .common import keyed, python_ready, release, stage, text_buffer, unpacked, whole_row


def _words(buf: np.ndarray, off: np.ndarray, least: int):
    """One buffer of all words joined by blanks, their starts and ends, and each word's row."""
    raw, texts, rows, counts = buf.tobytes(), [], [], []
    for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        own = raw[a:b].split()
        if len(own) >= least:
            texts.append(b" ".join(own))
            rows.append(k)
            counts.append(len(own))
    joined = np.frombuffer(b" ".join(texts), np.uint8)
    gaps = np.flatnonzero(joined == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.append(gaps, len(joined))
    counts = np.array(counts, np.int64)
    row = np.repeat(np.array(rows, np.int64), counts)
    index = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return joined, starts, ends, row, index


def _rolling(buf: np.ndarray, off: np.ndarray, least: int, length: int):
    """Hash, row and word index of each window of ``length`` words in rows of ``least`` words or more."""
    joined, starts, ends, row, index = _words(buf, off, least)
    i = np.flatnonzero(row[:len(row) - length + 1] == row[length - 1:]) if len(row) >= length else np.zeros(0, np.int64)
    return X.Rolling(joined)(starts[i], ends[i + length - 1]), row[i], index[i]


def _probe(window: int, n: int):
    block = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, doc, pos, ids, keys in X.hashed(batches, lambda buf, off, *_: _rolling(buf, off, window, block)):
            order, starts = X.runs(h)
            size = np.diff(np.append(starts, len(h)))
            grid = pos[order] % block == 0
            anchored = X.per_entry(starts, len(h), np.logical_or.reduceat(grid, starts) & (size > 1))
            settled = np.zeros(len(h), bool)  # met inside this task: a hit wherever it stands
            settled[order] = anchored
            first = np.minimum.reduceat(np.where(grid, 0, len(h)) + np.arange(len(h)), starts) % len(h)  # a block if there is one
            sent = np.zeros(len(h), bool)
            sent[order[first]] = True
            for mark, through in ((sent, False), (settled, True)):
                k = np.flatnonzero(mark)
                if len(k):
                    yield X.pack(h[k], doc[k], pos[k], ids, keys, n, False, np.full(len(k), through))
    return run


def _anchored(block: int):
    def judge(rem: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> np.ndarray:
        order, starts = X.runs(rem)
        size = np.diff(np.append(starts, len(rem)))
        keep = np.zeros(len(rem), bool)
        keep[order] = X.per_entry(starts, len(rem), (size > 1) & np.logical_or.reduceat(pos[order] % block == 0, starts))
        return keep
    return judge


def _extend(window: int, n: int):
    """Full windows that hold a hit block: the smallest doc_id's are sent, later ones are settled."""
    block = window // 2

    def windows(buf, off, batch, lo, hi):
        h, row, pos = _rolling(buf, off, window, window)
        hit = [X.positions(x) for x in batch.column("_pos").slice(lo, hi - lo).to_pylist()]
        row_hits = np.repeat(np.arange(hi - lo), [len(x) for x in hit])
        place = np.sort(row_hits * (1 << 40) + np.concatenate(hit)) if len(row_hits) else np.zeros(0, np.int64)
        at = row * (1 << 40) + pos
        near = np.searchsorted(place, at) < np.searchsorted(place, at + (window - block), side="right")
        return h[near], row[near], pos[near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, doc, pos, ids, keys in X.hashed(batches, windows):
            order, starts = X.runs(h)
            own = ids[doc[order]]
            later = np.zeros(len(h), bool)
            later[order] = own > X.per_entry(starts, len(h), np.minimum.reduceat(own, starts))
            yield X.pack(h, doc, pos, ids, keys, n, True, later)
    return run


def _later(rem: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> np.ndarray:
    order, starts = X.runs(rem)
    keep = np.zeros(len(rem), bool)
    keep[order] = ids[order] > X.per_entry(starts, len(rem), np.minimum.reduceat(ids[order], starts))
    return keep


def covered(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which of n units lie under a window that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + window, n), -1)
    return np.cumsum(edge[:n]) > 0


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column(batch.schema.get_field_index("_words_of")))
            packed = batch.column(batch.schema.get_field_index("_pos"))
            n_words, n_removed, kept = [], [], []
            for k, (a, b) in enumerate(zip(off[:-1], off[1:])):
                own = buf[a:b].tobytes().split()
                starts = X.positions(packed[k].as_py())
                n_words.append(len(own))
                if len(starts):
                    gone = covered(starts, window, len(own))
                    own = [w for w, g in zip(own, gone.tolist()) if not g]
                n_removed.append(n_words[-1] - len(own))
                kept.append(b" ".join(own).decode())
            names = [c for c in batch.schema.names if c not in ("_words_of", "_pos")]
            cols = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept)],
                                             [*names, "_n_words", "_n_removed", "_kept"])
    return run


def repeated_windows(docs: DataFrame, window: int = 50) -> DataFrame:
    """(_id, _key, _pos): starts of the windows that a document with a smaller doc_id also has."""
    spark = docs.sparkSession
    python_ready(spark)
    own = keyed(docs).where("doc_id is not null")
    n = X.buckets(own)
    probes = own.mapInArrow(_probe(window, n), X.ENTRY)
    hits = stage(X.exchange(probes, _anchored(window // 2), False, n), "anchors")
    release(spark)
    near = own.join(hits, (own["doc_id"] == hits["_id"]) & (own["text_key"] == hits["_key"])).select("doc_id", "text_key", "text", "_pos")
    found = X.exchange(near.mapInArrow(_extend(window, n), X.ENTRY), _later, True, n)
    out = stage(found, "repeats")
    release(spark)
    return out


def _judged(docs: DataFrame, window: int, *columns) -> DataFrame:
    """``columns`` of each row of ``docs`` with _n_words, _n_removed and _kept."""
    if window < 2 or window % 2:
        raise ValueError("window must be even")
    found = repeated_windows(docs, window)
    rows = docs.select(*columns, docs["doc_id"].cast("long").alias("_own_id"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("_own_key"), docs["text"].alias("_words_of"))
    rows = rows.join(found, F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_key") == F.col("_key")), "left").drop("_own_id", "_own_key", "_id", "_key")
    kind = T.StructType([f for f in rows.schema.fields if f.name not in ("_words_of", "_pos")])
    return rows.mapInArrow(_cut(window), kind.add("_n_words", "long").add("_n_removed", "long").add("_kept", "string"))


def substring_dedup(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of each row; kept_text: the kept words joined by one blank."""
    out = _judged(docs, window, docs["doc_id"].cast("long").alias("doc_id"))
    return out.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.col("_kept").alias("kept_text"))


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` without repeated passages: a text that loses words is its other words, joined by blanks, and ``n_chars``
    follows; a document that loses all its words goes. Other columns are carried, whatever their names."""
    cut = _judged(docs, window, whole_row(docs)).where("_n_removed = 0 or _n_removed < _n_words")
    lost = F.col("_n_removed") > 0
    new = {"text": F.when(lost, F.col("_kept")).otherwise(F.col("row").getField("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(lost, F.length("_kept")).otherwise(F.col("row").getField("n_chars"))
    return unpacked(cut, docs, new)
