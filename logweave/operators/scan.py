"""Ordered "next match" scan over a range-partitioned stream.

For every row that may start a match (``is_first``) find, in the same key and
in ``(t, seq)`` order:

* ``strict``: the immediately following row, if it may end a match (``is_second``);
* ``next``:   the earliest later row that may end a match.

and keep the pair when ``t2 - t1 < within_ms``.

Why not a window ``lead`` over ``partitionBy(key)``: that puts a whole key in
one task, and a single key (a service, a correlation id) may hold a third of
all rows. Here the rows are range-partitioned on ``(key, t, seq)``, which
samples the sort key and splits a hot key over many tasks. Each task scans its
sorted slice once (vectorised with numpy, batch by batch). Between batches strict
keeps one row; next keeps the first rows still waiting within the bound, as the
chunks they came in: all wait for the same row, so they are joined with it once.
Only the last key of a slice can continue into the next slice, so each task
emits its "open" rows (first rows still waiting at the slice end), one "head"
summary and at most one "marker"; a small window over heads and markers (two
rows per slice) finds each slice's continuation, and a window per slice hands
it to the open rows, which never leave their slice's partition.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

PAIR, OPEN, HEAD, MARK = "pair", "open", "head", "mark"


def _out_schema(key_fields: list[T.StructField]) -> T.StructType:
    return T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("pid", T.IntegerType())]
        + key_fields
        + [T.StructField(n, T.LongType()) for n in ("seq1", "t1", "seq2", "t2")]
        + [T.StructField("p1", T.StringType()), T.StructField("p2", T.StringType())]
        + [T.StructField("found", T.BooleanType()), T.StructField("only_key", T.BooleanType())]
    )


def _segments(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Segment number of each row: increases whenever any key column changes."""
    n = len(pdf)
    change = np.zeros(n, dtype=bool)
    for k in keys:
        a = pdf[k].to_numpy()
        if n > 1:
            change[1:] |= a[1:] != a[:-1]
    return np.cumsum(change)


def match_block(t: np.ndarray, is_first: np.ndarray, is_second: np.ndarray, seg: np.ndarray, mode: str,
                within_ms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches inside one block of rows sorted by ``(segment, t, seq)``.

    Returns ``(i, j, carry)``: first-row and second-row positions of each
    match, and the positions that must be carried into the next block of the
    same (last) segment: strict, the last row; next, the unmatched first rows
    of the last segment still within the bound of the block's end.
    """
    n = len(t)
    if n == 0:
        e = np.zeros(0, dtype=np.int64)
        return e, e, e
    if mode == "strict":
        i = np.flatnonzero(is_first[:-1] & is_second[1:] & (seg[:-1] == seg[1:]) & (t[1:] - t[:-1] < within_ms))
        return i, i + 1, np.array([n - 1])
    s_pos = np.flatnonzero(is_second)
    f_pos = np.flatnonzero(is_first)
    if len(s_pos) and len(f_pos):
        idx = np.searchsorted(s_pos, f_pos, side="right")
        j = s_pos[np.minimum(idx, len(s_pos) - 1)]
        same = (idx < len(s_pos)) & (seg[j] == seg[f_pos])
    else:
        j = np.zeros(len(f_pos), dtype=np.int64)
        same = np.zeros(len(f_pos), dtype=bool)
    hit, jj = f_pos[same], j[same]
    ok = t[jj] - t[hit] < within_ms
    rest = f_pos[~same]
    rest = rest[(seg[rest] == seg[n - 1]) & (t[n - 1] - t[rest] < within_ms)]
    return hit[ok], jj[ok], rest


def _rows(kind: str, pid: int, keys: list[str], kdf: pd.DataFrame, seq1=None, t1=None, seq2=None, t2=None,
          p1=None, p2=None, found=None, only_key=None) -> pd.DataFrame:
    n = len(kdf)
    out = {"kind": [kind] * n, "pid": np.full(n, pid, dtype=np.int32)}
    for k in keys:
        out[k] = kdf[k].to_numpy()
    none = pd.array([None] * n, dtype="Int64")
    out["seq1"] = none if seq1 is None else seq1
    out["t1"] = none if t1 is None else t1
    out["seq2"] = none if seq2 is None else seq2
    out["t2"] = none if t2 is None else t2
    nos = np.full(n, None, dtype=object)
    out["p1"] = nos if p1 is None else p1
    out["p2"] = nos if p2 is None else p2
    nob = pd.array([None] * n, dtype="boolean")
    out["found"] = nob if found is None else found
    out["only_key"] = nob if only_key is None else only_key
    return pd.DataFrame(out)


def _scan_factory(keys: list[str], mode: str, within_ms: int):
    cols = keys + ["t", "seq", "is_first", "is_second", "payload"]

    def scan(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        carry = None          # strict: the last row, carried to the next batch
        waiting = deque()     # next: chunks of first rows of the last key that wait for a second row
        head = None           # summary of the first key of this slice
        head_key = None
        only_key = True
        for pdf in batches:
            if len(pdf) == 0:
                continue
            pdf = pdf[cols]
            if head is None:
                first = pdf.iloc[[0]]
                head_key = tuple(first[k].iloc[0] for k in keys)
                if mode == "strict":
                    head = dict(kdf=first, seq2=first["seq"].to_numpy(), t2=first["t"].to_numpy(),
                                p2=first["payload"].to_numpy(), found=first["is_second"].to_numpy().astype(bool))
                else:
                    head = dict(kdf=first, seq2=None, t2=None, p2=None, found=False)
            # next mode: the first key's earliest candidate, and whether the slice holds other keys
            if mode == "next" and not head["found"]:
                same = np.ones(len(pdf), dtype=bool)
                for k, v in zip(keys, head_key):
                    same &= pdf[k].to_numpy() == v
                if not same.all():
                    only_key = False
                cand = np.flatnonzero(same & pdf["is_second"].to_numpy().astype(bool))
                if len(cand):
                    j = cand[0]
                    head.update(seq2=pdf["seq"].to_numpy()[j:j + 1], t2=pdf["t"].to_numpy()[j:j + 1],
                                p2=pdf["payload"].to_numpy()[j:j + 1], found=True)
            if carry is not None and len(carry):
                pdf = pd.concat([carry, pdf], ignore_index=True)
            else:
                pdf = pdf.reset_index(drop=True)
            seg = _segments(pdf, keys)
            t = pdf["t"].to_numpy(dtype=np.int64)
            seq = pdf["seq"].to_numpy(dtype=np.int64)
            is_first = pdf["is_first"].to_numpy().astype(bool)
            is_second = pdf["is_second"].to_numpy().astype(bool)
            pay = pdf["payload"].to_numpy()
            if waiting:
                lead = int(np.searchsorted(seg, seg[0], side="right"))  # rows of the batch's first key
                same = all(waiting[0][k].iat[0] == pdf[k].iat[0] for k in keys)
                second = np.flatnonzero(is_second[:lead]) if same else []
                if len(second):
                    j = second[0]
                    for chunk in waiting:
                        hit = chunk[t[j] - chunk["t"].to_numpy(dtype=np.int64) < within_ms]
                        if len(hit):
                            yield _rows(PAIR, pid, keys, hit, hit["seq"].to_numpy(dtype=np.int64),
                                        hit["t"].to_numpy(dtype=np.int64), np.full(len(hit), seq[j]),
                                        np.full(len(hit), t[j]), hit["payload"].to_numpy(),
                                        np.full(len(hit), pay[j], dtype=object))
                if not same or len(second) or lead < len(pdf):
                    waiting.clear()
                while waiting and t[-1] - waiting[0]["t"].iat[-1] >= within_ms:
                    waiting.popleft()
            a, b, keep = match_block(t, is_first, is_second, seg, mode, within_ms)
            if len(a):
                yield _rows(PAIR, pid, keys, pdf.iloc[a], seq[a], t[a], seq[b], t[b], pay[a], pay[b])
            if mode == "strict":
                carry = pdf.iloc[keep]
            elif len(keep):
                waiting.append(pdf.iloc[keep])
        if head is None:
            return
        if mode == "strict" and bool(carry["is_first"].iat[0]):
            waiting.append(carry)
        for chunk in waiting:
            yield _rows(OPEN, pid, keys, chunk, chunk["seq"].to_numpy(dtype=np.int64),
                        chunk["t"].to_numpy(dtype=np.int64), p1=chunk["payload"].to_numpy())
        if waiting:
            # one marker per slice asks for the continuation of its last key
            yield _rows(MARK, pid, keys, waiting[0].iloc[[0]])
        found = np.array([bool(head["found"]) if mode == "next" else bool(head["found"][0])])
        seq2 = head["seq2"] if head["seq2"] is not None else pd.array([None], dtype="Int64")
        t2 = head["t2"] if head["t2"] is not None else pd.array([None], dtype="Int64")
        yield _rows(HEAD, pid, keys, head["kdf"], seq2=seq2, t2=t2, p2=head["p2"], found=found,
                    only_key=np.array([only_key]))

    return scan


def next_match(df: DataFrame, keys: list[str], mode: str, within_ms: int,
               num_partitions: int | None = None) -> DataFrame:
    """Pairs ``(keys, seq1, t1, p1, seq2, t2, p2)`` for the ordered scan described above.

    ``df`` has ``keys``, ``t`` (epoch ms, long), ``seq`` (long, unique), the
    boolean columns ``is_first`` / ``is_second`` and ``payload`` (text carried
    along for rows that may be part of a match, null otherwise). Rows with null
    keys must be removed by the caller.
    """
    if mode not in ("strict", "next"):
        raise ValueError(f"mode must be 'strict' or 'next', not {mode!r}")
    slim = df.select(*keys, "t", "seq", "is_first", "is_second", "payload")
    key_fields = [slim.schema[k] for k in keys]
    order = [*keys, "t", "seq"]
    # Without an explicit count the range exchange is sized by AQE, which may merge
    # adjacent (small) ranges; merged slices keep their order, which is all the
    # cross-slice resolution relies on.
    #
    # The range exchange samples its input with a separate job. A rebalance of the
    # slim rows right below it makes that input a materialised shuffle stage, so the
    # sample reads a few columns from shuffle files instead of recomputing the whole
    # upstream plan (scan + JSON parse) a second time. (A plain ``repartition`` here
    # would be collapsed into the range exchange by the optimizer; a rebalance is not.)
    staged = slim.hint("rebalance", "seq")
    ranged = staged.repartitionByRange(num_partitions, *order) if num_partitions else staged.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order)
    scanned = ranged.mapInPandas(_scan_factory(keys, mode, within_ms), _out_schema(key_fields))

    # The scan's output becomes one shuffle stage with two readers: pairs leave from there, and only
    # heads, markers and open rows go on. Both readers filter on columns of a Generate, which keeps
    # the filters above the stage, so that it is the same for both and the scan runs once.
    columns = scanned.columns
    scanned = scanned.hint("rebalance", "pid", "seq1") \
        .select(F.inline(F.array(F.struct(*[F.col(c) for c in columns]))))
    pairs = scanned.where(F.col("kind") == PAIR).select(*keys, "seq1", "t1", "p1", "seq2", "t2", "p2")
    scanned = scanned.where(F.col("kind") != PAIR)

    # Cross-slice resolution:
    # 1. heads (one per slice) and markers (one per slice with open rows) share one small
    #    group, ordered by slice descending; each marker picks up the nearest later slice's
    #    head that is not "transparent" (next mode: a slice of one key with no candidate);
    # 2. a window per slice hands the marker's answer to that slice's open rows.
    # Open rows stay spread by slice in both steps; the shared group holds at
    # most two rows per slice whatever the key distribution.
    kind = F.col("kind")
    transparent = F.col("only_key") & ~F.col("found") if mode == "next" else F.lit(False)
    nxt = F.struct(*[F.col(k).alias(f"k_{k}") for k in keys], "found", "seq2", "t2", "p2")
    g = F.when(kind.isin(HEAD, MARK), F.lit(-1)).otherwise(F.col("pid"))
    w1 = (Window.partitionBy("g").orderBy(F.col("pid").desc(), F.col("rank"))
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    step1 = scanned.select("*", g.alias("g"), F.when(kind == HEAD, 1).otherwise(0).alias("rank")) \
        .select("*", F.last(F.when((kind == HEAD) & ~transparent, nxt), ignorenulls=True).over(w1).alias("nx")) \
        .where(kind != HEAD)
    w2 = (Window.partitionBy("pid").orderBy(F.when(kind == MARK, 0).otherwise(1))
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    windowed = step1.select("*", F.first(F.when(kind == MARK, F.col("nx")), ignorenulls=True).over(w2).alias("rx"))
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & (F.col(f"rx.k_{k}") == F.col(k))
    crossing = ((kind == OPEN) & F.col("rx").isNotNull() & same_key & F.col("rx.found")
                & (F.col("rx.t2") - F.col("t1") < within_ms))
    resolved = windowed.where(crossing).select(*keys, "seq1", "t1", "p1", F.col("rx.seq2").alias("seq2"),
                                               F.col("rx.t2").alias("t2"), F.col("rx.p2").alias("p2"))
    return pairs.unionByName(resolved)
