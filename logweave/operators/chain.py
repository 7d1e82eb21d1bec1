"""Patterns of any number of steps as an automaton over ordered slices (SEQ2, UDF3).

A row that satisfies step 1 starts a partial match. From state ``k`` (steps 1 to ``k`` matched) it moves on to

* ``strict``: the very next row of the key, if that row satisfies step ``k + 1``; else the match is off;
* ``next``: the earliest later row of the key that satisfies step ``k + 1``.

So all partial matches of a key that wait in the same state at some place of the order go the same way
from there: a stretch of rows is a *table* that says, for each state in which a partial match may enter it,
the state in which it leaves (or that it is complete, or off) and the rows it takes. Tables compose.

Rows are range-partitioned on ``(key, t, seq)``, so a hot key is cut into many slices. Each task runs its
slice batch by batch, composing the batches' tables for the slice's first key, and emits complete
matches, the partial matches still open at its end, and the slice's table. One small group (a row for each
slice) composes the tables from the last slice to the first; its answer for a slice joins that slice's
open partial matches. The result does not depend on where the slices are cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

MATCH, OPEN, HEAD = "match", "open", "head"
#: State of a partial match that can no longer be completed.
OFF = 0
ENTRY = T.StructType([T.StructField("enter", T.IntegerType()), T.StructField("leave", T.IntegerType()),
                      T.StructField("seqs", T.ArrayType(T.LongType())), T.StructField("t2", T.LongType()),
                      T.StructField("pays", T.ArrayType(T.StringType()))])


@dataclass
class Way:
    """What a stretch of rows does to a partial match: the state it leaves in and the rows it takes."""
    leave: int
    seqs: list[int] = field(default_factory=list)
    t2: int = 0
    pays: list[str] = field(default_factory=list)


Table = dict[int, Way]


def compose(first: Table, second: Table | None, steps: int) -> Table:
    """``first``, then ``second``; without a second the key ends there and open matches are off."""
    out = {}
    for enter, a in first.items():
        if a.leave in (OFF, steps):
            out[enter] = a
        elif second is None:
            out[enter] = Way(OFF)
        else:
            b = second[a.leave]
            out[enter] = Way(b.leave, a.seqs + b.seqs, b.t2 if b.seqs else a.t2, a.pays + b.pays)
    return out


class Block:
    """Rows of some keys in ``(key, t, seq)`` order, with a bit for each step a row satisfies."""

    def __init__(self, t: np.ndarray, flags: np.ndarray, seg: np.ndarray, strict: list[bool]):
        self.t, self.flags, self.seg, self.strict = t, flags, seg, strict
        self.steps = len(strict)
        self.places = [np.flatnonzero(flags >> k & 1) for k in range(self.steps)]

    def _step(self, pos: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of partial matches whose last row is at ``pos`` (-1: before the block): the row for step index ``k``,
        whether it is there, and whether the match waits on at the block's end."""
        n = len(self.t)
        seg = self.seg[np.maximum(pos, 0)]
        if self.strict[k]:
            at = np.minimum(pos + 1, n - 1)
            inside = pos + 1 < n
            return at, inside & (self.seg[at] == seg) & (self.flags[at] >> k & 1 == 1), ~inside
        here = self.places[k]
        if not len(here):
            return np.zeros(len(pos), np.int64), np.zeros(len(pos), bool), seg == self.seg[-1]
        i = np.searchsorted(here, pos, side="right")
        at = here[np.minimum(i, len(here) - 1)]
        found = (i < len(here)) & (self.seg[at] == seg)
        return at, found, ~found & (seg == self.seg[-1])

    def run(self, pos: np.ndarray, state: int) -> tuple[np.ndarray, np.ndarray]:
        """(leaving state, rows taken: one column a step, -1 for none) of matches in ``state`` at ``pos``."""
        pos, leave = pos.copy(), np.full(len(pos), state)
        rows = np.full((len(pos), self.steps), -1)
        live = np.arange(len(pos))
        for k in range(state, self.steps):
            at, found, waits = self._step(pos[live], k)
            leave[live[~found & ~waits]] = OFF
            live, at = live[found], at[found]
            rows[live, k] = pos[live] = at
            leave[live] = k + 1
        return leave, rows

    def table(self, seq: np.ndarray, pays: np.ndarray) -> Table:
        out = {}
        for enter in range(1, self.steps):
            leave, rows = self.run(np.array([-1]), enter)
            taken = rows[0][rows[0] >= 0]
            out[enter] = Way(int(leave[0]), seq[taken].tolist(), int(self.t[taken[-1]]) if len(taken) else 0, pays[taken].tolist()) if leave[0] != OFF else Way(OFF)
        return out


@dataclass
class Waiting:
    """Open partial matches of one state: first time, and the rows of their steps so far."""
    state: int
    t1: np.ndarray
    seqs: np.ndarray  # one column a step
    pays: np.ndarray

    def only(self, which: np.ndarray) -> Waiting:
        return Waiting(self.state, self.t1[which], self.seqs[which], self.pays[which])

    def after(self, way: Way) -> Waiting:
        n = len(self.t1)
        return Waiting(way.leave, self.t1, np.hstack([self.seqs, np.tile(np.array(way.seqs, np.int64), (n, 1))]),
                       np.hstack([self.pays, np.tile(np.array(way.pays, object), (n, 1))]) if way.pays else self.pays)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.reshape(-1), kind))


def _entries(table: Table) -> list[dict]:
    return [{"enter": k, "leave": w.leave, "seqs": w.seqs, "t2": w.t2, "pays": w.pays} for k, w in table.items()]


def _scan(keys: list[str], strict: list[bool], within_ms: int, schema: pa.Schema):
    steps = len(strict)

    def rows(kind: str, pid: int, key: list[pa.Array], n: int, **values) -> pa.RecordBatch:
        given = {"kind": pa.array([kind] * n), "pid": pa.array(np.full(n, pid, np.int32)), **dict(zip(keys, key)), **values}
        return pa.RecordBatch.from_arrays([given[f.name].cast(f.type) if f.name in given else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        waiting: list[Waiting] = []
        head = head_key = last = None
        whole = True  # so far the slice holds one key
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            change = np.zeros(n, bool)
            for k in keys:
                change[1:] |= pc.not_equal(column[k].slice(1), column[k].slice(0, n - 1)).to_numpy(zero_copy_only=False)
            t, seq, flags = (column[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("t", "seq", "flags"))
            pays = column["payload"].to_numpy(zero_copy_only=False)
            block = Block(t, flags, np.cumsum(change), strict)
            first, here = [column[k].slice(0, 1) for k in keys], [column[k].slice(n - 1, 1) for k in keys]
            same = last is not None and all(a[0].as_py() == b[0].as_py() for a, b in zip(first, last))
            table = block.table(seq, pays)
            if head is None:
                head, head_key = table, first
            elif whole:
                head = compose(head, table if same else None, steps)
                whole = same
            if same:
                on = []
                for w in waiting:
                    way = table[w.state]
                    if way.leave == OFF:
                        continue
                    if way.seqs:
                        w = w.after(way)
                    w = w.only((way.t2 if way.leave == steps else t[-1]) - w.t1 < within_ms)
                    if not len(w.t1):
                        continue
                    if way.leave == steps:
                        yield rows(MATCH, pid, [pa.array([k[0].as_py()] * len(w.t1), k.type) for k in first], len(w.t1), t1=pa.array(w.t1), t2=pa.array(np.full(len(w.t1), way.t2)),
                                   seqs=_lists(w.seqs, pa.int64()), pays=_lists(w.pays, pa.string()))
                    else:
                        on.append(w)
                waiting = on
            else:
                waiting = []
            whole = whole and not change.any()
            start = block.places[0]
            leave, taken = block.run(start, 1)
            taken[:, 0] = start
            done = np.flatnonzero(leave == steps)
            done = done[t[taken[done, -1]] - t[taken[done, 0]] < within_ms]
            if len(done):
                own = taken[done]
                yield rows(MATCH, pid, [column[k].take(pa.array(own[:, 0])) for k in keys], len(done), t1=pa.array(t[own[:, 0]]), t2=pa.array(t[own[:, -1]]),
                           seqs=_lists(seq[own], pa.int64()), pays=_lists(pays[own], pa.string()))
            for state in range(1, steps):
                own = taken[(leave == state) & (t[-1] - t[start] < within_ms), :state]
                if len(own):
                    waiting.append(Waiting(state, t[own[:, 0]], seq[own], pays[own]))
            last = here
        if head is None:
            return
        for w in waiting:
            n = len(w.t1)
            yield rows(OPEN, pid, [pa.array([k[0].as_py()] * n, k.type) for k in last], n, state=pa.array(np.full(n, w.state), pa.int32()), t1=pa.array(w.t1),
                       seqs=_lists(w.seqs, pa.int64()), pays=_lists(w.pays, pa.string()))
        yield rows(HEAD, pid, head_key, 1, table=pa.array([_entries(head)], schema.field("table").type), only_key=pa.array([whole]))
    return run


def _continued(keys: list[str], steps: int, schema: pa.Schema):
    """For each slice, what follows it: the tables of the later slices of its last key, composed from the last one."""
    def run(heads: pa.Table) -> pa.Table:
        heads = heads.sort_by([("pid", "descending")])
        key = list(zip(*[heads.column(k).to_pylist() for k in keys])) or [()] * heads.num_rows
        pid, only = heads.column("pid").to_pylist(), heads.column("only_key").to_pylist()
        tables = [{e["enter"]: Way(e["leave"], e["seqs"], e["t2"], e["pays"]) for e in entries} for entries in heads.column("table").to_pylist()]
        out, after = [], []
        for k in range(1, len(pid)):
            table = tables[k - 1]
            if only[k - 1]:
                goes_on = k >= 2 and key[k - 2] == key[k - 1]
                table = compose(table, out[-1] if goes_on else None, steps)
            out.append(table)
            after.append(k - 1)
        done = [[e for e in _entries(t) if e["leave"] == steps] for t in out]
        taken = pa.array(after, pa.int64())
        cols = {"pid": pa.array(pid[1:], pa.int32()), "entries": pa.array(done, schema.field("entries").type)}
        cols |= {f"_n{k}": heads.column(k).combine_chunks().take(taken) if len(after) else pa.nulls(0, heads.schema.field(k).type) for k in keys}
        return pa.table([cols[f.name].cast(f.type) for f in schema], schema=schema)
    return run


def chain_matches(rows: DataFrame, keys: list[str], strict: list[bool], within_ms: int, num_partitions: int | None = None) -> DataFrame:
    """Complete matches ``(keys, seqs, t1, t2, pays)``, step by step in the arrays.

    ``rows`` has ``keys`` (not null), ``t`` (epoch ms), ``seq`` (unique), ``flags`` (bit ``k``: the row satisfies
    step ``k + 1``) and ``payload`` (text of rows with a flag). ``strict[k]``: step ``k + 1`` must be the next row.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if len(strict) < 2:
        raise ValueError("a pattern has two steps at least")
    slim = rows.select(*keys, "t", "seq", "flags", "payload")
    key_fields = [slim.schema[k] for k in keys]
    fields = T.StructType([T.StructField("kind", T.StringType()), T.StructField("pid", T.IntegerType()), *key_fields, T.StructField("state", T.IntegerType()),
                           T.StructField("t1", T.LongType()), T.StructField("t2", T.LongType()), T.StructField("seqs", T.ArrayType(T.LongType())),
                           T.StructField("pays", T.ArrayType(T.StringType())), T.StructField("table", T.ArrayType(ENTRY)), T.StructField("only_key", T.BooleanType())])
    order = [*keys, "t", "seq"]
    # the rebalance makes the sampling job of the range exchange read shuffle files, not the parse again
    staged = slim.hint("rebalance", "seq")
    ranged = staged.repartitionByRange(num_partitions, *order) if num_partitions else staged.repartitionByRange(*order)
    scanned = ranged.sortWithinPartitions(*order).mapInArrow(_scan(keys, strict, within_ms, to_arrow_schema(fields)), fields)
    # one shuffle stage with three readers; filters stay above the Generate, so the scan runs once
    columns = scanned.columns
    scanned = scanned.hint("rebalance", "pid", "t1").select(F.inline(F.array(F.struct(*[F.col(c) for c in columns]))))
    done = scanned.where(F.col("kind") == MATCH).select(*keys, "seqs", "t1", "t2", "pays")
    next_keys = [T.StructField(f"_n{f.name}", f.dataType) for f in key_fields]
    entry = T.ArrayType(ENTRY)
    answer = T.StructType([T.StructField("pid", T.IntegerType()), *next_keys, T.StructField("entries", entry)])
    heads = scanned.where(F.col("kind") == HEAD).groupBy("kind").applyInArrow(_continued(keys, len(strict), to_arrow_schema(answer)), answer)
    ways = heads.select(F.col("pid").alias("_pid"), *[f"_n{k}" for k in keys], F.inline("entries").alias("enter", "leave", "_seqs", "_t2", "_pays"))
    opened = scanned.where(F.col("kind") == OPEN)
    follows = (F.col("pid") == F.col("_pid")) & (F.col("state") == F.col("enter")) & (F.col("_t2") - F.col("t1") < within_ms)
    for k in keys:
        follows = follows & (F.col(k) == F.col(f"_n{k}"))
    crossing = opened.join(ways, follows).select(*keys, F.concat("seqs", "_seqs").alias("seqs"), "t1", F.col("_t2").alias("t2"), F.concat("pays", "_pays").alias("pays"))
    return done.unionByName(crossing)


def matches_in_order(t: np.ndarray, flags: np.ndarray, pays: np.ndarray, strict: list[bool], ops: list[str | None], within_ms: int) -> np.ndarray:
    """Rows of the complete matches (one column a step) among one key's rows in order.

    With comparisons ``pays`` is JSON that holds ``_own<k>`` and, for a first row, ``_first<k>``.
    """
    import json

    from logweave.operators.search import ORDERED, Seeker

    n = len(t)
    block = Block(t, flags, np.zeros(n, np.int64), strict)
    start = block.places[0]
    if not any(ops):
        leave, rows = block.run(start, 1)
        rows[:, 0] = start
        rows = rows[leave == len(strict)]
        return rows[t[rows[:, -1]] - t[rows[:, 0]] < within_ms]
    held = [json.loads(p) for p in pays]
    rows = start[:, None]
    for k in range(1, len(strict)):
        pos, op = rows[:, -1], ops[k]
        seek = Seeker(strict[k], op)
        ok = flags >> k & 1 == 1
        if op is not None:
            own, first = [h.get(f"_own{k}") for h in held], [held[i].get(f"_first{k}") for i in rows[:, 0]]
            ok &= np.array([v is not None for v in own], bool)
            known = np.array([v is not None for v in first], bool)
            rows, pos, first = rows[known], pos[known], [v for v in first if v is not None]
            kind = pa.string() if op not in ORDERED else pa.float64() if any(isinstance(v, float) for v in own + first) else pa.int64()
            # numbers that JSON writes as text (not a number, infinite) are read back
            as_is = (lambda v: v) if kind == pa.string() else (lambda v: None if v is None else float(v) if kind == pa.float64() else v)
            values, wanted = (seek.values(pa.array([as_is(v) for v in x], kind)) for x in (own, first))
        else:
            values, wanted = np.zeros(n, np.int64), np.zeros(len(pos), np.int64)
        candidates = np.arange(n) if strict[k] else np.flatnonzero(ok)
        if op == "=" and not strict[k]:
            # candidates by value, then place: the first of the wanted value behind the match's last row
            _, code = np.unique(np.concatenate([values[candidates], wanted]), return_inverse=True)
            placed = np.sort(code[:len(candidates)] * (n + 1) + candidates)
            code = code[len(candidates):]
            i = np.searchsorted(placed, code * (n + 1) + pos, side="right")
            hit = np.append(placed, -1)[i]
            at = np.where((i < len(placed)) & (hit // (n + 1) == code), hit % (n + 1), n)
        else:
            i = seek.find(values[candidates], np.searchsorted(candidates, pos, side="right"), wanted)
            at = np.append(candidates, n)[np.minimum(i, len(candidates))]
        good = at < n
        good[good] = ok[at[good]] & seek.agrees(values[at[good]], wanted[good]) & (t[at[good]] - t[rows[good, 0]] < within_ms)
        rows = np.hstack([rows[good], at[good][:, None]])
    return rows
