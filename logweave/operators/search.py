"""Ordered search for the next row that stands in a given relation to a value (SEQ7).

A *mark* stands at a place of its key's order and holds a value, say of a pattern's first row; it asks for

* ``strict``: the very next row, if that satisfies the step and the comparison;
* ``next``: the earliest later row that satisfies both.

Comparisons ``<``, ``<=``, ``>``, ``>=`` of numbers or times, ``=`` and ``<>`` of anything: row's value against mark's.

Marks and rows are range-partitioned together on ``(key, t, seq)``, so a hot key is cut into many slices. Within a
slice a tree of extremes over its rows finds the earliest one beyond a value in logarithmic time, for
all marks of a batch at once (``first_beyond``). What goes on beyond the slice is settled by an index of each
slice, never by comparing marks with rows one by one:

1. A slice writes an index of its first key: for ``>`` the rows above all rows before them (only such a row can
   be the first above a value), for ``<>`` the first row and the first of another value, else the first row.
   Marks that the slice leaves open are written too. All of this is staged in the shared folder.
2. The driver reads one entry a slice (keys and extreme); with it each open mark finds the slice of its answer.
3. The open marks of a slice meet the index of their answer's slice in a group of those two slices, and
   a binary search gives the row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from logweave.session import staged_table

FOUND, OPEN, HEAD, INDEX = "found", "open", "head", "index"
ORDERED, OTHER, SAME = ("<", "<=", ">", ">="), "<>", "="


def first_beyond(values: np.ndarray, start: np.ndarray, wanted: np.ndarray, equal: bool) -> np.ndarray:
    """For each query the first index from ``start`` on whose value is above ``wanted`` (or equal); else ``len(values)``."""
    n = len(values)
    out = np.full(len(start), n)
    if not n or not len(start):
        return out
    beyond = np.greater_equal if equal else np.greater
    size = 1 << (n - 1).bit_length()
    tree = np.empty(2 * size, values.dtype)
    tree[size:size + n] = values
    tree[size + n:] = values.min()
    for k in reversed(range(size.bit_length() - 1)):
        own = tree[2 << k:4 << k]
        tree[1 << k:2 << k] = np.maximum(own[::2], own[1::2])
    who = np.flatnonzero(start < n)
    node = start[who] + size
    hits: list[tuple[np.ndarray, np.ndarray]] = [(who[:0], node[:0])]
    while len(who):
        good = beyond(tree[node], wanted[who])
        hits.append((who[good], node[good]))
        who, node = who[~good], node[~good] + 1
        inside = node & (node - 1) != 0  # a power of two begins a level: nothing stands to the right
        who, node = who[inside], node[inside]
        node = np.where(node & 1 == 0, node >> 1, node)
    who, node = (np.concatenate(x) for x in zip(*hits))
    while len(node) and node.min() < size:
        inner = node < size
        left = np.where(inner, 2 * node, node)
        node = np.where(inner, np.where(beyond(tree[np.minimum(left, 2 * size - 1)], wanted[who]), left, left + 1), node)
    out[who] = np.minimum(node - size, n)
    return out


def first_other(values: np.ndarray, start: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each query the first index from ``start`` on whose value differs from ``wanted``; else ``len(values)``."""
    n = len(values)
    if not n:
        return np.zeros(len(start), np.int64)
    edge = np.append(np.flatnonzero(values[1:] != values[:-1]) + 1, n)
    at = np.minimum(start, n - 1)
    beyond = edge[np.searchsorted(edge, at, side="right")]
    return np.where(start >= n, n, np.where(values[at] != wanted, at, beyond))


class Seeker:
    """How a mark's row is found among the candidates that follow it."""

    def __init__(self, strict: bool, op: str | None):
        self.strict, self.op = strict, op
        self.equal, self.down = op in ("<=", ">="), op in ("<", "<=")

    def values(self, column: pa.Array) -> np.ndarray:
        """Values in the direction of the search; text for ``<>``."""
        if self.op is None:
            return np.zeros(len(column), np.int64)
        if self.op in (OTHER, SAME):
            return column.to_numpy(zero_copy_only=False)
        v = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
        return v if not self.down else ~v if v.dtype.kind == "i" else -v

    def agrees(self, own: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if self.op is None:
            return np.ones(len(own), bool)
        if self.op == SAME:
            return own == wanted
        return own != wanted if self.op == OTHER else own >= wanted if self.equal else own > wanted

    def find(self, values: np.ndarray, start: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Index of the answer among candidates from ``start`` on (strict: of the next row, whatever it holds)."""
        if self.strict or self.op is None:
            return np.minimum(start, len(values))
        return first_other(values, start, wanted) if self.op == OTHER else first_beyond(values, start, wanted, self.equal)

    def index(self, values: np.ndarray, seen: list) -> np.ndarray:
        """Which candidates of a slice's first key belong to its index; ``seen`` holds those of earlier batches."""
        if not len(values):
            return np.zeros(0, np.int64)
        if self.strict or self.op is None:
            return np.arange(0 if seen else 1)
        if self.op == OTHER:
            if len(seen) == 2:
                return np.zeros(0, np.int64)
            first = seen[0] if seen else values[0]
            other = np.flatnonzero(values != first)[:1]
            return other if seen else np.concatenate([[0], other]).astype(np.int64)
        top = np.maximum.accumulate(values)
        new = np.concatenate([[True], top[1:] > top[:-1]])
        return np.flatnonzero(new & (values > max(seen)) if seen else new)


def _scan(keys: list[str], seek: Seeker, within_ms: int, schema: pa.Schema):
    def rows(kind: str, pid: int, n: int, **values) -> pa.RecordBatch:
        given = {"kind": pa.array([kind] * n), "pid": pa.array(np.full(n, pid, np.int32)), **values}
        return pa.RecordBatch.from_arrays([given[f.name].cast(f.type) if f.name in given else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, waiting, seen = TaskContext.get().partitionId(), [], []
        head = last = None
        whole = True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            take = lambda c, at: column[c].take(pa.array(at))
            change = np.zeros(n, bool)
            for k in keys:
                change[1:] |= pc.not_equal(column[k].slice(1), column[k].slice(0, n - 1)).to_numpy(zero_copy_only=False)
            seg = np.cumsum(change)
            t, t1 = (pc.fill_null(column[c], 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("t", "t1"))
            mark = column["mark"].to_numpy(zero_copy_only=False)
            ok = pc.fill_null(column["ok"], False).to_numpy(zero_copy_only=False)
            value = seek.values(column["v"])
            candidates = np.flatnonzero(~mark if seek.strict else ~mark & ok)
            own = value[candidates]
            first, here = {k: column[k].slice(0, 1) for k in keys}, {k: column[k].slice(n - 1, 1) for k in keys}
            same = last is not None and all(first[k][0].as_py() == last[k][0].as_py() for k in keys)
            lead = int(np.searchsorted(seg[candidates], 0, side="right"))  # candidates of the batch's first key
            if head is None:
                head = first
            elif whole and not same:
                whole = False
            if whole:  # the slice's first key goes on
                k = seek.index(own[:lead], seen)
                seen += own[:lead][k].tolist()
                if seek.op != OTHER:
                    seen = seen[-1:]  # the greatest so far
                if len(k):
                    at = candidates[:lead][k]
                    yield rows(INDEX, pid, len(k), v=take("v", at), ok=take("ok", at), seq2=take("seq", at), t2=take("t", at), p2=take("payload", at))
            whole = whole and not change.any()

            def answered(at: np.ndarray, w: dict) -> Iterator[pa.RecordBatch]:
                good = ok[at] & seek.agrees(value[at], w["v"]) & (t[at] - w["t1"] < within_ms)
                if good.any():
                    at, k = at[good], pa.array(np.flatnonzero(good))
                    yield rows(FOUND, pid, len(at), **{c: x.take(k) for c, x in w["rows"].items()}, seq2=take("seq", at), t2=take("t", at), p2=take("payload", at))

            def left(w: dict, which: np.ndarray) -> dict:
                k = pa.array(np.flatnonzero(which))
                return {"t1": w["t1"][which], "v": w["v"][which], "rows": {c: x.take(k) for c, x in w["rows"].items()}}

            if not same:
                waiting = []
            on = []
            for w in waiting:
                i = seek.find(own[:lead], np.zeros(len(w["t1"]), np.int64), w["v"])
                hit = i < lead
                yield from answered(candidates[i[hit]], left(w, hit))
                rest = ~hit & (t[-1] - w["t1"] < within_ms)
                if not change.any() and rest.any():
                    on.append(left(w, rest))
            m = np.flatnonzero(mark & ~pc.is_null(column["v"]).to_numpy(zero_copy_only=False) if seek.op else mark)
            asked = {"t1": t1[m], "v": value[m], "rows": {**{k: take(k, m) for k in keys}, "t1": take("t1", m), "v": take("v", m), "carry": take("payload", m)}}
            i = seek.find(own, np.searchsorted(candidates, m), value[m])
            at = candidates[np.minimum(i, max(len(candidates) - 1, 0))] if len(candidates) else np.zeros(len(m), np.int64)
            hit = (i < len(candidates)) & (seg[at] == seg[m])
            yield from answered(at[hit], left(asked, hit))
            rest = ~hit & (seg[m] == seg[-1]) & (t[-1] - t1[m] < within_ms)
            if rest.any():
                on.append(left(asked, rest))
            waiting, last = on, here
        if head is None:
            return
        for w in waiting:
            yield rows(OPEN, pid, len(w["t1"]), **w["rows"])
        best = {} if seek.strict or seek.op in (None, OTHER) or not seen else {"top": pa.array([max(seen)])}
        words = {"words": pa.array([[str(x) for x in seen]], pa.list_(pa.string()))} if seek.op == OTHER else {}
        yield rows(HEAD, pid, 1, **head, **{f"_l{k}": x for k, x in last.items()}, only_key=pa.array([whole]), ok=pa.array([bool(seen)]), **best, **words)
    return run


def _aim(heads: list, keys: list[str], seek: Seeker, schema: pa.Schema):
    """Open marks with the slice that holds their answer; ``heads`` has one entry a slice."""
    heads = sorted(heads, key=lambda h: h.pid)
    pids = np.array([h.pid for h in heads])
    n = len(heads)
    end = np.zeros(n, np.int64)  # one past the last slice that the slice's last key reaches into
    for k in reversed(range(n)):
        goes_on = k + 1 < n and all(heads[k][f"_l{c}"] == heads[k + 1][c] for c in keys)
        end[k] = k + 1 if not goes_on else end[k + 1] if heads[k + 1].only_key else k + 2
    has = np.array([bool(h.ok) for h in heads], bool)
    filled = np.flatnonzero(has)
    if seek.op in ORDERED and not seek.strict:
        top = np.array([heads[k].top for k in filled])
    elif seek.op == OTHER and not seek.strict:
        first = np.array([heads[k].words[0] for k in filled], object)
        several = np.array([len(heads[k].words) > 1 for k in filled], bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(pids, batch.column(batch.schema.get_field_index("pid")).to_numpy())
            wanted = seek.values(batch.column(batch.schema.get_field_index("v")))
            start = np.searchsorted(filled, at, side="right")
            if seek.strict or seek.op is None:
                i = start
            elif seek.op == OTHER:
                # a slice of several values answers any mark; one of a single value those that differ
                tops = np.flatnonzero(several)
                i = np.append(tops, len(filled))[np.searchsorted(tops, start)] if len(tops) else np.full(len(start), len(filled))
                i = np.minimum(i, first_other(first, start, wanted))
            else:
                i = first_beyond(top, start, wanted, seek.equal)
            slot = np.append(filled, n)[i]
            good = slot < end[at]
            target = pa.array(np.append(pids, -1)[slot][good], pa.int32())
            out = pa.Table.from_batches([batch]).filter(pa.array(good)).combine_chunks()
            cols = {c: out.column(c).combine_chunks() if out.num_rows else pa.nulls(0, out.schema.field(c).type) for c in out.schema.names}
            cols["target"] = target
            yield pa.RecordBatch.from_arrays([cols[f.name].cast(f.type) for f in schema], schema=schema)
    return run


def _settle(seek: Seeker, within_ms: int, schema: pa.Schema):
    """Open marks of one slice against the index of the slice that answers them."""
    def run(marks: pa.Table, index: pa.Table) -> pa.Table:
        index = index.sort_by([("t2", "ascending"), ("seq2", "ascending")])
        empty = not marks.num_rows or not index.num_rows
        values = seek.values(index.column("v").combine_chunks()) if not empty else None
        if not empty:
            wanted = seek.values(marks.column("v").combine_chunks())
            i = seek.find(values, np.zeros(marks.num_rows, np.int64), wanted)
            at = np.minimum(i, index.num_rows - 1)
            ok = pc.fill_null(index.column("ok"), False).to_numpy()
            good = (i < index.num_rows) & ok[at] & seek.agrees(values[at], wanted) & (index.column("t2").to_numpy()[at] - marks.column("t1").to_numpy() < within_ms)
        else:
            at, good = np.zeros(0, np.int64), np.zeros(marks.num_rows, bool)
        marks, index = marks.filter(pa.array(good)), index.take(pa.array(at[good]) if not empty else pa.array([], pa.int64()))
        cols = {c: marks.column(c) for c in marks.schema.names} | {c: index.column(c) for c in ("seq2", "t2", "p2")}
        return pa.table([cols[f.name].cast(f.type) for f in schema], schema=schema)
    return run


def search(marks: DataFrame, rows: DataFrame, keys: list[str], strict: bool, op: str | None, within_ms: int,
           num_partitions: int | None = None) -> DataFrame:
    """``(keys, t1, v, carry, seq2, t2, p2)`` of each mark that finds its row less than ``within_ms`` after ``t1``.

    ``marks(keys, t, seq, t1, v, carry)`` stand right behind the row ``(t, seq)``; ``rows(keys, t, seq, ok, v, payload)``,
    ``ok``: the row satisfies the step itself. Keys are not null. A null value fails any comparison.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if op is not None and op not in (*ORDERED, OTHER, SAME):
        raise ValueError(f"no comparison {op!r}")
    if op == SAME and not strict:  # an equal value is one more key
        keys = [*keys, "_same"]
        marks = marks.where("v is not null").withColumn("_same", F.col("v"))
        rows = rows.where("v is not null").withColumn("_same", F.col("v"))
        return search(marks, rows, keys, False, None, within_ms, num_partitions).drop("_same")
    seek = Seeker(strict, op)
    kind = rows.schema["v"].dataType
    if op in ORDERED and not isinstance(kind, (T.LongType, T.DoubleType)):
        raise ValueError("values to be compared by size must be long or double")
    asked = marks.select(*keys, "t", "seq", F.lit(True).alias("mark"), F.lit(None).cast("boolean").alias("ok"), "v", "t1", F.col("carry").alias("payload"))
    ok = F.col("ok") & F.col("v").isNotNull() if op else F.col("ok")
    own = rows.select(*keys, "t", "seq", F.lit(False).alias("mark"), F.coalesce(ok, F.lit(False)).alias("ok"), "v", F.lit(None).cast("long").alias("t1"), "payload")
    both = asked.unionByName(own if strict else own.where("ok"))
    key_fields = [both.schema[k] for k in keys]
    field = lambda name, of: T.StructField(name, of)
    fields = T.StructType([field("kind", T.StringType()), field("pid", T.IntegerType()), *key_fields, *[field(f"_l{f.name}", f.dataType) for f in key_fields],
                           field("t1", T.LongType()), field("v", kind), field("carry", T.StringType()), field("seq2", T.LongType()), field("t2", T.LongType()),
                           field("p2", T.StringType()), field("ok", T.BooleanType()), field("only_key", T.BooleanType()),
                           field("top", kind if op in ORDERED else T.LongType()), field("words", T.ArrayType(T.StringType()))])
    order = [*keys, "t", "seq", "mark"]
    spread = both.hint("rebalance", "seq")
    ranged = spread.repartitionByRange(num_partitions, *order) if num_partitions else spread.repartitionByRange(*order)
    scanned = staged_table(ranged.sortWithinPartitions(*order).mapInArrow(_scan(keys, seek, within_ms, to_arrow_schema(fields)), fields), "search", ["kind"])
    result = [*keys, "t1", "v", "carry", "seq2", "t2", "p2"]
    found = scanned.where(F.col("kind") == FOUND).select(*result)
    # one row for each slice: its keys and, where values are compared, its extreme
    heads = scanned.where(F.col("kind") == HEAD).select("pid", *keys, *[f"_l{k}" for k in keys], "only_key", "ok", "top", "words").collect()
    if not heads:
        return found
    opened = scanned.where(F.col("kind") == OPEN).select("pid", *keys, "t1", "v", "carry")
    aimed_fields = T.StructType([*opened.schema.fields, field("target", T.IntegerType())])
    aimed = opened.mapInArrow(_aim(heads, keys, seek, to_arrow_schema(aimed_fields)), aimed_fields)
    aimed = staged_table(aimed, "aimed")
    wanted = aimed.select(F.col("pid").alias("asker"), F.col("target").alias("wanted")).distinct()
    index = scanned.where(F.col("kind") == INDEX).select(F.col("pid").alias("holder"), "v", "ok", "seq2", "t2", "p2")
    index = index.join(wanted, F.col("holder") == F.col("wanted")).select("asker", "wanted", "v", "ok", "seq2", "t2", "p2")
    out = T.StructType([aimed.schema[k] if k in (*keys, "t1", "v", "carry") else scanned.schema[k] for k in result])
    crossing = aimed.groupBy("pid", "target").cogroup(index.groupBy("asker", "wanted")).applyInArrow(_settle(seek, within_ms, to_arrow_schema(out)), out)
    return found.unionByName(crossing)
