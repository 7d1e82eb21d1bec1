"""Operator 11, source divergence audit by a sort of token-start pointers.

A task takes some megabytes of documents from the Arrow buffers, lower-cases them in place and makes a
pointer for each place where a term starts. The pointers are put in order by a multikey quicksort whose
characters are eight bytes wide: all pointers by their first eight bytes, then those of each run of
equal ones that has more text by the next eight, and so on, all runs of a depth at once. Before the sort the
pointers lie by (language, source, document), and the sort is stable, so in a run of equal terms the
documents and occurrences of each source follow one another: counting them is one pass over the runs.
A task thus sends one row for each (language, source, term) of a slice; no term is built that is not sent.

Spark sums these rows, keeps a language's terms of enough documents, and deals them out in shards of a
bounded number of cells (terms times sources). A shard works out its share of every pair's divergence
and its best terms of each source; the shards' sums and bests are then merged.

With count c, N the group's occurrences of kept terms and V the kept terms, p = 1 + floor(10^9 (c + 2) / (N + 2 V))
and the divergence of p and q is floor((p - q)^2 / (p + q)), summed over terms. Integers throughout.

Defined cases: a null text, language or source is the empty string. A group without terms has the same
p for all kept terms; a language without kept terms has pairs of value 0 and no term rows; a language
of one source has no pairs. Repeated rows are documents of their own. Other columns are left behind. No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import python_ready, slices, stage, text_buffer

SCALE, PRIOR = 10**9, 2
SLICE_BYTES, CELLS = 8 << 20, 100_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters of ASCII and every byte of a character beyond it.
_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def pointers(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of each term."""
    inside = np.concatenate([_TERM[buf], [False]])
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True  # a term ends with its document
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends - starts, np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(starts, off)))


def multikey(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, heads): a stable order of the terms by their bytes, and where a run of equal ones begins.

    ``buf`` must go on for eight bytes behind the last term. A term has no zero byte, so one that ends is
    less than any that goes on.
    """
    wide = np.ndarray((max(len(buf) - 7, 0),), ">u8", buf, strides=(1,))

    def character(k: np.ndarray, depth: int) -> np.ndarray:
        left = sizes[k] - depth
        word = wide[np.where(left > 0, starts[k] + depth, 0)].astype(np.uint64)
        cut = np.clip(8 - left, 0, 8).astype(np.uint64) * np.uint64(8)
        return np.where(cut < 64, word >> np.minimum(cut, np.uint64(63)) << np.minimum(cut, np.uint64(63)), np.uint64(0))

    n = len(starts)
    key = character(np.arange(n), 0)
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.concatenate([[True], key[1:] != key[:-1]]) if n else np.zeros(0, bool)
    depth = 8
    while n:
        # runs of several terms that go on beyond the depth
        first = np.flatnonzero(heads)
        size = np.diff(np.append(first, n))
        more = np.maximum.reduceat(sizes[order], first) > depth
        live = np.flatnonzero(np.repeat((size > 1) & more, size))
        if not len(live):
            break
        run = np.cumsum(heads)[live]
        key = character(order[live], depth)
        turn = np.lexsort((key, run))
        order[live] = order[live][turn]
        key = key[turn]
        heads[live[1:]] |= (run[1:] == run[:-1]) & (key[1:] != key[:-1])
        depth += 8
    return order, heads


def term_strings(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(sizes)])
    data = buf[np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])]
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, df) of some megabytes; a row without a term for each group there."""
    for batch in batches:
        text, off = text_buffer(batch.column(2))
        for lo, hi in slices(off, SLICE_BYTES):
            own = pa.StructArray.from_arrays([batch.column(k).slice(lo, hi - lo) for k in (0, 1)], ["lang", "source"])
            names = pa.Table.from_struct_array(own).group_by(["lang", "source"]).aggregate([])
            key = {(r["lang"], r["source"]): k for k, r in enumerate(names.to_pylist())}
            code = np.array([key[a, b] for a, b in zip(*(batch.column(k).slice(lo, hi - lo).to_pylist() for k in (0, 1)))], np.uint16 if len(key) < 65536 else np.int64)
            yield pa.RecordBatch.from_arrays([names.column("lang").combine_chunks(), names.column("source").combine_chunks(), pa.nulls(len(key), pa.string()),
                                              *[pa.array(np.zeros(len(key), np.int64))] * 2], ["lang", "source", "term", "n", "df"])
            part = off[lo:hi + 1] - off[lo]
            buf = np.concatenate([_LOWER[text[off[lo]:off[hi]]], np.zeros(8, np.uint8)])
            starts, sizes, doc = pointers(buf[:-8], part)
            if not len(starts):
                continue
            by_group = np.argsort(code[doc], kind="stable")
            starts, sizes, doc = starts[by_group], sizes[by_group], doc[by_group]
            order, heads = multikey(buf, starts, sizes)
            doc, group = doc[order], code[doc[order]]
            new_group = heads.copy()
            new_group[1:] |= group[1:] != group[:-1]
            new_doc = new_group.copy()
            new_doc[1:] |= doc[1:] != doc[:-1]
            at = np.flatnonzero(new_group)
            n, df = np.diff(np.append(at, len(doc))), np.add.reduceat(new_doc, at, dtype=np.int64)
            which = pa.array(group[at].astype(np.int64))
            first = order[at]
            yield pa.RecordBatch.from_arrays([pc.take(names.column("lang").combine_chunks(), which), pc.take(names.column("source").combine_chunks(), which),
                                              term_strings(buf, starts[first], sizes[first]).cast(pa.string()), pa.array(n, pa.int64()), pa.array(df)], ["lang", "source", "term", "n", "df"])


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / total), by long division to the base 1000, within 64 bits."""
    whole, rest = np.divmod(counts + PRIOR, total)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + step
    return whole + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shard(top: int):
    def run(terms: pa.Table, groups: pa.Table) -> pa.Table:
        """Sums of this shard's terms for all pairs of a language's sources, and its best terms of each source."""
        groups = groups.sort_by("source")
        lang, source = groups.column("of_lang")[0].as_py(), groups.column("source").to_pylist()
        total, whole = groups.column("total").to_numpy().astype(np.int64), np.int64(groups.column("lang_total")[0].as_py())
        names = terms.column("term").to_pylist()
        out: list[tuple] = []
        count = np.zeros((len(source), len(names)), np.int64)
        if names:
            per = terms.column("per").combine_chunks()
            column = np.repeat(np.arange(len(names)), pc.list_value_length(per).to_numpy(zero_copy_only=False))
            flat = per.flatten()
            row = pc.index_in(flat.field("source"), value_set=pa.array(source)).to_numpy(zero_copy_only=False)
            count[row, column] = flat.field("n").to_numpy(zero_copy_only=False)
            p, q = shares(count, total[:, None]), shares(count.sum(axis=0), whole)
        for a in range(len(source)):
            value = divergence(p[a], p[a + 1:]).sum(axis=1).tolist() if names else [0] * (len(source) - a - 1)
            for b, v in enumerate(value, a + 1):
                out += [("pair", source[a], source[b], v), ("pair", source[b], source[a], v)]
            if names:
                k = np.flatnonzero((count[a] > 0) & (p[a] > q))
                f = divergence(p[a][k], q[k])
                if len(k) > top:
                    best = f >= np.partition(f, -top)[-top]
                    k, f = k[best], f[best]
                out += [("term", source[a], names[i], v) for v, i in sorted(zip(f.tolist(), k.tolist()), key=lambda x: (-x[0], names[x[1]].encode()))[:top]]
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.table([pa.array([lang] * len(out), pa.string()), *[pa.array(c, pa.string()) for c in cols[:3]], pa.array(cols[3], pa.int64())], ["lang", "part", "source", "item", "value"])
    return run


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): of each source of a language its divergence from every other one
    (part ``pair``) and the ``top`` terms by which it stands above the language (part ``term``)."""
    python_ready(docs.sparkSession)
    slim = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = slim.mapInArrow(_count, "lang string, source string, term string, n long, df long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    # one row a term, with its sources; the row without a term names all sources of a language
    terms = counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("per"))
    terms = stage(terms.where(F.col("term").isNull() | (F.col("df") >= min_docs)).select("lang", "term", "per"), "terms")
    kept = terms.select("lang", "term", F.explode("per").alias("x"))
    groups = kept.groupBy("lang", "x.source").agg(F.sum("x.n").alias("n"))
    langs = terms.groupBy("lang").agg(F.count("term").alias("v"), F.sum(F.when(F.col("term").isNull(), F.size("per"))).alias("sources"),
                                      F.sum(F.aggregate("per", F.lit(0).cast("long"), lambda a, x: a + x["n"])).alias("n"))
    langs = langs.select("lang", (F.col("n") + PRIOR * F.col("v")).alias("lang_total"), "v", "sources")
    cells = langs.agg(F.max(F.col("v") * F.col("sources"))).first()[0] or 0
    n = max(1, math.ceil(cells / CELLS))
    groups = groups.join(langs, "lang").select("lang", "source", (F.col("n") + PRIOR * F.col("v")).alias("total"), "lang_total", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("shard"))
    groups = groups.toDF("of_lang", "source", "total", "lang_total", "of_shard")
    dealt = terms.where("term is not null").withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(n)).cast("int"))
    parts = dealt.groupBy("lang", "shard").cogroup(groups.groupBy("of_lang", "of_shard")).applyInArrow(_shard(top), "lang string, part string, source string, item string, value long")
    pairs = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))
