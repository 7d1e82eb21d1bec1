"""Operator 13, Merkle dataset manifest as a persistent, path-copying tree.

Each row is a leaf: the SHA-256 of its fields. The leaves of a source, by ascending id, form a tree in
which three consecutive nodes become one; the sources' subroots form the root's tree in the same way.

The tree is built in aligned blocks of 3^6 leaves, each in one task: a block of leaves gives one node,
blocks of those give the next ones, up to the subroot and on to the root. A changed leaf creates a
version of its block: the nodes on its path are copied, every other node is shared with the version
before it. The version is then continued above the block, along the path of the block's top node,
which is worked out once a block; so versions of one source spread over all its blocks' tasks, and
no task holds more than one block, whatever a source's share of the rows.

Leaves get their places in two passes: a range sort by (source, id, leaf), then prefix sums over the
rows of each source in each range.

Defined cases: a null field enters a leaf as ``-``, any other with its length, so null and empty differ.
A null source is a tree of its own, before all others; null ids come before all numbers. Rows that
repeat an id lie by their leaf; rows equal in all fields are leaves of their own. A change that leaves
a row as it was gives a version with the same root. A lone leaf is its source's subroot, a lone
subroot the root. Columns other than the fields are left behind. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import python_ready, stage

FAN, LEVELS = 3, 6
BLOCK = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def leaf_of(fields: list[Column]) -> Column:
    """SHA-256 over each field's byte count and value, or ``-`` for a null."""
    text = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in text]), 256)


class Node:
    """An immutable node; versions share whatever they do not copy."""
    __slots__ = ("hash", "kids")

    def __init__(self, digest: str, kids: tuple[Node, ...] = ()):
        self.hash, self.kids = digest, kids


def parent(kids: tuple[Node, ...]) -> Node:
    return Node(hashlib.sha256("".join([k.hash for k in kids]).encode()).hexdigest(), kids)


def height(n: int) -> int:
    """Levels of a block's tree: all of them where its tree goes on above it, else up to its last node."""
    if n > BLOCK:
        return LEVELS
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def grown(hashes: list[str], levels: int) -> Node:
    row = [Node(h) for h in hashes]
    for _ in range(levels):
        row = [parent(tuple(row[k:k + FAN])) for k in range(0, len(row), FAN)]
    return row[0]


def places(index: int, levels: int) -> list[int]:
    """The child to take at each level, from the top."""
    return [index // FAN ** k % FAN for k in reversed(range(levels))]


def copied(root: Node, way: list[int], leaf: str) -> Node:
    """The version of ``root`` with another leaf: new nodes along the way, all others shared."""
    if not way:
        return Node(leaf)
    kids = list(root.kids)
    kids[way[0]] = copied(kids[way[0]], way[1:], leaf)
    return parent(tuple(kids))


def siblings(root: Node, way: list[int]) -> list[dict[str, str]]:
    """For each level, from the leaf up: the digests before and after the node in its run."""
    out = []
    for k in way:
        out.append({"before": "".join([x.hash for x in root.kids[:k]]), "after": "".join([x.hash for x in root.kids[k + 1:]])})
        root = root.kids[k]
    return out[::-1]


def _sorted(table: pa.Table) -> tuple[pa.Table, int]:
    return table.sort_by("pos"), height(table.column("n")[0].as_py()) if table.num_rows else 0


def _rise(table: pa.Table) -> pa.Table:
    own, levels = _sorted(table)
    n = own.column("n")[0].as_py()
    return pa.table({"tree": own.column("tree").slice(0, 1), "pos": [own.column("pos")[0].as_py() // BLOCK], "n": [-(-n // BLOCK)],
                     "hash": [grown(own.column("hash").to_pylist(), levels).hash]})


def _paths(table: pa.Table) -> pa.Table:
    own, levels = _sorted(table)
    root, pos = grown(own.column("hash").to_pylist(), levels), own.column("pos").to_pylist()
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    return pa.table({"tree": own.column("tree"), "pos": own.column("pos"), "path": pa.array([siblings(root, places(p % BLOCK, levels)) for p in pos], kind)})


def _versions(leaves: pa.Table, above: pa.Table) -> pa.Table:
    """The rows of one block: their path, and the root of the version that each one's changed leaf makes."""
    own, levels = _sorted(leaves)
    root, crown = grown(own.column("hash").to_pylist(), levels), above.column("path")[0].as_py()
    paths, version, new = [], [], []
    for p, changed in zip(own.column("pos").to_pylist(), own.column("changed").to_pylist()):
        way = places(p % BLOCK, levels)
        top = copied(root, way, changed).hash
        for step in crown:  # the version goes on above its block: a copy of each ancestor
            top = hashlib.sha256((step["before"] + top + step["after"]).encode()).hexdigest()
        paths.append(siblings(root, way) + crown)
        version.append(top)
        new.append(levels + len(crown) + 1)
    m = own.num_rows
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    return pa.table({"doc_id": own.column("doc_id"), "leaf": own.column("hash"), "subroot": above.column("subroot")[:1].to_pylist() * m, "root": above.column("root")[:1].to_pylist() * m,
                     "path": pa.array(paths, kind), "version_leaf": own.column("changed"), "version_root": version, "n_copied": pa.array(new, pa.int64())})


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of each row among its tree's rows in this range."""
    from pyspark import TaskContext
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column(0).dictionary_encode()
        code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        head = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        local = np.arange(len(code)) - np.repeat(head, np.diff(np.append(head, len(code))))
        first = codes.dictionary[int(code[0])].as_py()
        if first == last:
            local[:head[1] if len(head) > 1 else len(local)] += count
        last, count = codes.dictionary[int(code[-1])].as_py(), int(local[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(code), part), pa.int32()), pa.array(local, pa.int64())], [*batch.schema.names, "part", "local"])


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with pos, the place by ``order`` among the rows of their ``tree``, and n, that tree's rows.

    The first column must be ``tree``. No tree is gathered: the ranges cut a large one into many.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    runs = stage(ranged.mapInArrow(_number, f"{fields}, part int, local long"), name)
    counts = runs.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    by_tree = Window.partitionBy("tree")  # a row for each range that the tree lies in
    offsets = counts.select("tree", "part", F.sum("rows").over(by_tree).alias("n"),
                            F.coalesce(F.sum("rows").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return runs.join(offsets, ["tree", "part"]).withColumn("pos", F.col("before") + F.col("local")).drop("part", "local", "before")


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))


def crowned(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Of ``nodes(tree, pos, n, hash)``: (tree, pos, path to the tree's root) of each block, and (tree, hash) of the roots."""
    layers = []
    while True:
        nodes = stage(_blocks(nodes).groupBy("tree", "block").applyInArrow(_rise, "tree string, pos long, n long, hash string"), name)
        layers.append(nodes)
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            break
    above = nodes.select("tree", "pos", F.array().cast(PATH).alias("path"))
    for layer in reversed(layers[:-1]):
        own = _blocks(layer).groupBy("tree", "block").applyInArrow(_paths, f"tree string, pos long, path {PATH}").withColumn("up", F.floor(F.col("pos") / BLOCK))
        above = own.join(above.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("path").alias("_path")),
                         (F.col("tree") == F.col("_tree")) & (F.col("up") == F.col("_pos"))).select("tree", "pos", F.concat("path", "_path").alias("path"))
    return above, nodes.select("tree", "hash")


def manifest(docs: DataFrame, changed_text: Column) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, version_leaf, version_root, n_copied) of each row.

    ``path`` holds, from the leaf up to the root, the joined digests before and after the node in its
    run. ``changed_text`` is the text that the row's version has in its leaf; ``version_root`` is the
    version's root and ``n_copied`` the number of its own nodes, the others being shared.
    """
    python_ready(docs.sparkSession)
    fields = [docs[c] for c in FIELDS]
    slim = docs.select(F.coalesce(F.concat(F.lit("="), docs["source"].cast("string")), F.lit("-")).alias("tree"), docs["doc_id"].cast("long").alias("doc_id"),
                       leaf_of(fields).alias("hash"), leaf_of([*fields[:-1], changed_text]).alias("changed"), F.monotonically_increasing_id().alias("row"))
    leaves = numbered(stage(slim, "leaves"), ["doc_id", "hash", "row"], "numbered")
    above, subroots = crowned(leaves.select("tree", "pos", "n", "hash"), "blocks")
    # the sources' subroots are the leaves of one more tree
    forest = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "hash"), ["source"], "sources")
    upper, root = crowned(forest.select("tree", "pos", "n", "hash"), "forest")
    own = _blocks(forest.select("tree", "pos", "n", "hash")).groupBy("tree", "block").applyInArrow(_paths, f"tree string, pos long, path {PATH}")
    upper = own.join(upper.select(F.col("pos").alias("_pos"), F.col("path").alias("_path")), F.floor(F.col("pos") / BLOCK) == F.col("_pos"))
    tops = forest.select(F.col("source").alias("_source"), F.col("hash").alias("subroot"), F.col("pos").alias("_place"))
    tops = tops.join(upper.select("pos", F.concat("path", "_path").alias("_upper")), F.col("_place") == F.col("pos")).drop("pos", "_place")
    top = root.select(F.col("hash").alias("root"))
    crown = above.join(tops, F.col("tree") == F.col("_source")).join(F.broadcast(top))  # one row: the root
    crown = stage(crown.select("tree", F.col("pos").alias("block"), F.concat("path", "_upper").alias("path"), "subroot", "root"), "crown")
    rows = _blocks(leaves).groupBy("tree", "block").cogroup(crown.groupBy("tree", "block"))
    return rows.applyInArrow(_versions, f"doc_id long, leaf string, subroot string, root string, path {PATH}, version_leaf string, version_root string, n_copied long")
