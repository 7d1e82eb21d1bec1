"""Operator 2, packing by concatenate and cut.

Pass 1 tokenizes each partition once and writes every document's ids with its start inside the
partition; the partitions' totals are prefix-summed to global offsets; pass 2 cuts the one long
run of ids at multiples of the sequence length, so a document crossing a boundary leaves one piece
on either side and only the last sequence of all is short.

Ids are written as little-endian unsigned 32-bit integers.

Defined cases: a null or empty text is its end id alone. A null doc_id is carried as it is.
Repeated rows are packed each. No rows give no pieces. White space of any length is one pre-token
but for its last character before a word; runs the regex engine cannot step back over are cut out
before it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, stage

#: The pre-tokenization pattern of the public byte-level BPE vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White space of the pattern, and the length from which a run does not pass the regex engine.
SPACE, LONG = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]", 10_000
_LONG_RUN = re.compile(f"(?<!{SPACE}){SPACE}{{{LONG},}}")


def byte_symbols() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def _encoder(vocabulary: str, pattern: str = PATTERN):
    """Ids of a byte-level BPE vocabulary file's text, whose ids must follow the merge order."""
    import tiktoken

    spec = json.loads(vocabulary)
    symbol, vocab = byte_symbols(), spec["model"]["vocab"]
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
    if merged != sorted(merged) or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError("not a byte-level BPE vocabulary with ids in merge order")
    ranks = {bytes(symbol[c] for c in token): i for token, i in vocab.items()}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {k: v for k, v in ranks.items() if v not in special.values()}
    return tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def _encode(vocabulary: str, text: str) -> np.ndarray:
    """Ids of a text; long white space goes past the regex as the pre-token it would become."""
    encoder = _encoder(vocabulary)
    if len(text) < LONG:
        return encoder.encode_to_numpy(text, allowed_special="all")
    out, lo = [], 0
    for run in _LONG_RUN.finditer(text):
        a, b = run.span()
        if b < len(text) and not any(text.startswith(t, b) for t in encoder.special_tokens_set):
            b -= 1  # the last character stands before a word
        out.append(encoder.encode_to_numpy(text[lo:a], allowed_special="all"))
        out.append(_encoder(vocabulary, r"[\s\S]+").encode_to_numpy(text[a:b], allowed_special="all"))
        lo = b
    return np.concatenate([*out, encoder.encode_to_numpy(text[lo:], allowed_special="all")])


def _tokenize(vocabulary, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, start, order = vocabulary.value, TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                ids, starts, lengths = [], [], []
                for text in rows.column(1).to_pylist():
                    own = np.append(_encode(known, text or ""), end_id).astype("<u4")
                    ids.append(own.tobytes())
                    starts.append(start)
                    lengths.append(len(own))
                    start += len(own)
                n = rows.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int32)), rows.column(0), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())],
                    ["part", "doc_id", "part_start", "doc_tokens", "ids"])
                order += n
    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(n).to_pylist() for n in ("doc_id", "global_start", "doc_tokens")}
            ids = batch.column("ids")
            out = []
            for k, (doc, g, n) in enumerate(zip(col["doc_id"], col["global_start"], col["doc_tokens"])):
                own, at = memoryview(ids[k].as_buffer()), 0
                while at < n:
                    seq, offset = divmod(g + at, length)
                    take = min(n - at, length - offset)
                    out.append((doc, at, take, n, seq, offset, bytes(own[4 * at:4 * (at + take)])))
                    at += take
                if len(out) >= 4096:
                    yield _pieces(out)
                    out = []
            if out:
                yield _pieces(out)
    return run


_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE)], schema=_PIECE)


def pack(docs: DataFrame, vocabulary_path: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of full sequences.

    The vocabulary file (a few MB, 64 MB at most) is read by the driver and broadcast. One total per
    input partition crosses the driver's side of the plan; ids stay where pass 1 wrote them.
    """
    spark = docs.sparkSession
    python_ready(spark)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tokens = stage(slim.mapInArrow(_tokenize(vocabulary, end_id), "part int, doc_id long, part_start long, doc_tokens long, ids binary"), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).orderBy("part").toLocalIterator()
    base, run = {}, 0
    for part, n in totals:
        base[part], run = run, run + n
    bases = spark.createDataFrame(list(base.items()) or [(-1, 0)], "part int, base long")
    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("global_start"), "doc_tokens", "ids")
    return placed.mapInArrow(_cut(length), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def read_vocabulary(path: str, most: int = 64 << 20) -> str:
    with open(path, encoding="utf-8") as f:
        text = f.read(most + 1)
    if len(text) > most:
        raise ValueError(f"{path} holds more than {most} characters, too many to broadcast")
    return text
