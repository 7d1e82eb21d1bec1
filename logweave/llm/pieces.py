"""Operator 12, SentencePiece encoding and decoding by a score-ordered agenda of adjacent symbol pairs.

For vocabularies of the merge type. White space becomes the mark U+2581 and the text is cut where no
piece reaches across: before each run of marks, and before line feeds if no longer piece holds one. In
each segment the adjacent symbols that together make a piece stand on an agenda, best score first,
leftmost first among equals; the first is merged, its pairs with the symbols beside it join the agenda
and pairs with symbols that are gone fall away. Symbols left without a piece become their bytes' pieces.

The new segments of a slice are worked at once: one array holds the agenda of all of them, each turn
takes the first entry of every segment (``_together``). A segment of over ``LONG`` symbols has a heap of
its own (``_alone``), so its time grows with n log n. Both give the same ids.

Checked: each Arrow batch hands the segments new to it to the sentencepiece library, ids and decoded
text must be the library's, else the task fails. Segments are independent, so equal segments make equal
texts; the tests compare whole texts.

Defined cases: a null or empty text has the begin and end ids only and decodes to the empty text. Names
of control pieces in a text are plain text. The mark itself in a text is read as a blank, as the library
does. Repeated rows are encoded each. Other columns are left behind. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, slices, text_buffer

MARK, LINE = "▁", "\n"
LONG, TOGETHER, SEGMENTS_KEPT, SLICE_BYTES = 96, 400_000, 700_000, 4 << 20
#: Symbols that are no piece: this and the code point.
UNKNOWN = 1 << 21
NONE = 1 << 30


class Pieces:
    def __init__(self, model: bytes, check: bool = True):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        train, norm = spec.trainer_spec, spec.normalizer_spec
        kinds = spec.SentencePiece
        if train.model_type != train.BPE or not train.byte_fallback or norm.precompiled_charsmap or spec.denormalizer_spec.precompiled_charsmap:
            raise ValueError("not a merge-type vocabulary with byte pieces and unchanged text")
        if not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces or train.treat_whitespace_as_suffix:
            raise ValueError("white space must be kept, marked, and one mark put in front")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces):
            raise ValueError("pieces of the user's or unused ones are not known here")
        self.library, self.check = SentencePieceProcessor(model_proto=model), check
        pieces = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
        self.byte = np.zeros(256, np.int64)
        self.byte_of: dict[int, int] = {}
        for i, p in enumerate(spec.pieces):
            if p.type == kinds.BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
                self.byte_of[i] = int(p.piece[3:5], 16)
        if len(self.byte_of) != 256:
            raise ValueError("byte pieces are missing")
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds white space behind text")
        self.names = np.array([p.piece for p in spec.pieces], object)
        #: Text of a piece; a byte piece of a character of several bytes is none by itself.
        self.plain = np.array([chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else p.piece.replace(MARK, " ") for i, p in enumerate(spec.pieces)], object)
        self.part_of_char = np.array([self.byte_of.get(i, 0) >= 128 for i in range(len(spec.pieces))])
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        # a line feed that no longer piece holds is a border too
        self.lines = not any(LINE in p for p in pieces if len(p) > 1)
        self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*" if self.lines else f"{MARK}+[^{MARK}]*")
        self.symbol = np.arange(0x110000, dtype=np.int64) + UNKNOWN
        for p, i in pieces.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        own = lambda s: int(self.symbol[ord(s)]) if len(s) == 1 else pieces.get(s)
        score = {s: k for k, s in enumerate(sorted({spec.pieces[i].score for i in pieces.values()}, reverse=True))}
        pairs: dict[int, tuple[int, int]] = {}
        for p, i in pieces.items():
            for k in range(1, len(p)):
                a, b = own(p[:k]), own(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = score[spec.pieces[i].score], i
        self.pairs = pairs
        self.key = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k][0] for k in self.key.tolist()] + [NONE], np.int64)  # the last: no pair
        self.made = np.array([pairs[k][1] for k in self.key.tolist()] + [-1], np.int64)
        self.known: dict[str, tuple[bytes, str]] = {}

    # -- segments ---------------------------------------------------------------------------------

    def keys(self, text: str) -> list[str]:
        """The text's segments; a segment of one mark and more stands without the mark."""
        if not text:
            return []
        if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            if not self.lines:
                return text.split(" ")
            if " \n" not in text and text[0] != LINE:
                return text.replace("\n", " \n").split(" ")
        whole = MARK + text.replace(" ", MARK)
        return [s[1:] if s[0] == MARK and s[1:2] != MARK else s for s in self.cut.findall(whole)]

    def segment(self, key: str) -> str:
        return key if key[:1] == MARK or self.lines and key[:1] == LINE else MARK + key

    # -- the agenda -------------------------------------------------------------------------------

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where the pairs stand in the table; -1 for none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, at, -1)

    def _together(self, text: str, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, symbol) in order, for segments of ``size`` characters that follow one another in ``text``."""
        sym = self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        who = np.repeat(np.arange(len(size)), size)
        pair = np.full(len(sym), -1, np.int64)  # with the next symbol
        inner = np.flatnonzero(who[1:] == who[:-1])
        pair[inner] = self._pair(sym[inner], sym[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            head = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            first = np.minimum.reduceat(self.rank[pair] << 32 | np.arange(len(sym)), head)
            live = first < NONE << 32
            count = np.diff(np.append(head, len(sym)))
            if not live.all():  # nothing left on a segment's agenda
                over = np.repeat(~live, count)
                done.append((who[over], sym[over]))
                at = np.cumsum(~over) - 1
                p = at[first[live] & 0xFFFFFFFF]
                who, sym, pair = who[~over], sym[~over], pair[~over]
            else:
                p = first & 0xFFFFFFFF
            if not len(sym):
                break
            sym[p] = self.made[pair[p]]
            keep = np.ones(len(sym), bool)
            keep[p + 1] = False
            at = np.cumsum(keep) - 1
            who, sym, pair, p = who[keep], sym[keep], pair[keep], at[p]
            for k in (p, p[(p > 0)] - 1):  # the pairs beside what was made
                k = k[k + 1 < len(sym)]
                same = who[k] == who[k + 1]
                pair[k[same]] = self._pair(sym[k[same]], sym[k[same] + 1])
            last = np.append(who[1:] != who[:-1], True)
            pair[last] = -1
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        who, sym = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(who, kind="stable")
        return who[order], sym[order]

    def _alone(self, segment: str) -> np.ndarray:
        """The symbols of one segment, by a heap and a linked list."""
        sym = self.symbol[np.frombuffer(segment.encode("utf-32-le", "surrogatepass"), "<u4")].tolist()
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int]] = []
        pairs, push = self.pairs, heapq.heappush

        def put(a: int, b: int) -> None:
            found = pairs.get(sym[a] << 32 | sym[b])
            if found:
                push(agenda, (found[0], a, sym[a], sym[b]))

        for k in range(n - 1):
            put(k, k + 1)
        while agenda:
            _, a, left, right = heapq.heappop(agenda)
            b = after[a]
            if sym[a] != left or b >= n or sym[b] != right:
                continue  # one of the two is gone
            sym[a], sym[b] = pairs[left << 32 | right][1], -1
            after[a] = after[b]
            if after[a] < n:
                before[after[a]] = a
                put(a, after[a])
            if before[a] >= 0:
                put(before[a], a)
        return np.array([s for s in sym if s >= 0], np.int64)

    def symbols(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of all segments, one after the other; where each segment begins, and the end)."""
        size = np.array([len(s) for s in segments], np.int64)
        short = np.flatnonzero(size <= LONG)
        order, parts, counts = [], [], []
        for some in np.array_split(short, max(1, int(size[short].sum()) // TOGETHER)):
            who, sym = self._together("".join([segments[i] for i in some]), size[some])
            order.append(some)
            parts.append(sym)
            counts.append(np.bincount(who, minlength=len(some)))
        for i in np.flatnonzero(size > LONG):
            parts.append(self._alone(segments[i]))
            order.append(np.array([i]))
            counts.append(np.array([len(parts[-1])]))
        order, flat, count = (np.concatenate(x) for x in (order, parts, counts))
        # back to the order of the segments
        back = np.argsort(order)
        begin = (np.cumsum(count) - count)[back]
        count = count[back]
        edge = np.concatenate([[0], np.cumsum(count)])
        return flat[np.repeat(begin - edge[:-1], count) + np.arange(edge[-1])], edge

    def ids(self, symbols: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids in place of symbols: a symbol without a piece becomes its UTF-8 bytes' pieces."""
        code = np.where(symbols >= UNKNOWN, symbols - UNKNOWN, 0)
        n = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        at = np.concatenate([[0], np.cumsum(n)])
        out = np.repeat(symbols, n)
        for k in np.unique(n[symbols >= UNKNOWN]).tolist():
            own = np.flatnonzero((symbols >= UNKNOWN) & (n == k))
            first = {1: 0, 2: 0xC0, 3: 0xE0, 4: 0xF0}[k]
            for j in range(k):
                rest = code[own] >> 6 * (k - 1 - j)
                out[at[own] + j] = self.byte[rest | first if j == 0 else rest & 0x3F | 0x80]
        return out, at[edge]

    # -- texts ------------------------------------------------------------------------------------

    def decoded(self, ids: list[int]) -> str:
        """Text of a segment's ids, marks as blanks; runs of byte pieces are read as UTF-8."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join(self.names[ids]).replace(MARK, " ")
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            out.append(run.decode("utf-8", "replace"))
            run.clear()
            if i >= 0:
                out.append(self.names[i].replace(MARK, " "))
        return "".join(out)

    def texts(self, ids: np.ndarray, edge: np.ndarray) -> list[str]:
        """Decoded text of each segment's ids."""
        parts, at = self.plain[ids].tolist(), edge.tolist()
        out = ["".join(parts[a:b]) for a, b in zip(at, at[1:])]
        for k in np.unique(np.searchsorted(edge, np.flatnonzero(self.part_of_char[ids]), side="right") - 1).tolist():
            out[k] = self.decoded(ids[at[k]:at[k + 1]].tolist())
        return out

    def _learn(self, keys: Iterable[str]) -> dict[str, tuple[bytes, str]]:
        """Ids and decoded text of segments not met before."""
        new = list(keys)
        if not new:
            return {}
        segments = [self.segment(k) for k in new]
        ids, edge = self.ids(*self.symbols(segments))
        text, at = self.texts(ids, edge), edge.tolist()
        if self.check:
            self._compare(segments, ids.tolist(), at, text)
        raw = ids.astype("<u4").tobytes()
        own = {k: (raw[4 * a:4 * b], t) for k, a, b, t in zip(new, at, at[1:], text)}
        for k in new[:max(0, SEGMENTS_KEPT - len(self.known))]:
            self.known[k] = own[k]
        return own

    def _compare(self, segments: list[str], ids: list[int], at: list[int], text: list[str]) -> None:
        """All ids and all text are the library's, or this fails."""
        # the library puts a mark before each text: that of the segment, or one that is taken off
        lone = [s[0] != MARK for s in segments]
        theirs = self.library.encode([(s if x else s[1:]).replace(MARK, " ") for s, x in zip(segments, lone)], num_threads=1)
        extra = [self.library.piece_to_id(MARK)]
        for s, x, a, b, other in zip(segments, lone, at, at[1:], theirs):
            if (extra + ids[a:b] if x else ids[a:b]) != other and s != MARK:  # the library has no ids for an empty text
                raise ValueError(f"not as the library has it: {s!r}")
        if self.library.decode(ids) != "".join(text).removeprefix(" "):
            raise ValueError("decoded text is not as the library has it")

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Little-endian ids, begin and end included, and the decoded text."""
        cut = [self.keys(t) for t in texts]
        seen: set[str] = set()
        seen.update(*cut)
        new = self._learn(seen - self.known.keys())
        known, rest = self.known, {k: v for k, v in new.items() if k not in self.known}
        out = []
        for keys in cut:
            got = [known[k] if k in known else rest[k] for k in keys] if rest else [known[k] for k in keys]
            out.append((b"".join([self.begin, *[g[0] for g in got], self.end]), "".join([g[1] for g in got])[1:]))
        return out


@lru_cache(maxsize=1)
def codec(model: bytes, check: bool) -> Pieces:
    return Pieces(model, check)


def _encode(model, digest: bool, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model.value, check)
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            for lo, hi in slices(off, SLICE_BYTES):
                got = own.encode([buf[a:b].tobytes().decode() for a, b in zip(off[lo:hi], off[lo + 1:hi + 1])])
                n = pa.array([len(g[0]) // 4 for g in got], pa.int64())
                if digest:
                    cols = [pa.array([hashlib.sha256(g[0]).hexdigest() for g in got]), pa.array([hashlib.sha256(g[1].encode()).hexdigest() for g in got])]
                else:
                    cols = [pa.array([np.frombuffer(g[0], "<u4").astype(np.int32) for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), n, *cols], ["doc_id", "n_tokens", "ids", "decoded"])
    return run


def encode(docs: DataFrame, model_path: str, digest: bool = False, check: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of each row, begin and end ids included; with ``digest`` the SHA-256 of
    the ids (little-endian, 32 bits) and of the decoded text instead, taken where they are made."""
    spark = docs.sparkSession
    python_ready(spark)
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    kind = "string" if digest else "array<int>"
    return slim.mapInArrow(_encode(model, digest, check), f"doc_id long, n_tokens long, ids {kind}, decoded string")
