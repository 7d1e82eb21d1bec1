"""Operator 8, BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one token that ends the BPE encoding of that prefix. An
automaton finds all vocabulary tokens that are suffixes of each prefix; such a token t is the last
one iff the rest is empty or its own last token is compatible with t, that is, BPE leaves the pair
alone. Back-pointers from the whole word give the ids. Each step is done for all distinct words of
a task's slice at once, and compatibility is decided once for each distinct pair.

Compatibility of (l, r): undo merges at the border, the latest first; if at any time the two
tokens at the border could have merged before the merges still in place, BPE would have joined them.

Defined cases: a null or empty text has no tokens and decodes to the empty text. Special tokens
written in a text are their ids. Repeated rows are encoded each; other columns are left behind.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, slices, text_buffer
from .packing import byte_symbols, read_vocabulary

#: Marks the end of a word behind its last symbol; no byte-level symbol.
END = "\x01"
#: Characters whose normal form, lower case and class are plain: U+0000 to U+017F but for U+0130,
#: U+0149 and U+017F. Texts with others go through the library's own normalizer and splitter.
PLAIN = re.compile("[\x00-įı-ňŊ-ž]*")
LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xffĀ-ſ"
WHITE = "\t-\r \x85\xa0"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{WHITE}{LETTER}{NUMBER}]+")
WORDS_KEPT = 300_000


class Codec:
    def __init__(self, vocabulary: str):
        import ahocorasick
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not suffix or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("not a plain BPE vocabulary with word ends")
        vocab: dict[str, int] = model["vocab"]
        self.names = np.empty(max(vocab.values()) + 1, object)
        for token, i in vocab.items():
            self.names[i] = token
        n = len(self.names)
        self.numbers = np.array([str(i) for i in range(n)], object)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: For each token the merge that makes it: rank (-1 for symbols), left and right part.
        self.rank, self.left, self.right = np.full(n, -1, np.int64), np.arange(n), np.arange(n)
        keys, made = [], []
        for rank, (a, b) in enumerate(merges):
            l, r, t = vocab[a], vocab[b], vocab[a + b]
            if self.rank[t] >= 0:
                raise ValueError(f"two merges make {a + b!r}")
            self.rank[t], self.left[t], self.right[t] = rank, l, r
            keys.append(l << 32 | r)
            made.append(rank)
        order = np.argsort(keys)
        self.pair, self.pair_rank = np.array(keys, np.int64)[order], np.array(made, np.int64)[order]
        self.known: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, bool))
        self.symbol = {b: c for c, b in byte_symbols().items()}
        self.table = bytes(range(256)).decode("latin-1").translate({b: c for b, c in self.symbol.items()})
        # tokens that BPE itself never makes from their own text cannot end a prefix
        real = [t for t in range(n) if self.names[t] is not None]
        split = np.array([t for t in real if self.rank[t] >= 0])
        own = np.ones(n, bool)
        for some in np.array_split(split[np.argsort(self.rank[split])], 64):
            own[some] = own[self.left[some]] & own[self.right[some]] & self._joined(some)
        self.automaton, self.size = ahocorasick.Automaton(), np.zeros(n, np.int64)
        for t in real:
            if own[t]:
                token = self.names[t]
                token = token[:-len(suffix)] + END if token.endswith(suffix) else token
                self.automaton.add_word(token, t)
                self.size[t] = len(token)
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_name = {i: c for c, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.library = Tokenizer.from_str(vocabulary)
        self.words: dict[str, tuple[str, str]] = {}

    def _merge_rank(self, l: np.ndarray, r: np.ndarray) -> np.ndarray:
        key = l << 32 | r
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], 1 << 40)

    def _left_alone(self, l: np.ndarray, r: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether BPE, up to merges of rank ``limit``, never joins anything across the border of l | r."""
        l, r, limit = l.copy(), r.copy(), limit.copy()
        good, live = np.ones(len(l), bool), np.arange(len(l))
        while len(live):
            a, b = l[live], r[live]
            clash = self._merge_rank(a, b) < limit[live]
            good[live[clash]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~clash & (np.maximum(ra, rb) >= 0)
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            # the later of the two merges is undone; from then on only earlier ones are in place.
            # of equal ranks the left one came first, so the right one is undone first
            undo_left = ra > rb
            l[live] = np.where(undo_left, self.right[a], a)
            r[live] = np.where(undo_left, b, self.left[b])
            # a pair of the same rank as a merge still standing on the left would have gone first there
            limit[live] = np.where(undo_left, ra, rb + 1)
        return good

    def _joined(self, t: np.ndarray) -> np.ndarray:
        """Whether a token's two parts stay apart until its own merge."""
        l, r = self.left[t], self.right[t]
        good = np.ones(len(t), bool)
        # undo one merge first: the pair itself may merge at its own rank, but nothing earlier
        return good & self._left_alone(l, r, self.rank[t])

    def compatible(self, l: np.ndarray, r: np.ndarray) -> np.ndarray:
        key, back = np.unique(l << 32 | r, return_inverse=True)
        seen, answer = self.known
        at = np.minimum(np.searchsorted(seen, key), max(len(seen) - 1, 0))
        old = seen[at] == key if len(seen) else np.zeros(len(key), bool)
        out = np.zeros(len(key), bool)
        out[old] = answer[at[old]]
        new = ~old
        if new.any():
            k = key[new]
            out[new] = self._left_alone(k >> 32, k & 0xFFFFFFFF, np.full(len(k), 1 << 39))
            if len(seen) > 4_000_000:
                seen, answer = key[:0], out[:0]
            merged = np.concatenate([seen, k])
            order = np.argsort(merged, kind="stable")
            self.known = merged[order], np.concatenate([answer, out[new]])[order]
        return out[back]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of each word (byte-level symbols, without the end mark)."""
        out: list[np.ndarray] = []
        lo = 0
        while lo < len(words):
            hi, total = lo, 0
            while hi < len(words) and (hi == lo or total + len(words[hi]) + 1 <= 400_000):
                total += len(words[hi]) + 1
                hi += 1
            out += self._encode_some(words[lo:hi])
            lo = hi
        return out

    def _encode_some(self, words: list[str]) -> list[np.ndarray]:
        size = np.array([len(w) + 1 for w in words], np.int64)
        base = np.cumsum(size) - size
        text = END.join(words) + END
        found = np.fromiter(self.automaton.iter(text), dtype=[("end", "<i4"), ("token", "<i4")])
        end, token = found["end"].astype(np.int64) + 1, found["token"].astype(np.int64)
        start = end - self.size[token]
        word = np.searchsorted(base, end - 1, side="right") - 1
        inside = start >= base[word]  # an end mark closes its word, so no token spans two
        end, token, start, word = end[inside], token[inside], start[inside], word[inside]
        step = end - base[word]
        order = np.argsort(step, kind="stable")
        edges = np.searchsorted(step[order], np.arange(1, int(size.max()) + 2))
        last, came = np.full(len(text) + 1, -1, np.int64), np.zeros(len(text) + 1, np.int64)
        for a, b in zip(edges[:-1], edges[1:]):
            k = order[a:b]
            if not len(k):
                continue
            first = start[k] == base[word[k]]
            before = last[start[k]]
            good = first | (before >= 0)
            test = np.flatnonzero(good & ~first)
            if len(test):
                good[test] = self.compatible(before[test], token[k[test]])
            k = k[good]
            last[end[k]], came[end[k]] = token[k], start[k]
        # back-pointers, all words at once
        at, live, parts = base + size, np.arange(len(words)), []
        while len(live):
            t = last[at[live]]
            if (t < 0).any():
                raise ValueError(f"no encoding of {words[live[t < 0][0]]!r}")
            parts.append((live, t))
            at[live] = came[at[live]]
            live = live[at[live] > base[live]]
        who, ids = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(who, kind="stable")
        ids = ids[order]
        edge = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(words)))])
        return [ids[a:b][::-1] for a, b in zip(edge[:-1], edge[1:])]

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens."""
        if PLAIN.fullmatch(text):
            return SPLIT.findall(text.lower())
        symbols = {c: b for b, c in self.symbol.items()}
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(symbols[c] for c in p).decode("utf-8", "surrogateescape") for p, _ in parts]

    def _learn(self, words: list[str]) -> dict[str, tuple[str, str]]:
        """Ids joined and tokens joined of each word."""
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        new = [w for w in words if w not in self.words]
        raw = [w.encode("utf-8", "surrogateescape").decode("latin-1").translate(self.symbol) for w in new]
        own = {w: self.words[w] for w in words if w in self.words}
        for w, ids in zip(new, self.encode_words(raw)):
            own[w] = " ".join(self.numbers[ids]), " ".join(self.names[ids])
        for w in new[:max(0, WORDS_KEPT - len(self.words))]:
            self.words[w] = own[w]
        return own

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of tokens, ids joined by blanks, and decoded text of each text."""
        split: list[list[str]] = []
        for text in texts:
            pieces = self.cut.split(text) if self.cut and "<" in text else [text]
            words: list[str] = []
            for k, piece in enumerate(pieces):
                words += [f"\x00{piece}"] if k % 2 else self.split(piece)
            split.append(words)
        flat = [w for words in split for w in words]
        distinct = list(dict.fromkeys(flat))
        special = {f"\x00{c}": (str(i), c) for c, i in self.special.items()}
        known = special | self._learn([w for w in distinct if w not in special])
        out = []
        for words in split:
            got = [known[w] for w in words]
            ids = " ".join([g[0] for g in got])
            out.append((ids.count(" ") + 1 if got else 0, ids, " ".join([g[1] for g in got])))
        return out


@lru_cache(maxsize=1)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def _encode(vocabulary, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary.value)
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            for lo, hi in slices(off, 4 << 20):
                got = own.encode([buf[a:b].tobytes().decode() for a, b in zip(off[lo:hi], off[lo + 1:hi + 1])])
                n = pa.array([g[0] for g in got], pa.int64())
                if digest:
                    cols = [[hashlib.sha256(g[k].encode()).hexdigest() for g in got] for k in (1, 2)]
                else:
                    cols = [[g[1] for g in got], [g[2] for g in got]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), n, *map(pa.array, cols)], ["doc_id", "n_tokens", "ids", "decoded"])
    return run


def encode(docs: DataFrame, vocabulary_path: str, digest: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of each row: decimal ids joined by one blank and what they
    decode to; with ``digest`` the SHA-256 of both instead, taken where they are made."""
    spark = docs.sparkSession
    python_ready(spark)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(_encode(vocabulary, digest), "doc_id long, n_tokens long, ids string, decoded string")
