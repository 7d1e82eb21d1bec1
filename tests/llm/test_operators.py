"""Every operator against a brute-force version or its SQL, on sf0.001 and on a table of odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from logweave.llm import bpe, exact, licenses, packing, quality, queries, sharding, simhash, substring, suffix, urls
from logweave.plans.verify import compare, duck
from tests.conftest import SF_SMALL

PROSE = " ".join(f"word{k % 97}x{k}" for k in range(300))
ODD = [(1, PROSE), (2, PROSE), (2, PROSE), (3, None), (4, ""), (None, PROSE), (None, None), (5, " \t\n\x0b "), (6, "a"), (7, "Licensed under the MIT License."),
       (8, "z " * 5000), (9, "start " + PROSE[:1200] + " end"), (10, "été ß <|endoftext|> " + PROSE[200:]), (11, "GNU general-public LICENSE, Apache license")]


@pytest.fixture(scope="module")
def odd(spark):
    # extra columns, some with names the operators use themselves
    return spark.createDataFrame([(d, x, "k", d, 0.5) for d, x in ODD], "doc_id long, text string, text_key string, fp long, kept double")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}


def by_id(df, *cols):
    return {r.doc_id: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    res = compare(queries.QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), queries.SQL[name])
    assert res["ok"], res


def test_sharding_fits_and_splits_only_full_buckets(spark, odd, none):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sharding.shard(docs, 20_000).collect()
    size, members = Counter(), defaultdict(set)
    for r in rows:
        size[r.shard] += r.n_bytes
        members[r.shard].add(r.doc_id)
    assert len(rows) == docs.count() and len(size) > 8
    assert all(n <= 20_000 or len(members[s]) == 1 for s, n in size.items())
    assert all(sum(n for t, n in size.items() if t.startswith(s[:-1])) > 20_000 for s in size if s)
    assert len(sharding.shard(odd, 100).collect()) == len(ODD) and sharding.shard(none, 100).count() == 0


def packed(df, ids):
    seqs, parts = defaultdict(list), defaultdict(list)
    for r in df.collect():
        own = np.frombuffer(r.ids, "<u4")
        assert own.tolist() == ids[r.doc_id][r.start:r.start + r.length] and r.doc_tokens == len(ids[r.doc_id])
        seqs[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id].append((r.start, r.length))
    for v in [*seqs.values()]:
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(v), sorted(v)[1:])) and min(v)[0] == 0
    assert sum(sum(n for _, n in v) < 64 for v in seqs.values()) <= 1
    return parts


def test_packing(spark, odd, none):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    docs = texts(spark)
    ids = {d: own.encode(x, add_special_tokens=False).ids + [1] for d, x in docs.items()}
    parts = packed(packing.pack(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), path, 64, 1), ids)
    assert {d: sum(n for _, n in p) for d, p in parts.items()} == {d: len(x) for d, x in ids.items()}
    rows = packing.pack(odd, path, 64, 1).collect()
    assert sum(r.length for r in rows) == sum(len(own.encode(x or "", add_special_tokens=False).ids) + 1 for _, x in ODD)
    assert packing.pack(none, path, 64, 1).count() == 0
    crc = queries.op2_packing(spark, SF_SMALL).first()
    assert crc.ids_crc32 == zlib.crc32(np.array(ids[crc.doc_id][crc.start:crc.start + crc.length], "<u4").tobytes())


def test_url_rules_and_model(spark):
    rows = [(1, "HTTP://A.Com/x?y"), (2, "http://example.com/en/1"), (3, "http://www.example.com/en/1"), (4, None), (5, ""), (6, "no scheme"),
            (7, "http://b.net/es/#"), (8, "http://com"), (9, "http://notexample.org/en/?q"), (2, "http://example.com/en/1")]
    got = {r.page_id: tuple(r)[1:5] for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES).collect()}
    assert got[1] == ("a.com", "/x", "com/", "allow") and got[2] == ("example.com", "/en/1", "example.com/en/", "block")
    assert got[3][2:] == ("www.example.com/en/", "allow") and got[4][:3] == got[5][:3] == got[6][:3] == ("", "", None)
    assert got[7] == ("b.net", "/es/", "net/es/", "block") and got[8][:3] == ("com", "", None)
    # a model taught that good URLs hold "aaa" and bad ones "zzz" tells unseen ones apart
    taught = [(k, f"http://aaa{k}.com/aaa") for k in range(60)] + [(100 + k, f"http://zzz{k}.net/es/zzz") for k in range(60)] + [(500, "http://aaa.org/aaa"), (501, "http://zzz.org/zzz")]
    out = {r.page_id: r.verdict for r in urls.filter_urls(spark.createDataFrame(taught, "page_id long, url string"), queries.URL_RULES).collect()}
    assert out[500] == "allow" and out[501] == "block"
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string"), queries.URL_RULES).count() == 0


def test_exact_dedup_odd_rows(odd, none):
    rows = {(r.doc_id, r.text_sha256): r for r in exact.exact_dedup(odd).collect()}
    prose = hashlib.sha256(PROSE.encode()).hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[1, prose].keep_id == 2 and rows[1, prose].group_size == 4 and not rows[1, prose].kept and rows[2, prose].kept
    assert rows[3, empty].keep_id == 4 and rows[4, empty].kept and not rows[None, empty].kept and exact.exact_dedup(none).count() == 0


def test_chunk_identifiers_are_verified():
    clash = exact.xxhash.xxh3_128_digest
    text = np.frombuffer(PROSE.encode() * 9, np.uint8)
    cuts = exact._cuts(text).tolist()
    ends = exact._chunk_ends(cuts, 0, len(text))
    assert ends[-1] == len(text) and all(a < b for a, b in zip(ends, ends[1:])) and clash(b"a", 1) != clash(b"a", 2)
    # what stands before a text does not move its cuts
    moved = np.concatenate([np.frombuffer(b"some other text " * 40, np.uint8), text])
    shift = len(moved) - len(text)
    assert [e - shift for e in exact._chunk_ends(exact._cuts(moved).tolist(), shift, len(moved))] == ends


def fingerprint(text):
    w = text.encode().lower().split()
    sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    ids, root = sorted(prints), {d: d for d in prints}
    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def test_simhash(spark, odd, none):
    prints = {d: fingerprint(x) for d, x in texts(spark).items()}
    comp = brute_components(prints)
    assert by_id(queries.op5_simhash(spark, SF_SMALL), "fingerprint", "component_id") == {d: (f"{p:016x}", comp[d]) for d, p in prints.items()}
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.near_dedup(odd, 3, 2).collect()}
    assert got[3, 0] == got[None, 0] == got[4, 0] == 3 and simhash.near_dedup(none, 3, 2).count() == 0
    assert {r.doc_id for r in simhash.keep_one(odd, 3, 2).collect()} >= {1, 3, 6} and simhash.keep_one(odd, 3, 2).columns == odd.columns


def test_anchors_cover_every_near_pair():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 300, dtype=np.int64)
    b = a.copy()
    for k in range(300):
        for bit in rng.choice(64, k % 3, replace=False):
            b[k] ^= np.int64(np.uint64(1 << int(bit)).view(np.int64))
    row, home = simhash.anchors(a, 2, home=True)
    assert row.tolist() == list(range(300))
    row, near = simhash.anchors(b, 2)
    assert all(home[k] in set(near[row == k].tolist()) for k in range(300)) and len(set(zip(row.tolist(), near.tolist()))) == len(row)


def test_quality_odd_rows(odd, none):
    rows = quality.judge(odd).collect()
    assert len(rows) == len(ODD) and {r.kept for r in quality.kept_and_cleaned(odd).collect()} == {0.5}  # the input's own column stays
    by = {r.doc_id: r.quality for r in rows if r.doc_id}
    assert by[3].n_words == by[4].n_words == by[5].n_words == 0 and by[3].base_failed and by[1].kept and by[8].n_repeat_words == 5000
    assert quality.judge(none).count() == 0


def test_quality_lines(spark):
    good = "\n".join(f"This sentence number {k} says something of its own about topic {k * 7}." for k in range(8))
    menu = "Home\nNews\nContact\n" + good + "\nAll rights reserved."
    bars = "\n".join(" | ".join(f"item{k}{j}" for j in range(9)) for k in range(6))
    got = {r.doc_id: r.quality for r in quality.judge(spark.createDataFrame([(1, good), (2, menu), (3, bars), (4, "WOW!! " + "!! ".join(good.split()))], "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].clean == good and got[2].kept and got[2].clean == good and got[2].n_lost_words == 6
    assert not got[3].kept and not got[3].base_failed and not got[4].kept


def test_license_odd_rows(spark, odd, none):
    got = {r.doc_id: r for r in licenses.scan(odd).collect()}
    assert (got[7].n_base, got[7].first_word, got[7].base_labels, got[7].score) == (1, 3, "mit", 1.0)
    assert (got[11].n_base, got[11].first_word, got[11].last_word, got[11].base_labels) == (2, 1, 4, "apache,gpl") and got[3].n_words == 0
    text = "This program is free software, you can redistribute it and/or (really) modify it under the terms of the GNU General Public License."
    one = licenses.scan(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")).collect()
    assert len(one) == 2 and one[0] == one[1] and one[0].labels == "gpl" and one[0].n_base == 1 and licenses.scan(none).count() == 0


@pytest.mark.parametrize("name", ["sf", "odd"])
def test_bpe(spark, odd, none, name):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    docs = [(d, x) for d, x in ODD] if name == "odd" else list(texts(spark).items())
    if name == "odd":
        docs += [(20 + k, x) for k, x in enumerate(["ΣΑΣ İstanbul ﬁ", "日本語 🎉🎉 é", "a\x1cb\x85c\xa0d", "don't we'll '''s", "<|startoftext|>x<|endoftext|>", "aaaa" * 300, "\x00\x01 Ⅷ½"])]
    got = bpe.encode(spark.createDataFrame(docs, "doc_id long, text string"), path).collect()
    want = Counter()
    for d, x in docs:
        ids = own.encode(x or "", add_special_tokens=False).ids
        want[d, len(ids), " ".join(map(str, ids)), own.decode(ids, skip_special_tokens=False)] += 1
    assert Counter(map(tuple, got)) == want and bpe.encode(none, path).count() == 0


def brute_substring(rows, n=50):
    words = [(d, (x or "").encode().split()) for d, x in rows]
    least = {}
    for d, w in words:
        for i in range(len(w) - n + 1):
            key = tuple(w[i:i + n])
            if d is not None:
                least[key] = min(d, least.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - n + 1):
            if d is not None and least[tuple(w[i:i + n])] < d:
                gone.update(range(i, i + n))
        out.append((d, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return Counter(out)


def test_substring(spark, odd, none):
    docs = list(texts(spark).items())
    got = substring.substring_dedup(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert Counter(map(tuple, got.collect())) == brute_substring(docs)
    assert Counter(map(tuple, substring.substring_dedup(odd).collect())) == brute_substring(ODD) and substring.substring_dedup(none).count() == 0


def brute_suffix(rows, n=400):
    data = [(d, (x or "").encode()) for d, x in rows]
    seen = Counter(b[i:i + n] for _, b in data for i in range(len(b) - n + 1))
    out = []
    for d, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                gone[i:i + n] = True
        edge = np.flatnonzero(np.diff(gone.astype(int), prepend=0, append=0))
        out.append((d, len(b), int(gone.sum()), len(edge) // 2, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return Counter(out)


def test_suffix(odd, none):
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix.suffix_dedup(odd).collect())
    assert got == brute_suffix(ODD) and suffix.suffix_dedup(none).count() == 0


def test_suffix_query(spark):
    docs = texts(spark)
    want = {r[0]: (r[1], r[2], r[3], hashlib.sha256(r[4]).hexdigest()) for r in brute_suffix(list(docs.items()))}
    assert by_id(queries.op10_suffix_array(spark, SF_SMALL), "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_difference_cover():
    assert {(a - b) % suffix.MODULUS for a in suffix.COVER for b in suffix.COVER} == set(range(suffix.MODULUS))


def test_pipeline(spark, odd):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        nxt = stage(spark, kept, SF_SMALL)
        assert nxt.columns == docs.columns and nxt.schema.simpleString() == docs.schema.simpleString(), name
        kept = spark.createDataFrame(nxt.collect(), docs.schema)
    rows = {r.doc_id: r for r in kept.collect()}
    assert len(rows) == kept.count() and 0 < len(rows) < docs.count() and all(r.n_chars == len(r.text) for r in rows.values())
    assert len({r.text for r in rows.values()}) == len(rows)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF_SMALL).select("doc_id").collect()} == set(rows)
    assert not [d for d, x in rows.items() if len(re.findall(r"[^\x20\x09-\x0D]+", x.text)) == 0]


def test_exchange_spreads_copies_of_one_text():
    from logweave.llm import exchange
    n, copies = 16, 4000
    ids, keys = np.arange(copies) * 7 - 50, np.full(copies, 12345)
    who = np.stack([ids, keys], axis=1)
    hits = exchange._hits(who, np.full(copies, 2), np.tile([3, 9], copies), np.ones(2 * copies, bool), n)
    held = {part: len(docs) // 16 for part, docs, _, _ in hits}
    assert len(held) == n and sum(held.values()) == copies and max(held.values()) < 2 * copies / n
    # settled entries of slices that all begin with the hot window
    doc, pos = np.repeat(np.arange(copies), 2), np.tile([3, 9], copies)
    rows = exchange.pack(np.full(2 * copies, 2**40, np.uint64), doc, pos, ids, keys, n, True, np.ones(2 * copies, bool)).to_pydict()
    assert sorted(rows["bucket"]) == list(range(n)) and max(map(len, rows["docs"])) < 2 * 16 * copies / n and set(rows["rem"]) == {b""}


def test_exchange_sends_repeated_rows_once_a_slice():
    import pyarrow as pa
    from logweave.llm import exchange
    texts = ["abc", "abc", "abc", "abd"]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 5, 6, 5]), pa.array([1, 1, 1, 2]), pa.array(texts)], ["doc_id", "text_key", "text"])
    windows = lambda buf, off, batch, lo, hi: (np.arange(lo, hi).astype(np.uint64), np.arange(hi - lo), np.zeros(hi - lo, np.int64))
    assert [doc.tolist() for _, doc, *_ in exchange.hashed([batch], windows)] == [[0, 2, 3]]


def test_many_copies_under_substring_and_suffix(spark):
    rows = [(k, PROSE) for k in range(40)] + [(7, PROSE)] * 20 + [(None, PROSE)] * 20 + [(50, "own words " * 3 + PROSE[300:1500]), (51, PROSE + " tail of its own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, substring.substring_dedup(docs).collect())) == brute_substring(rows)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix.suffix_dedup(docs).collect())
    assert got == brute_suffix(rows)


def test_long_white_space_is_encoded(spark):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path("byte_bpe_50k.json")
    own, n = Tokenizer.from_file(path), 2_000_000
    rows = ["a" + " " * n + "b", "\n" * n, "a b" + " \n\t" * 6000 + "\n<|endoftext|>" + "\u3000\x1c" * 9000 + " " * 12000 + "'s", " " * 20000 + "<|endoftext|>", "x" + "\r\n" * 5000 + "  y" + " " * 9999 + "z" + " " * 10001]
    vocabulary = packing.read_vocabulary(path)
    for x in rows:
        assert np.array_equal(packing._encode(vocabulary, x), own.encode(x, add_special_tokens=False).ids)
    got = packing.pack(spark.createDataFrame([(1, rows[0])], "doc_id long, text string"), path, 1 << 23).collect()
    assert [r.length for r in got] == [len(own.encode(rows[0], add_special_tokens=False).ids) + 1]


def test_sharding_decides_each_pass_once(spark):
    """The directory is read from files: neither the question for another pass nor a later reader sums the bytes again."""
    rows = [(k, 300) for k in range(4)] + [(k << 50, 300) for k in range(1, 9)]
    hashed = spark.createDataFrame(rows, "h long, n_bytes long")
    found = sharding.directory(hashed, 400)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "Aggregate" not in plan and "LogicalRDD" not in plan and "LocalRelation" not in plan
    assert sum(r.shard_bytes for r in found.collect()) == 12 * 300 and max(r.depth for r in found.collect()) == sharding.BITS


def test_sharding_with_one_deep_shard(spark):
    hashes = sorted((int(hashlib.md5(str(d).encode()).hexdigest()[:15], 16), d) for d in range(200_000))
    (a, x), (b, y) = min(zip(hashes, hashes[1:]), key=lambda p: p[0][0] ^ p[1][0])
    depth = sharding.BITS - (a ^ b).bit_length() + 1
    assert depth > 30
    docs = spark.createDataFrame([(d, "t" * 200) for d in (x, y)] + [(300_000 + k, "t") for k in range(50)], "doc_id long, text string")
    got = {r.doc_id: r for r in sharding.shard(docs, 100).collect()}
    assert len(got) == 52 and got[x].depth == got[y].depth == depth and got[x].shard_bytes == 200
    assert (got[x].shard, got[y].shard) == tuple(f"{h:060b}"[:depth] for h in (a, b))
    assert all(f"{int(hashlib.md5(str(d).encode()).hexdigest()[:15], 16):060b}".startswith(r.shard) for d, r in got.items())


def test_pipeline_keeps_one_of_repeated_and_null_id_rows(spark):
    import corpus_pipeline
    a, b, c, d = ("\n".join(f"Sentence {p}{k} says {p} things about {p}topic {k * 7} in the {p}{k % 5} town of {p}place." for k in range(12)) for p in ("red", "blue", "green", "grey"))
    near = lambda x: x.replace(" says ", "  says ")  # noqa: E731  (the same words, another text)
    rows = 2 * [(1, a), (2, a), (3, b), (4, near(b)), (None, c), (None, near(c)), (None, d)]
    docs = spark.createDataFrame([(i, x, len(x), 0.5) for i, x in rows], "doc_id long, text string, n_chars long, kept double")
    want = {"quality_rules": 14, "exact_dedup": 6, "near_dedup": 4, "substring_dedup": 4}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).collect(), docs.schema)
        assert docs.count() == want[name], name
    got = docs.collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 0, 2, 3] and {" ".join(r.text.split()) for r in got} == {" ".join(x.split()) for x in (a, b, c, d)}
    packed_rows = corpus_pipeline.pack(spark, docs, SF_SMALL).where("start = 0").collect()
    assert sorted(r.doc_id or 0 for r in packed_rows) == [0, 0, 2, 3]
