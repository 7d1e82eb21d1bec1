"""Divergence audit, SentencePiece and Merkle manifest against brute force; clashing names, long texts, hot groups."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logweave.llm import bpe, divergence, exact, licenses, merkle, pieces, quality, queries, simhash, substring, suffix, urls
from tests.conftest import SF_SMALL
from tests.llm.test_operators import ODD, PROSE, brute_substring, fingerprint

DOC = "doc_id long, text string, lang string, source string, n_chars long"


# -- Merkle manifest ------------------------------------------------------------------------------

def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row, text):
    one = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(one(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def brute_tree(leaves):
    """Levels, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[k:k + 3])) for k in range(0, len(row), 3)])
    return levels


def brute_path(levels, at):
    out = []
    for row in levels[:-1]:
        run = at // 3 * 3
        out.append(("".join(row[run:at]), "".join(row[at + 1:run + 3])))
        at //= 3
    return out


def brute_merkle(rows, change):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, order = {}, {}
    for s in sources:
        own = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), k) for k, r in enumerate(rows) if r["source"] == s))
        order[s], trees[s] = [k for *_, k in own], brute_tree([x for _, _, x, _ in own])
    top = brute_tree([trees[s][-1][0] for s in sources])
    out = Counter()
    for i, s in enumerate(sources):
        for at, k in enumerate(order[s]):
            path = brute_path(trees[s], at) + brute_path(top, i)
            folded = leaf(rows[k], change(rows[k]))
            for a, b in path:
                folded = sha(a + folded + b)
            out[rows[k]["doc_id"], trees[s][0][at], trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), folded, folded == top[-1][0]] += 1
    return out


def drop_lines(row):
    bad = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["text"] is not None
    return row["text"].replace("\n", "") if bad else row["text"]


def merkle_query(docs):
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0
    out = merkle.manifest(docs, F.when(tampered, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"]))
    proof = F.array_join(F.transform("path", lambda step: F.concat(step["before"], step["after"])), "")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256), "version_root", F.col("version_root") == F.col("root"))


def test_merkle_odd_rows(spark):
    rows = [(1, "a\nb", "en", "s1", 3), (2, "a\nb", None, "s1", None), (2, "a\nb", None, "s1", None), (None, None, "en", None, 0), (None, "", "", "", 1),
            (3, "x" * 300_000 + "\n", "en", "big", 7), (-4, "é\n\n日本", "fr", "ünï", 1), (12, "\n", "en", "s1", 1)] + [(k, f"text {k}\n", "en", "many", k) for k in range(40)]
    docs = spark.createDataFrame(rows, DOC)
    assert Counter(map(tuple, merkle_query(docs).collect())) == brute_merkle([r.asDict() for r in docs.collect()], drop_lines)
    assert merkle_query(docs.where("false")).count() == 0
    # a lone leaf is its subroot, a lone source's subroot the root; extra columns with the operator's names stay out of it
    one = docs.where("doc_id = -4").selectExpr("*", "1 as tree", "2 as pos", "'x' as hash", "3 as `a.b`", "4 as path")
    r = merkle_query(one).collect()[0]
    assert r.leaf == r.subroot == r.root and r[4] == sha("") and len(r) == 7


def test_merkle_blocks_and_upper_levels(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    rnd = random.Random(2)
    rows = [(rnd.randrange(500), rnd.choice(("a\nb", "c")), "en", rnd.choice(("hot", "hot", *(f"s{k}" for k in range(11)))), 1) for _ in range(130)]
    # the workers see the block size through the code that the driver sends
    levels, block = merkle.height.__globals__, merkle.BLOCK
    assert levels["BLOCK"] == block == 3 and merkle.height(100) == 1 and merkle.height(3) == 1 and merkle.height(1) == 0
    got = merkle.grown([sha(str(k)) for k in range(9)], 2)
    assert got.hash == brute_tree([sha(str(k)) for k in range(9)])[-1][0]
    docs = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]
    assert sum(brute_merkle(docs, drop_lines).values()) == 130


def test_merkle_versions_share_untouched_nodes():
    leaves = [sha(str(k)) for k in range(27)]
    root = merkle.grown(leaves, 3)
    way = merkle.places(14, 3)
    version = merkle.copied(root, way, sha("changed"))
    assert version.hash == brute_tree([*leaves[:14], sha("changed"), *leaves[15:]])[-1][0]
    def nodes(n):
        return {id(n)} | {i for k in n.kids for i in nodes(k)}
    assert len(nodes(version) - nodes(root)) == 4 and len(nodes(root) & nodes(version)) == 27 + 9 + 3 + 1 - 4
    assert merkle.copied(root, way, leaves[14]).hash == root.hash
    assert [x for s in merkle.siblings(root, way) for x in s.values()] == [x for p in brute_path(brute_tree(leaves), 14) for x in p]


def test_merkle_many_blocks(spark):
    """More leaves of one source than a block holds: the path goes through blocks of blocks."""
    n = 3 * merkle.BLOCK + 17
    docs = spark.range(n).selectExpr("id as doc_id", "concat('t', id, '\n') as text", "'en' as lang", "if(id % 10 = 0, 'small', 'hot') as source", "id as n_chars")
    assert Counter(map(tuple, merkle_query(docs).collect())) == brute_merkle([r.asDict() for r in docs.collect()], drop_lines)


# -- divergence audit -----------------------------------------------------------------------------

def brute_audit(rows, min_docs, top):
    word = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        own = word.findall((text or "").translate(low))
        count[lang, source].update(own)
        df[lang].update(set(own))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        v = len(kept)
        total = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (count[lang, s][t] + 2) // (total[s] + 2 * v) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (sum(count[lang, s][t] for s in sources) + 2) // (sum(total.values()) + 2 * v) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources - {s}))
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            for part, ranked in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item, -value, k) for k, (value, _, item) in enumerate(ranked, 1)]
    return sorted(out)


def audited(df, *args):
    return sorted(map(tuple, df.transform(lambda d: divergence.audit(d, *args)).select("lang", "source", "part", "item", "value", "rank").collect()))


def test_audit_odd_rows(spark):
    rnd = random.Random(4)
    words = ["alpha", "Beta", "gammagammagamma", "gammagammagammb", "été", "日本語", "eight888ight", "abcdefgh", "abcdefghi", "Ünï", "x", "longest" * 9]
    rows = [(" ".join(rnd.choice(words) + rnd.choice((".", " 7", "\n", "")) for _ in range(rnd.randrange(12))), rnd.choice(("en", "de", None, "")), rnd.choice(("a", "b", "Ä", None))) for _ in range(120)]
    rows += [(None, "en", "empty"), (None, "only", None), ("alpha alpha", "rare", "one"), ("", "rare", "two"), (" ".join(words) * 2000, "en", "a")] + [("alpha beta", "en", "a")] * 40
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 as term", "2 as n", "3 as shard", "4 as `a.b`")
    for min_docs, top in ((3, 4), (1, 2), (10, 10), (1000, 3)):
        assert audited(docs, min_docs, top) == brute_audit(rows, min_docs, top), (min_docs, top)
    assert audited(docs.where("false")) == []


def test_audit_in_small_shards_and_slices(spark, monkeypatch):
    rows = [(r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang", "source").collect()]
    monkeypatch.setattr(divergence, "CELLS", 500)  # the driver's number of shards
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert audited(docs, 5, 10) == brute_audit(rows, 5, 10)


def test_multikey_order_and_exact_shares():
    rnd = np.random.default_rng(1)
    terms = [bytes(rnd.integers(97, 99, rnd.integers(1, 30)).astype(np.uint8)) for _ in range(500)] + [b"a" * k for k in (7, 8, 9, 16, 17, 24)]
    buf = np.concatenate([np.frombuffer(b"".join(terms), np.uint8), np.zeros(8, np.uint8)])
    sizes = np.array([len(t) for t in terms])
    order, heads = divergence.multikey(buf, np.cumsum(sizes) - sizes, sizes)
    assert [terms[k] for k in order] == sorted(terms) and heads.tolist() == [k == 0 or terms[order[k]] != terms[order[k - 1]] for k in range(len(terms))]
    assert all(a < b for a, b, h in zip(order, order[1:], heads[1:]) if not h)  # stable
    count, total = np.array([0, 1, 10**12, 8 * 10**14, 3]), np.array([9, 7, 10**13, 9 * 10**14, 5])
    assert divergence.shares(count, total).tolist() == [1 + 10**9 * (c + 2) // t for c, t in zip(count.tolist(), total.tolist())]


# -- SentencePiece --------------------------------------------------------------------------------

HARD = ["", " ", "  ", "a", " a", "a ", "a  b", "\n", "\n\n a\n", "a\nb c\n d", "▁", "▁▁a ▁", "a▁b", "<s> </s> <unk> <0x41>", "日本語 🤖 é́ 🤖\n🤖", "\x00 \x01\t\x7f", "ﬁ Ⅷ ½", "x" * 300, "ab" * 200 + " " + "é" * 150,
        " " * 700 + "z", "　   ", "don't (a)[b]{c}; 3.14 ..", "A" * 97 + "B" * 96, "\U0010ffff", "﻿bom", "word " * 50, "\r\n\r\n"]


@pytest.fixture(scope="module")
def model():
    with open(queries.tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def library(model, texts):
    import sentencepiece
    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = [own.encode(x, add_bos=True, add_eos=True) for x in texts]
    return [(i, own.decode(i)) for i in ids]


def test_pieces_equal_the_library(spark, model):
    docs = [(d, x) for d, x in ODD] + [(100 + k, x) for k, x in enumerate(HARD)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_tokens", "'x' as ids", "2 as `a.b`")
    got = Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded) for r in pieces.encode(df, queries.tokenizer_path("piece_bpe_32k.model")).collect())
    want = Counter((d, len(i), tuple(i), t) for (d, _), (i, t) in zip(docs, library(model, [x or "" for _, x in docs])))
    assert got == want and pieces.encode(df.where("false"), queries.tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_pieces_query_equals_the_library(spark, model):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), sha(t)) for r, (i, t) in zip(rows, library(model, [r.text or "" for r in rows]))}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op12_pieces(spark, SF_SMALL).collect()} == want


def test_agenda_of_one_and_of_many_segments(model):
    own = pieces.Pieces(model)
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("aeinorst▁ .éß日\x00") for _ in range(rnd.randrange(1, 60))) for _ in range(400)]
    segments = [own.segment(k) for t in texts for k in own.keys(t)]
    symbols, edge = own.symbols(segments)
    assert len(edge) == len(segments) + 1 and all(np.array_equal(own._alone(s), symbols[a:b]) for s, a, b in zip(segments, edge, edge[1:]))
    long = "".join(rnd.choice("etaoinshrdlu") for _ in range(200_000))  # one segment
    (ids, text), (want, back) = own.encode([long])[0], library(model, [long])[0]
    assert np.frombuffer(ids, "<u4").tolist() == want and text == back == long
    # a cache that is full changes nothing; a wrong id is noticed
    own.known.clear()
    pieces_kept, pieces.SEGMENTS_KEPT = pieces.SEGMENTS_KEPT, 5
    try:
        assert own.encode(HARD) == pieces.Pieces(model, check=False).encode(HARD)
    finally:
        pieces.SEGMENTS_KEPT = pieces_kept
    own.made = own.made.copy()
    own.made[:] = own.made[0]
    own.known.clear()
    with pytest.raises(ValueError, match="library"):
        own.encode(["something else entirely"])


# -- names that clash, long texts, hot groups --------------------------------------------------------

NAMES = ["quality", "_keep", "_sha", "_recipe", "_id", "_key", "n_words", "n_removed", "kept_text", "_pos", "_words_of", "_n_words", "a.b", "row", "key", "id", "no_id", "recipe",
         "text_key", "fp", "kept", "group_size", "part", "_own_id", "value", "c`d"]


@pytest.mark.parametrize("stage", range(5))
def test_stages_carry_columns_of_any_name(spark, stage):
    import corpus_pipeline
    text = lambda w: "\n".join(f"Sentence {w}{k} says {w} things about {w}topic {k * 7} in the {w}{k % 5} town." for k in range(12))
    rows = [(1, text("red")), (2, text("blue")), (3, text("red")), (4, text("green") + "\n" + text("blue"))]
    schema = "doc_id long, text string, n_chars long, " + ", ".join("`" + n.replace("`", "``") + "` string" for n in NAMES)
    docs = spark.createDataFrame([(i, x, len(x), *[f"{n}-{i}" for n in NAMES]) for i, x in rows], schema)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SF_SMALL)
    got = out.collect()
    assert got
    if stage < 4:
        assert out.schema == docs.schema or out.schema.simpleString() == docs.schema.simpleString()
        assert all([r[n] for n in NAMES] == [f"{n}-{r['doc_id']}" for n in NAMES] for r in got)
    assert {r["doc_id"] for r in got} == ({2, 3, 4} if stage == 1 else {1, 2, 4} if stage == 2 else {1, 2, 4} if stage == 3 else {1, 2, 3, 4})


LONG = "".join(f"w{k % 9973}x{k % 31} " for k in range(40_000))  # some 350 KB, one document


def test_long_texts(spark):
    """Hundreds of kilobytes in one text: words, one line, one word, one URL, many lines."""
    blob = "".join(random.Random(9).choice("etaoinshrdlu") for _ in range(100_000))
    rows = [(1, LONG), (2, LONG), (3, blob), (4, "tail " + LONG[:200_000]), (5, "\n" * 200_000 + "a b\n" * 50_000), (6, blob)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in exact.exact_dedup(docs).collect()}
    assert [got[k].keep_id for k in range(1, 7)] == [2, 2, 6, 4, 5, 6] and all(got[d].text_sha256 == sha(x) for d, x in rows)
    prints = {r.doc_id: r.fp % 2**64 for r in simhash.near_dedup(docs, 3, 2).collect()}
    assert prints == {d: fingerprint(x) for d, x in rows}
    assert Counter(map(tuple, substring.substring_dedup(docs).collect())) == brute_substring(rows)
    cut = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix.suffix_dedup(docs).collect()}
    assert cut[1] == cut[2] == (len(LONG), len(LONG)) and cut[3] == cut[6] == (100_000, 100_000) and cut[4][1] >= 200_000 and cut[5] == (400_000, 400_000)
    judged = {r.doc_id: r.quality for r in quality.judge(docs).collect()}
    assert judged[1].n_words == 40_000 and judged[3].n_words == 1 and judged[5].n_words == judged[5].n_lost_words == 100_000 and judged[3].base_failed
    found = {r.doc_id: r for r in licenses.scan(docs.union(spark.createDataFrame([(7, LONG + " MIT license " + LONG)], docs.schema))).collect()}
    assert found[7].n_base == 1 and found[7].first_word == 40_000 and found[1].n_words == 40_000
    pages = [(1, "http://a.com/" + "a" * 50_000), (2, "http://b.net/es/" + "z" * 50_000), (3, "x" * 30_000)]
    assert {r.page_id: r.rule for r in urls.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), queries.URL_RULES).collect()} == {1: "com/", 2: "net/es/", 3: None}


def test_bpe_word_of_many_characters(spark):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path("word_bpe_49k.json")
    word = "".join(random.Random(3).choice("etaoinshrdlu") for _ in range(250_000))
    got = bpe.encode(spark.createDataFrame([(1, word)], "doc_id long, text string"), path).collect()[0]
    ids = Tokenizer.from_file(path).encode(word, add_special_tokens=False).ids
    assert got.n_tokens == len(ids) and got.ids == " ".join(map(str, ids))


def test_exact_dedup_of_a_hot_text(spark):
    rows = [(k, "hot text") for k in range(3000)] + [(5000 + k, f"own text {k}") for k in range(3000)] + [(9000, None), (None, "")] + [(9100 + k, PROSE * 600) for k in range(20)]
    got = exact.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    by = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got.collect()}
    assert len(by) == len(rows) and by[7] == (2999, 3000, False) and by[2999] == (2999, 3000, True) and by[5001] == (5001, 1, True)
    assert by[9000] == (9000, 2, True) and by[9101] == (9119, 20, False)


# -- quality lines and URLs -----------------------------------------------------------------------

def test_quality_keeps_headings_verse_and_code(spark):
    para, more, most = "This paragraph says enough about its subject to be read by anyone.", "Next we tell how each figure was won, and by whom.", "At last the outcome is weighed against what others found before us."
    article = f"Introduction\n{para}\n\nMethods\n{more}\n\nResults and discussion\n{most}"
    verse = "\n".join(["The curfew tolls the knell of day,", "The herd wind slowly over the lea,", "The plowman homeward plods his way,", "And leaves the world to darkness", "and to me, who sit here still."] * 2)
    code = "\n".join(["def area(width, height):", "    total = width * height", "    half = total / 2", "    return half", "for k in range(10):", "    area(k, k + 1)", "    step = k", "    last = step", "    done = last"])
    menu = "Home\nNews\nContact\nAbout us\n" + para + "\n" + more
    got = {r.doc_id: r.quality for r in quality.judge(spark.createDataFrame([(1, article), (2, verse), (3, code), (4, menu)], "doc_id long, text string")).collect()}
    assert got[1].clean == article and got[1].kept
    assert got[2].n_lost_words == 0 and got[2].clean == verse
    assert got[3].n_lost_words == 0 or got[3].clean.startswith("def area")
    assert "News" not in got[4].clean and para in got[4].clean and got[4].n_lost_words == 5


def test_url_words_behind_the_question_mark_count(spark):
    """An independent reading of the model: query words alone tell good from bad."""
    pages = [(k, f"http://shop{k}.com/p?item=book{k}") for k in range(80)] + [(200 + k, f"http://shop{k}.net/es/p?casino=win{k}") for k in range(80)]
    pages += [(900, "http://shop.org/p?item=book"), (901, "http://shop.org/p?casino=win"), (902, "http://shop.org/p#casino=win"), (903, "HTTP://SHOP.org/p?item=book")]
    df = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "1 as s", "2 as held", "3 as `a.b`", "'x' as host")
    got = {r.page_id: r for r in urls.filter_urls(df, queries.URL_RULES).collect()}
    assert [got[k].verdict for k in (900, 901, 902)] == ["allow", "block", "block"] and got[900].score == got[903].score
    assert (got[901].host, got[901].path) == (got[902].host, got[902].path) == ("shop.org", "/p")


def test_chunk_identifiers_of_equal_texts_agree_across_slices():
    text = (PROSE * 900).encode()  # more than one slice
    batch_of = lambda rows: __import__("pyarrow").RecordBatch.from_pydict({"doc_id": list(range(len(rows))), "text": rows})
    out = [r for b in exact._recipes(0)([batch_of([text.decode(), "x", text.decode()])]) for r in b.column("recipe").to_pylist()]
    assert out[0] == out[2] != out[1] and out[1] == xxhash.xxh3_128_digest(b"x", 0)


def brute_licenses(text):
    """(n_base, labels, best share) by taking every template's hits one by one."""
    m = licenses
    w = [x for x in re.split(m.NOT_WORD, "".join(c.lower() if c.isascii() else c for c in text)) if x]
    n_base, labels, best = 0, set(), 0.0
    for _, own, label, base, k in m.numbered():
        spots, n = {}, len(own) - k + 1
        for j in range(n):
            spots.setdefault(tuple(own[j:j + k]), []).append(j)
        hits = sorted((i - j, j, i) for i in range(len(w) - k + 1) for j in spots.get(tuple(w[i:i + k]), ()))
        groups = []
        for hit in hits:
            if groups and (hit[0] == groups[-1][-1][0] or not base and hit[0] - groups[-1][-1][0] <= m.GAP):
                groups[-1].append(hit)
            else:
                groups.append([hit])
        for g in groups:
            votes, span = len({j for _, j, _ in g}), max(i for *_, i in g) - min(i for *_, i in g) + k
            if votes == n if base else 100 * votes >= m.SHARE_PERCENT * n and 100 * span <= m.LENGTH_PERCENT * len(own):
                n_base, best = n_base + base, max(best, votes / n)
                labels.add(label)
    return n_base, ",".join(sorted(labels)), round(best, 6)


def test_whole_license_texts(spark):
    m = licenses
    texts = [x for x, _ in m.TEXTS]
    changed = lambda x, every, put: " ".join(put(w) if k % every == every - 1 else w for k, w in enumerate(x.split()))
    rows = ["Copyright (c) 2001 Someone\n\n" + x for x in texts] + [x.upper() for x in texts]
    rows += [changed(x, 20, lambda w: "") for x in texts] + [changed(x, 24, lambda w: w + " indeed") for x in texts] + [changed(x, 3, lambda w: "other") for x in texts]
    rows += [changed(texts[0], 20, lambda w: w + " and more of the"), "of the software " * 3000, " ".join(texts), texts[0][:300] + " gap " * 400 + texts[0][300:], "the license",
             texts[1] + " MIT License. mit license", "GNU General Public License of the " * 50, "", "mit"]
    got = {r.doc_id: r for r in m.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert {d: (r.n_base, r.labels, r.score) for d, r in got.items()} == {d: brute_licenses(x) for d, x in enumerate(rows)}
    n = len(texts)
    for start in (0, n, 2 * n, 3 * n):  # as they are, in capitals, with words left out, with words added
        assert all(label in got[start + k].labels.split(",") for k, (_, label) in enumerate(m.TEXTS)), start
    alone = m.scan(spark.createDataFrame([(k, x) for k, x in enumerate(rows[4 * n:5 * n])], "doc_id long, text string"), templates=())
    assert all(r.labels == r.base_labels for r in alone.collect())  # every third word is another: no whole text, base phrases only
    assert all(w == w.lower() for _, own, *_ in m.numbered() for w in own)
    with pytest.raises(ValueError):
        m.numbered(texts=(("too short", "x"),))
