"""The pipeline's rows against a brute-force version of all five stages, on sf0.001 with planted rows."""

import re
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from logweave.llm import queries
from tests.conftest import SF_SMALL
from tests.llm.test_operators import brute_components, brute_substring, fingerprint

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NOTICES = ("all rights reserved", "cookie policy", "accept cookies", "privacy policy", "terms of use", "terms of service", "click here",
           "sign up", "subscribe to", "enable javascript", "lorem ipsum", "skip to content", "powered by")


def brute_quality(text):
    """The text without failing lines, or None if the document is rejected."""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    under = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    if len(words) < 20 or 100 * len(under) > 30 * len(words):
        return None
    lines = [x for x in text.split("\n") if WORD.search(x)]
    sizes = [len(WORD.findall(x)) for x in lines]

    def entry(k):
        x = lines[k] if 0 <= k < len(lines) else " "
        return len(x.encode()) <= 40 and x[0] not in " \t" and x.rstrip(" \t\n\x0b\x0c\r")[-1] not in '.!?…:;,"”»)]}' and sizes[k] <= 4

    def fails(k):
        x, n = lines[k], sizes[k]
        cries, bars = (sum(x.count(c) for c in chars) for chars in ("!?", "#*$%&|<>=~^{}"))
        notice = len(x.encode()) <= 250 and any(p in x.lower() for p in NOTICES)
        return n >= 3 and 2 * cries >= n or 4 * bars >= n or notice or any(all(entry(k + a + b) for b in range(3)) for a in (-2, -1, 0))

    gone = [fails(k) for k in range(len(lines))]
    lost = sum(n for n, g in zip(sizes, gone) if g)
    if 100 * lost > 50 * len(words):
        return None
    return text if not lost else "\n".join(x for x, g in zip(lines, gone) if not g)


def brute_stages(rows):
    """(doc_id, text) of ``rows`` after each of the first four stages; ids are unique and not null."""
    kept = [(d, c) for d, x in rows for c in [brute_quality(x or "")] if c is not None]
    yield dict(kept)
    last = {}
    for d, x in kept:
        last[x] = max(d, last.get(x, d))
    kept = {d: x for x, d in last.items()}
    yield kept
    component = brute_components({d: fingerprint(x) for d, x in kept.items()})
    kept = {d: x for d, x in kept.items() if component[d] == d}
    yield kept
    cut = {d: (n, removed, rest) for d, n, removed, rest in brute_substring(list(kept.items()))}
    yield {d: x if not cut[d][1] else cut[d][2] for d, x in kept.items() if not cut[d][1] or cut[d][1] < cut[d][0]}


def planted(spark):
    """sf0.001 with copies, near copies, shared passages, menus, notices, noise and empty texts; a hot source holds a third."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    top = max(d for d, _ in docs)
    long = [x for _, x in docs if len((x or "").split()) >= 70][:24]
    passage = " ".join(f"passage{k * 31 % 101}" for k in range(64))
    prose = lambda p: "\n".join(f"Sentence {p}{k} says {p} things about {p}topic {k * 7} in the {p}{k % 5} town of {p}place." for k in range(60))
    more = [x for x in long for _ in range(3)]
    more += [prose(f"p{k}") for k in range(6)] + [prose(f"p{k}").replace("says", "says ", 1) for k in range(6)] + [prose(f"p{k}") + " tail" for k in range(6)]
    more += [f"{passage} {prose(f'q{k}')}" for k in range(12)] + [f"{prose(f'r{k}')} {passage}" for k in range(12)] + [passage]
    more += ["Home\nNews\nContact\n" + prose("m"), prose("n") + "\nAll rights reserved.\n\n \nEnd of it.", "# | $ %\n" * 9 + prose("o"), "a | b | c\n" * 30, "WOW!! " * 40]
    more += ["", None, " \t\n\x0b ", "too short", "é" * 500, "same " * 4000]
    return docs + [(top + 1 + k, x) for k, x in enumerate(more)]


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = planted(spark)
    ids = [d for d, _ in rows]
    assert len(set(ids)) == len(ids) and None not in ids
    columns = "doc_id long, text string, source string, lang string, n_chars long"
    docs = spark.createDataFrame([(d, x, "hot" if d % 3 == 0 else f"s{d % 7}", "en", len(x or "")) for d, x in rows], columns)
    docs.repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want, sizes = {}, [len(rows)]
    for (name, stage), want in zip(corpus_pipeline.STAGES, brute_stages(rows)):
        out = stage(spark, frame, str(tmp_path)).collect()
        assert {r.doc_id: r.text for r in out} == want and len(out) == len(want), name
        assert all(r.n_chars == len(r.text) and r.source == ("hot" if r.doc_id % 3 == 0 else f"s{r.doc_id % 7}") for r in out), name
        frame = spark.createDataFrame(out, frame.schema)
        sizes.append(len(want))
    assert all(a > b for a, b in zip(sizes, sizes[1:4])), sizes  # every filtering stage had something to do
    own = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    tokens = {d: own.encode(x, add_special_tokens=False).ids + [1] for d, x in want.items()}
    pieces, places = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == tokens[r.doc_id][r.start:r.start + r.length] and r.doc_tokens == len(tokens[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    whole = lambda parts, n: sorted(parts)[0][0] == 0 and [a + b for a, b in sorted(parts)] == [a for a, _ in sorted(parts)[1:]] + [n]
    assert set(pieces) == set(tokens) and all(whole(p, len(tokens[d])) for d, p in pieces.items())
    filled = {s: sum(n for _, n in p) for s, p in places.items()}
    assert all(whole(p, filled[s]) and filled[s] <= queries.LENGTH for s, p in places.items())
    assert sum(n < queries.LENGTH for n in filled.values()) <= 1
