"""DuckDB SQL of the queries that SQL expresses."""

from __future__ import annotations

from . import licenses, quality, sharding, urls


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


OP4 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t
"""


def op1(limit: int) -> str:
    bits = sharding.BITS
    return f"""
WITH d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h, coalesce(strlen(text), 0)::BIGINT AS n_bytes FROM documents),
lev AS (SELECT k.depth, d.h >> ({bits} - k.depth) AS prefix, sum(d.n_bytes)::BIGINT AS bytes, min(d.h) AS least, max(d.h) AS most
        FROM d, (SELECT unnest(range(0, {bits} + 1)) AS depth) k GROUP BY ALL),
leaf AS (SELECT l.* FROM lev l LEFT JOIN lev p ON p.depth = l.depth - 1 AND p.prefix = l.prefix >> 1
         WHERE (l.depth = 0 OR (p.bytes > {limit} AND p.least < p.most)) AND NOT (l.bytes > {limit} AND l.least < l.most)),
-- a shard is reached only through buckets that were split
live AS (SELECT f.* FROM leaf f WHERE NOT EXISTS (SELECT 1 FROM leaf g WHERE g.depth < f.depth AND g.prefix = f.prefix >> (f.depth - g.depth)))
SELECT d.doc_id, d.n_bytes, CASE WHEN f.depth = 0 THEN '' ELSE lpad(format('{{:b}}', f.prefix), f.depth::INT, '0') END AS shard,
       f.depth::BIGINT AS depth, f.bytes AS shard_bytes
FROM d JOIN live f ON f.prefix = d.h >> ({bits} - f.depth)
"""


def op3(rules: list[urls.Rule]) -> str:
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fits = lambda r: f"((host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}'))"
    case = lambda k: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r[0] if k else r[1] + r[2]}'" for r in ordered) + " END"
    levels = "WITH RECURSIVE dummy AS (SELECT 1)"
    for k in range(1, urls.ORDER + 1):
        lower = "1 / 256::DOUBLE AS la, 1 / 256::DOUBLE AS lb" if k == 1 else f"l{k - 1}.la, l{k - 1}.lb"
        join = "" if k == 1 else f"JOIN l{k - 1} ON l{k - 1}.gram = substr(o.gram, 2)"
        levels += f""",
o{k} AS (SELECT substr(gram, {urls.ORDER - k + 1}) AS gram, sum(a) AS a, sum(b) AS b FROM counts GROUP BY 1),
c{k} AS (SELECT substr(gram, 1, {k - 1}) AS context, sum(a) AS ca, sum(b) AS cb FROM o{k} GROUP BY 1),
l{k} AS (SELECT gram, (a + {urls.PRIOR} * la) / (ca + {urls.PRIOR}) AS la, (b + {urls.PRIOR} * lb) / (cb + {urls.PRIOR}) AS lb
        FROM (SELECT o.gram, o.a::DOUBLE AS a, o.b::DOUBLE AS b, c.ca::DOUBLE AS ca, c.cb::DOUBLE AS cb, {lower}
              FROM o{k} o JOIN c{k} c ON c.context = substr(o.gram, 1, {k - 1}) {join}))"""
    chain = levels.removeprefix("WITH RECURSIVE dummy AS (SELECT 1),")
    n = urls.ORDER
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, url, raw, rest, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, {case(0)} AS rule, {case(1)} AS action, CASE WHEN url LIKE '%://%' THEN host || right(rest, length(rest) - length(raw)) ELSE url END AS s FROM p),
strings AS (SELECT s, count(*) FILTER (action = 'allow') AS a, count(*) FILTER (action = 'block') AS b, substr(md5(s), 1, 1) IN ('0', '1', '2') AS held FROM r GROUP BY s),
grams AS (SELECT s, a, b, held, substr(repeat(chr(2), {n - 1}) || s || chr(3), i::BIGINT, {n}) AS gram FROM (SELECT *, unnest(range(1, length(s) + 2)) AS i FROM strings)),
counts AS (SELECT gram, sum(CASE WHEN held THEN 0 ELSE a END) AS a, sum(CASE WHEN held THEN 0 ELSE b END) AS b FROM grams GROUP BY gram),
taught AS (SELECT sum(CASE WHEN held THEN 0 ELSE a END) > 0 AND sum(CASE WHEN held THEN 0 ELSE b END) > 0 AS yes FROM strings),
{chain.strip().lstrip(',').strip()},
scores AS (SELECT g.s, any_value(g.a) AS a, any_value(g.b) AS b, any_value(g.held) AS held,
                  floor(sum(CASE WHEN (SELECT yes FROM taught) THEN round({urls.UNIT} * (ln(l.la) - ln(l.lb)))::BIGINT ELSE 0 END)::DOUBLE / count(*))::BIGINT AS score
           FROM grams g JOIN l{n} l ON l.gram = g.gram GROUP BY g.s),
cells AS (SELECT greatest({-urls.REACH}, least({urls.REACH}, floor(score / {urls.GRID}::DOUBLE)::INT)) AS g, sum(a) AS a, sum(b) AS b FROM scores WHERE held GROUP BY 1),
best AS (SELECT t FROM (SELECT unnest(range({-urls.REACH}, {urls.REACH + 1})) AS t) ORDER BY
         (SELECT coalesce(sum(CASE WHEN g >= t THEN a ELSE 0 END) * sum(b) + sum(CASE WHEN g < t THEN b ELSE 0 END) * sum(a), 0) FROM cells) DESC, abs(t), t LIMIT 1)
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.action, CASE WHEN z.score >= (SELECT t FROM best) * {urls.GRID} THEN 'allow' ELSE 'block' END) AS verdict
FROM r JOIN scores z ON z.s = r.s
"""


def op6() -> str:
    q = quality
    count = lambda x, chars: f"(length({x}) - length(translate({x}, '{chars}', '')))"
    space = r"[\x20\x09-\x0D]"
    return f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS id, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(x, '{space}+'), lambda v: v <> '') AS w FROM t),
win AS (SELECT id, i, array_to_string(w[i + 1:i + {q.WINDOW}], ' ') AS g FROM (SELECT id, w, unnest(range(0, len(w) - {q.WINDOW - 1})) AS i FROM w)),
twin AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT id, sum(step)::BIGINT AS n FROM (SELECT id, least({q.WINDOW}, coalesce(lead(i) OVER (PARTITION BY id ORDER BY i) - i, {q.WINDOW})) AS step FROM twin) GROUP BY id),
l AS (SELECT id, k, line, len(list_filter(regexp_split_to_array(line, '{space}+'), lambda v: v <> '')) AS n
      FROM (SELECT id, unnest(range(1, len(s) + 1)) AS k, unnest(s) AS line FROM (SELECT id, string_split(x, chr(10)) AS s FROM t)) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
judged AS (SELECT id, k, line, n,
             (n >= 3 AND 2 * {count('line', q.CRIES)} >= n) OR 4 * {count('line', q.BARS)} >= n
             OR (strlen(line) <= {q.NOTICE_BYTES} AND len(list_filter({_list(q.BOILERPLATE)}, lambda v: contains(lower(line), v))) > 0) AS bad,
             strlen(line) <= {q.MENU_BYTES} AND n <= {q.MENU_WORDS} AND NOT left(line, 1) IN (' ', chr(9)) AND NOT regexp_matches(line, '[.!?…:;,"”»)\\]}}]{space}*\\z') AS menu FROM l),
-- runs of menu lines: neighbours have the same distance between their place and their place among the menu lines
placed AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k) - row_number() OVER (PARTITION BY id, menu ORDER BY k) AS run FROM judged),
marked AS (SELECT *, count(*) OVER (PARTITION BY id, menu, run) AS menus FROM placed),
doc AS (SELECT id, sum(CASE WHEN bad OR (menu AND menus > 2) THEN n ELSE 0 END)::BIGINT AS lost, count(*) - count(DISTINCT line) AS dup FROM marked GROUP BY id),
f AS (SELECT w.doc_id, len(w.w) AS n, w.x, coalesce(rep.n, 0) AS rep, coalesce(doc.lost, 0) AS lost, coalesce(doc.dup, 0) AS dup
      FROM w LEFT JOIN rep ON rep.id = w.id LEFT JOIN doc ON doc.id = w.id)
SELECT doc_id, n::BIGINT AS n_words, length(regexp_replace(x, '{space}+', '', 'g'))::BIGINT AS word_chars, {count('x', q.SYMBOLS)}::BIGINT AS n_symbols,
       dup::BIGINT AS n_dup_lines, rep::BIGINT AS n_repeat_words, (n < {q.MIN_WORDS} OR 100 * rep > {q.MAX_REPEAT_PERCENT} * n) AS base_failed,
       NOT (n < {q.MIN_WORDS} OR 100 * rep > {q.MAX_REPEAT_PERCENT} * n) AND 100 * lost <= {q.LOST_PERCENT} * n AS kept
FROM f
"""


def op7() -> str:
    m = licenses
    values = ", ".join(f"({n}, {_list(own)}, '{label}', {base}, {k})" for n, own, label, base, k in m.numbered())
    grams = " UNION ALL ".join(
        f"SELECT id, template, label, base, k, grams, i - spot AS diagonal, spot, i FROM (SELECT id, i, array_to_string(w[i + 1:i + {k}], ' ') AS gram FROM "
        f"(SELECT id, w, unnest(range(0, len(w) - {k - 1})) AS i FROM t)) d JOIN (SELECT * FROM grams WHERE k = {k}) g USING (gram)" for k in (m.SHORT, m.LONG))
    return f"""
WITH tpl AS (SELECT * FROM (VALUES {values}) v(template, p, label, base, k)),
grams AS (SELECT template, label, base, k, spot, len(p) - k + 1 AS grams, array_to_string(p[spot + 1:spot + k], ' ') AS gram
          FROM (SELECT *, unnest(range(0, len(p) - k + 1)) AS spot FROM tpl)),
t AS (SELECT row_number() OVER () AS id, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda v: v <> '') AS w FROM documents),
hits AS ({grams}),
near AS (SELECT *, CASE WHEN base OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY id, template ORDER BY diagonal), {m.GAP + 1}) > {m.GAP} THEN 1 ELSE 0 END AS new
         FROM (SELECT DISTINCT id, template, base, diagonal FROM hits)),
grp AS (SELECT *, sum(new) OVER (PARTITION BY id, template ORDER BY diagonal) AS g FROM near),
merged AS (SELECT h.id, h.template, any_value(h.label) AS label, any_value(h.base) AS base, any_value(h.grams) AS grams, min(h.diagonal) AS start,
                  count(DISTINCT h.spot) AS votes, max(h.i) - min(h.i) + any_value(h.k) AS span, any_value(h.k) AS k
           FROM hits h JOIN grp ON grp.id = h.id AND grp.template = h.template AND grp.diagonal = h.diagonal GROUP BY h.id, h.template, grp.g),
good AS (SELECT * FROM merged WHERE CASE WHEN base THEN votes = grams ELSE 100 * votes >= {m.SHARE_PERCENT} * grams AND 100 * span <= {m.LENGTH_PERCENT} * (grams + k - 1) END),
doc AS (SELECT id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(votes / grams) AS score
        FROM good GROUP BY id)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0), 6)::DOUBLE AS score
FROM t LEFT JOIN doc ON doc.id = t.id
"""


def op11(min_docs: int, top: int) -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = lambda c, n: f"(1 + (1000000000::HUGEINT * ({c} + 2)) // ({n} + 2 * v))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS x FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(x, '{letters}', '{letters.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {min_docs}),
lv AS (SELECT g.lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS n FROM (SELECT DISTINCT lang FROM grp) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang),
own AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
gn AS (SELECT g.lang, g.source, coalesce(sum(o.n), 0) AS n FROM grp g LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS c, {share("coalesce(o.n, 0)", "g.n")} AS p, {share("k.n", "lv.n")} AS q
      FROM gn g JOIN lv ON lv.lang = g.lang JOIN kept k ON k.lang = g.lang LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
          FROM grp a JOIN grp b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= {top}
"""


def op13() -> str:
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    # CRC-32 bit by bit, over the digits of a number
    byte = "list_reduce([crc, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, d: {byte.replace('crc', 'xor(c, d)')}), 4294967295)"
    def tree(name: str, leaves: str) -> str:
        return f"""
{name} AS (SELECT tree, 0 AS lvl, pos, n, h FROM {leaves}
  UNION ALL SELECT tree, lvl + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // 3)"""
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS id, doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS tree,
    sha256({head} || {field("text")}) AS h,
    CASE WHEN doc_id IS NOT NULL AND {crc} % 2 = 0 THEN sha256({head} || {field("replace(text, chr(10), '')")}) END AS bad FROM documents),
leaf AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h, id) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
{tree("nodes", "leaf").strip()},
sub AS (SELECT '' AS tree, tree AS source, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, h FROM nodes WHERE n = 1),
{tree("forest", "sub").strip()},
steps AS (SELECT l.id, s.lvl AS stage, string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < l.pos // (3 ** s.lvl)::BIGINT) AS a, string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > l.pos // (3 ** s.lvl)::BIGINT) AS b
          FROM leaf l JOIN nodes s ON s.tree = l.tree AND s.n > 1 AND s.pos // 3 = l.pos // (3 ** (s.lvl + 1))::BIGINT GROUP BY l.id, s.lvl),
crown AS (SELECT l.source, s.lvl + 1000 AS stage, string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < l.pos // (3 ** s.lvl)::BIGINT) AS a, string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > l.pos // (3 ** s.lvl)::BIGINT) AS b
          FROM sub l JOIN forest s ON s.n > 1 AND s.pos // 3 = l.pos // (3 ** (s.lvl + 1))::BIGINT GROUP BY l.source, s.lvl),
way AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY stage) AS k, coalesce(a, '') AS a, coalesce(b, '') AS b
        FROM (SELECT id, stage, a, b FROM steps UNION ALL SELECT l.id, c.stage, c.a, c.b FROM leaf l JOIN crown c ON c.source = l.tree)),
proof AS (SELECT id, string_agg(a || b, '' ORDER BY k) AS p, count(*) AS n FROM way GROUP BY id),
fold AS (SELECT id, 0::BIGINT AS k, coalesce(bad, h) AS h FROM leaf
  UNION ALL SELECT f.id, w.k, sha256(w.a || f.h || w.b) FROM fold f JOIN way w ON w.id = f.id AND w.k = f.k + 1)
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, r.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM leaf l JOIN sub s ON s.source = l.tree CROSS JOIN (SELECT h FROM forest WHERE n = 1) r LEFT JOIN proof p ON p.id = l.id JOIN fold f ON f.id = l.id AND f.k = coalesce(p.n, 0)
"""
