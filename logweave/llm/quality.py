"""Operator 6, line-first quality rules, in DataFrame functions only.

Each line with a word is judged by itself:
* punctuation: three words or more with an exclamation or question mark for every other word;
* navigation: a separator or symbol for every fourth word or more, or a menu entry: a line of at most 40
  bytes and four words, not indented, that ends no sentence, clause or bracket, in a run of three such lines
  or more (so headings between paragraphs, verse and most code stay);
* boilerplate: a notice phrase (rights, cookies, subscriptions, ...) in a line of at most 250 bytes.
Failing lines are removed; the document is rejected if they held over half of its words. The base
rules (too few words, too many words in repeated 8-word windows) reject before that.

Windows are compared by the hash of their word hashes and, where two are equal, word by word.

Everything is one expression over the row, without a shuffle: ``let`` binds an intermediate array as
a lambda variable, so it is computed once and never copied into a row. One pattern finds the texts
with rare white space or marks; only those pay for counting them.

Defined cases: a null or empty text has no words, fails the base rule and is not kept. Lines split
at line feeds only; lines without a word stand between no others. Repeated rows are judged each. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unpacked, whole_row

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS, BARS, CRIES, WHITE = "#*$%&|<>", "#*$%&|<>=~^{}", "!?", "\t\n\x0b\x0c\r"
RARE = r"[\x09\x0B-\x0D#*$%&|<>=~^{}!?]"
MENU_BYTES, MENU_WORDS, NOTICE_BYTES = 40, 4, 250
#: A menu entry is not indented and ends no sentence, part of one, string or bracket.
MENU_NOT = r"^[\x20\x09]|[.!?…:;,\"”»)\]}][\x20\x09-\x0D]*\z"
#: Notice phrases of web pages (fixed values).
BOILERPLATE = ("all rights reserved", "cookie policy", "accept cookies", "privacy policy", "terms of use", "terms of service",
               "click here", "sign up", "subscribe to", "enable javascript", "lorem ipsum", "skip to content", "powered by")
LOST_PERCENT = 50


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without(text: Column, chars: str, put: str = "") -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(put))
    return text


def _count_of(text: Column, chars: str) -> Column:
    """Occurrences of ASCII ``chars``."""
    return F.octet_length(text) - F.octet_length(without(text, chars))


def _pieces(text: Column, rare: Column) -> Column:
    """What stands between single white space characters, empty strings included."""
    plain = F.when(rare, F.translate(text, WHITE, " " * len(WHITE))).otherwise(text)
    return F.flatten(F.transform(F.split(plain, "\n"), lambda line: F.split(line, " ")))


def _line(line: Column, rare: Column) -> Column:
    """A line, whether a rule fails it, and whether it may be a menu entry."""
    n = F.size(F.array_remove(F.split(F.translate(line, WHITE, " " * len(WHITE)), " "), ""))
    low = F.lower(line)
    notice = F.lit(False)
    for phrase in BOILERPLATE:
        notice = notice | low.contains(phrase)
    marks = rare & let(n, lambda n: (n >= 3) & (2 * _count_of(line, CRIES) >= n) | (4 * _count_of(line, BARS) >= n))
    bad = marks | F.when(F.octet_length(line) <= NOTICE_BYTES, notice).otherwise(False)
    menu = F.when(F.octet_length(line) <= MENU_BYTES, ~line.rlike(MENU_NOT) & (n <= MENU_WORDS)).otherwise(False)
    return F.struct(line.alias("line"), bad.alias("bad"), menu.alias("menu"))


def _repeat_words(w: Column) -> Column:
    """Words under windows that occur twice or more in the text."""
    empty = F.lit(0).cast("long")

    def covered(starts: Column) -> Column:
        return F.aggregate(F.transform(starts, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)))), empty, lambda a, x: a + x)

    def twins(order: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            equal = a["h"] == b["h"]
            for k in range(WINDOW):
                equal = equal & (F.get(w, a["i"] + k) == F.get(w, b["i"] + k))
            return F.coalesce(equal, F.lit(False))
        return F.transform(F.filter(order, lambda x, k: same(x, F.get(order, k - 1)) | same(x, F.get(order, k + 1))), lambda x: x["i"])

    def by_hash(windows: Column) -> Column:
        order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), empty).otherwise(let(let(order, twins), lambda i: let(F.sort_array(i), covered)))

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    return F.when(F.size(w) <= WINDOW, empty).otherwise(let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(windows(h), by_hash)))


def quality_of(text: Column) -> Column:
    """A struct for a text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lost_words,
    base_failed, kept and clean (the text without failing lines)."""
    text = F.coalesce(text, F.lit(""))

    def of_text(rare: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: F.octet_length(F.ltrim(x, F.lit(" " + WHITE))) > 0)
        judged = F.transform(lines, lambda x: _line(x, rare))
        return let(_pieces(text, rare), lambda pieces: let(F.array_remove(pieces, ""), lambda w: let(_repeat_words(w), lambda repeat: let(
            judged, lambda rows: let(_failed(rows), lambda gone: result(rare, F.size(pieces), F.size(w).cast("long"), repeat, rows, gone))))))

    def _failed(rows: Column) -> Column:
        """For each line whether it fails and, if so, its words."""
        is_menu = lambda k: F.coalesce(F.get(rows, k)["menu"], F.lit(False))
        # a run of three entries: the line is its first, middle or last
        in_run = lambda k: (is_menu(k - 2) & is_menu(k - 1)) | (is_menu(k - 1) & is_menu(k + 1)) | (is_menu(k + 1) & is_menu(k + 2))
        count = lambda x: F.size(F.array_remove(F.split(F.translate(x["line"], WHITE, " " * len(WHITE)), " "), ""))
        return F.transform(rows, lambda x, k: let(x["bad"] | x["menu"] & in_run(k), lambda fails: F.struct(fails.alias("fails"), F.when(fails, count(x)).otherwise(0).alias("n"))))

    def result(rare: Column, pieces: Column, n: Column, repeat: Column, rows: Column, gone: Column) -> Column:
        own = F.transform(rows, lambda x: x["line"])
        failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
        lost = F.aggregate(gone, F.lit(0).cast("long"), lambda a, x: a + x["n"])
        return let(lost, lambda lost: F.struct(
            n.alias("n_words"),
            (F.length(text) - (pieces - 1)).cast("long").alias("word_chars"),
            F.when(rare, _count_of(text, SYMBOLS)).otherwise(0).cast("long").alias("n_symbols"),
            (F.size(rows) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"),
            repeat.alias("n_repeat_words"), lost.alias("n_lost_words"), failed.alias("base_failed"),
            (~failed & (100 * lost <= LOST_PERCENT * n)).alias("kept"),
            F.when(lost == 0, text).otherwise(F.array_join(F.filter(own, lambda x, k: ~F.get(gone, k)["fails"]), "\n")).alias("clean")))

    return let(text.rlike(RARE), of_text)


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, quality) of each row."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), quality_of(docs["text"]).alias("quality"))


def kept_and_cleaned(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, without failing lines; ``n_chars`` follows. Other columns are carried,
    whatever their names."""
    rows = docs.select(whole_row(docs), quality_of(docs["text"]).alias("quality")).where("quality.kept")
    clean, text = F.col("quality")["clean"], F.col("row").getField("text")
    new = {"text": clean}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(clean == text, F.col("row").getField("n_chars")).otherwise(F.length(clean))
    return unpacked(rows, docs, new)
