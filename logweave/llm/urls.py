"""Operator 3, URL filter by rules and a character language-model ratio, in DataFrame functions only.

Rules judge first; the longest that fits wins. The URLs they allow and block train two character
models of variable order (contexts of 0 to 4 characters): the probability of a character after a
context is (count + 4 x probability after the context without its first character) / (context's
count + 4), down to 1/256, so unseen contexts fall back to shorter ones. A URL's score is the sum
over its characters of log(accepted / rejected), in whole micronats, divided by their number. All of the
URL behind ``://`` counts, query and fragment too, the host in lower case. Three
sixteenths of the URLs (by MD5) are kept out of training; on them the threshold is chosen, from a
grid of 0.01 nats between -5 and 5, that does best on balanced accuracy (ties: nearest to zero).

All counts cover all URLs and grow with the table; distinct character windows are aggregated before
they are joined. Defined cases: a null or empty URL has an empty host and path, fits no rule and is
scored like any other (its end alone). Without accepted or without rejected URLs all scores are
zero and all are allowed. Repeated rows are judged each. No rows give no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, stage

Rule = tuple[str, str, str]  # action, host, path
ORDER, PRIOR, UNIT, GRID, REACH = 5, 4, 1_000_000, 10_000, 500
START, STOP = "\x02", "\x03"


def rule_of(action: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return action, host, slash + path


def parse(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _rule(host: Column, path: Column, rules: list[Rule], value) -> Column:
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        out = F.when(fits, value(rule)) if out is None else out.when(fits, value(rule))
    return out if out is not None else F.lit(None).cast("string")


def _grams(strings: DataFrame, *keep: str) -> DataFrame:
    """The last ORDER characters up to each place; the string itself is not carried, and its time is linear."""
    padded = F.concat(F.array_repeat(F.lit(START), ORDER - 1), F.split("s", ""), F.array(F.lit(STOP)))
    own = F.when(F.length("s") > 0, padded).otherwise(F.array(*[F.lit(START)] * (ORDER - 1), F.lit(STOP)))
    split = strings.select(*keep, own.alias("chars"))
    return split.select(*split.columns[:-1], F.explode(F.transform(F.sequence(F.lit(0), F.size("chars") - ORDER), lambda i: F.concat(*[F.get("chars", i + k) for k in range(ORDER)]))).alias("gram"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(gram, r): micronats by which the last character of each gram speaks for the accepted URLs.

    ``counts(gram, a, b)`` holds every gram to be scored with its accepted and rejected counts.
    """
    lower = None
    for k in range(1, ORDER + 1):
        own = counts.groupBy(F.substr(F.col("gram"), F.lit(ORDER - k + 1)).alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        context = own.groupBy(F.substr(F.col("gram"), F.lit(1), F.lit(k - 1)).alias("context")).agg(F.sum("a").alias("ca"), F.sum("b").alias("cb"))
        own = own.join(context, F.substr(F.col("gram"), F.lit(1), F.lit(k - 1)) == F.col("context"))
        if lower is None:
            own = own.withColumns({"la": F.lit(1 / 256), "lb": F.lit(1 / 256)})
        else:
            own = own.join(lower, F.substr(F.col("gram"), F.lit(2)) == F.col("shorter"))
        lower = own.select(F.col("gram").alias("shorter"), ((F.col("a") + PRIOR * F.col("la")) / (F.col("ca") + PRIOR)).alias("la"),
                           ((F.col("b") + PRIOR * F.col("lb")) / (F.col("cb") + PRIOR)).alias("lb"))
    return lower.select(F.col("shorter").alias("gram"), F.round(UNIT * (F.ln("la") - F.ln("lb"))).cast("long").alias("r"))


def _threshold(judged: DataFrame) -> int:
    """Grid value of best balanced accuracy on held-out ``judged(score, a, b)``; at most 1,001 rows."""
    cell = F.greatest(F.lit(-REACH), F.least(F.lit(REACH), F.floor(F.col("score") / GRID).cast("int")))
    rows = judged.groupBy(cell.alias("g")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
    all_a, all_b = sum(r.a for r in rows), sum(r.b for r in rows)
    if not all_a or not all_b:
        return 0
    def value(t: int) -> int:
        return sum(r.a for r in rows if r.g >= t) * all_b + sum(r.b for r in rows if r.g < t) * all_a
    return min(range(-REACH, REACH + 1), key=lambda t: (-value(t), abs(t), t))


def whole_url(url: Column) -> Column:
    """What the model reads: the host in lower case and all that follows it; a URL without ``://`` as it is."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.when(at > 0, F.concat(F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), F.substr(rest, F.length(raw) + 1))).otherwise(url)


def filter_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of each row; score in nats a character.

    Counts, ratios and scores are staged once each; the shuffle files behind them go at once.
    """
    spark = pages.sparkSession
    url = F.coalesce(pages["url"], F.lit(""))
    host, path = parse(url)
    ruled = pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"), whole_url(url).alias("s"))
    ruled = ruled.withColumns({"rule": _rule(F.col("host"), F.col("path"), rules, lambda r: F.lit(r[1] + r[2])),
                               "action": _rule(F.col("host"), F.col("path"), rules, lambda r: F.lit(r[0]))})
    strings = ruled.groupBy("s").agg(F.count_if(F.col("action") == "allow").alias("a"), F.count_if(F.col("action") == "block").alias("b"))
    strings = stage(strings.withColumns({"held": F.substr(F.md5("s"), F.lit(1), F.lit(1)).isin("0", "1", "2"), "n": F.monotonically_increasing_id()}), "strings")
    shown = F.when(F.col("held"), 0)
    counts = _grams(strings, shown.otherwise(F.col("a")).alias("a"), shown.otherwise(F.col("b")).alias("b")).groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = stage(counts, "grams")
    # without examples of either kind there is nothing to compare
    taught = strings.where("not held").agg((F.sum("a") > 0) & (F.sum("b") > 0)).first()[0]
    release(spark)
    ratios = stage(log_ratios(counts), "ratios") if taught else counts.select("gram", F.lit(0).cast("long").alias("r"))
    release(spark)
    sums = _grams(strings, "n").join(ratios, "gram").groupBy("n").agg(F.floor(F.sum("r") / F.count("*")).alias("score"))
    scores = stage(strings.join(sums, "n").select(F.col("s").alias("_s"), "a", "b", "held", "score"), "scores")
    release(spark)
    t = _threshold(scores.where("held"))
    out = ruled.join(scores.select("_s", "score"), F.col("s") == F.col("_s"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("action", F.when(F.col("score") >= t * GRID, "allow").otherwise("block")).alias("verdict"),
                      (F.col("score") / UNIT).alias("score"))
