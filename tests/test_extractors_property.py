"""Property test: the body extractors against a plain-Python statement of the rules.

Spark evaluates the patterns with Java regex, as the original did; the Python
side spells out Java's meaning where it differs from Python's defaults: ``.``
stops at any line terminator (not only ``\\n``) and ``\\s`` is ASCII only.
"""

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from logweave.functions.body import body_info, body_severity, body_timestamp, correlation_id
from logweave.schema import SEVERITY_CODES

WORDS = ["INFO", "ERROR", "WARNING", "DEBUG", "NOTICE", "CRIT", "ALERT", "EMERG", "OVERHEATED", "WARN",
         "CRITICAL", "ABC", "2017-03-14 14:44:38.729", "2017-03-14\t14:44:38.729", "[", "]", " ", "\n", "\r",
         "\u0085", "\u2028", "\u2029", "\u00a0", "x", "CEP_ID=", "CEP_ID=vm-1", "9", "-", ":", ".", "abc"]

# Java's "." excludes every line terminator
JAVA_DOT = "[^\n\r\u0085\u2028\u2029]"


def py_timestamp(s):
    m = re.search(r"[0-9]{4}-[0-9]{2}-[0-9]{2}\s[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}", s, re.ASCII)
    return m.group(0) if m else "1970-01-01 00:00:00.0"


def py_severity(s):
    m = re.search(r"[A-Z]{4,7}+", s)
    return SEVERITY_CODES.get(m.group(0), "") if m else ""


def py_info(s):
    m = re.search(r"\[" + JAVA_DOT + "*", s)
    return m.group(0) if m else ""


def py_correlation(s):
    if "CEP_ID=" not in s:
        return None
    after = s.split("CEP_ID=")[1]
    return re.match(r"\S*", after, re.ASCII).group(0)


texts = st.lists(st.lists(st.sampled_from(WORDS), max_size=12).map("".join), min_size=1, max_size=60)


@settings(max_examples=10, deadline=None)
@given(texts)
def test_extractors_match_rules(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = df.select("i", body_timestamp("v").alias("ts"), body_severity("v").alias("sev"),
                    body_info("v").alias("info"), correlation_id("v").alias("cid")).orderBy("i").collect()
    for r, v in zip(got, values):
        assert r["ts"] == py_timestamp(v), v
        assert r["sev"] == py_severity(v), v
        assert r["info"] == py_info(v), v
        assert r["cid"] == py_correlation(v), v
