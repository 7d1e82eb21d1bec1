"""Column functions: body extractors, severity maps, time parsing (PRS3-PRS14, SNK11)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logweave.functions import (
    age_seconds, body_info, body_severity, body_timestamp, correlation_id, date_piece, in_period, remaining_ttl,
    severity_code, severity_name, timeframe_minutes, to_event_time,
)
from logweave.functions.render import alert_text, entry_json

SAMPLE = ("billing: 2021-09-05 08:10:11.250 pid=77 INFO ledger.writer "
          "[batch 12] wrote 40 rows to shard 3")
SAMPLE_BAD_WORD = SAMPLE.replace(" INFO ", " CRITICALLY ")


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_body_timestamp(spark):
    assert one(spark, body_timestamp("v"), SAMPLE) == "2021-09-05 08:10:11.250"
    assert one(spark, body_timestamp("v"), "no time here") == "1970-01-01 00:00:00.0"


def test_body_severity_first_run_only(spark):
    assert one(spark, body_severity("v"), SAMPLE) == "6"
    # the first run of 4-7 capitals is CRITICA, which is not a level
    assert one(spark, body_severity("v"), SAMPLE_BAD_WORD) == ""
    assert one(spark, body_severity("v"), "x CRITICAL y") == ""
    assert one(spark, body_severity("v"), "x WARN then ERROR") == ""
    assert one(spark, body_severity("v"), "cron[9]: STARTED job nightly") == ""
    assert one(spark, body_severity("v"), "lower case only") == ""


def test_body_info_stops_at_newline(spark):
    assert one(spark, body_info("v"), SAMPLE) == "[batch 12] wrote 40 rows to shard 3"
    assert one(spark, body_info("v"), "a [first line\nsecond [line") == "[first line"
    assert one(spark, body_info("v"), "no bracket") == ""


def test_severity_maps(spark):
    assert one(spark, severity_name("v"), "3") == "ERROR"
    assert one(spark, severity_name("v"), "5") == "NOTICE"
    assert one(spark, severity_name("v"), "9") is None
    assert one(spark, severity_code("v"), "WARNING") == "4"
    with pytest.raises(Exception):
        one(spark, severity_name("v", strict=True), "9")


@pytest.mark.parametrize("text,expected", [
    ("2016-02-18 01:25:43.889", "2016-02-18 01:25:43.889"),
    ("2016-02-18 01:25:43.1", "2016-02-18 01:25:43.100"),       # a short fraction is a fraction
    ("2016-02-18 01:25:43.12", "2016-02-18 01:25:43.120"),
    ("2016-02-18 01:25:43", "2016-02-18 01:25:43.000"),
    ("Mar 01 2017 12:05:04", "2017-03-01 12:05:04.000"),
    ("Mar 1 2017 12:05:04", "2017-03-01 12:05:04.000"),
    ("2017/03/01 12:05:04.123", "2017-03-01 12:05:04.123"),
    ("2017-04-06T12:53:32.420009+00:00", "2017-04-06 12:53:32.420"),
    ("2017-04-06T12:53:32.420009-05:00", "2017-04-06 17:53:32.420"),
    ("2017-04-06T12:53:32.420009UTC", "2017-04-06 12:53:32.420"),
    ("2017-04-06T12:53:32.420009+0000", "2017-04-06 12:53:32.420"),
    ("2017-04-06T12:53:32.420009-0530", "2017-04-06 18:23:32.420"),
    ("2017-3-1 12:05:04.123", "2017-03-01 12:05:04.123"),       # one-digit fields
    ("2017-03-01 1:05:04", "2017-03-01 01:05:04.000"),
    ("2017/3/1 12:5:4.123", "2017-03-01 12:05:04.123"),
    ("1970-01-01 00:00:00.0", "1970-01-01 00:00:00.000"),
    ("Mar  1 12:05:04", "1970-01-01 00:00:00.000"),
    ("2017-02-30 00:00:00", "1970-01-01 00:00:00.000"),
    ("", "1970-01-01 00:00:00.000"),
])
def test_to_event_time(spark, text, expected):
    got = one(spark, F.date_format(to_event_time("v"), "yyyy-MM-dd HH:mm:ss.SSS"), text)
    assert got == expected


def test_timeframe_and_date_piece(spark):
    df = spark.createDataFrame([("2017-04-06 23:59:59",), ("2017-12-16 00:00:00",)], "v string") \
        .select(F.to_timestamp("v").alias("t"))
    got = [(r[0], r[1]) for r in df.select(timeframe_minutes("t"), date_piece("t")).collect()]
    assert got == [(1439, "2017-4-6"), (0, "2017-12-16")]


AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


@pytest.mark.parametrize("offset_ms,age,ok_1h", [
    (-3_600_000, 3600, True),        # exactly one horizon old: in period
    (-3_600_001, 3600, True),        # 3600.001 s truncates to 3600
    (-3_601_000, 3601, False),
    (999, 0, True),                  # less than 1 s in the future: age 0, passes
    (1000, -1, False),
    (-500, 0, True),
])
def test_period_and_ttl(spark, offset_ms, age, ok_1h):
    t = AS_OF + dt.timedelta(milliseconds=offset_ms)
    df = spark.createDataFrame([(t,)], "t timestamp")
    r = df.select(age_seconds("t", AS_OF).alias("a"), in_period("t", 3600, AS_OF).alias("p"),
                  remaining_ttl("t", 3600, AS_OF).alias("ttl")).first()
    assert (r["a"], r["p"], r["ttl"]) == (age, ok_1h, 3600 - age)


def test_ttl_below_horizon_for_past_rows(spark):
    t = [(AS_OF - dt.timedelta(seconds=s),) for s in (1, 60, 3599)]
    for r in spark.createDataFrame(t, "t timestamp").select(remaining_ttl("t", 3600, AS_OF).alias("x")).collect():
        assert r["x"] < 3600
    fut = spark.createDataFrame([(AS_OF + dt.timedelta(seconds=5),)], "t timestamp")
    assert fut.select(remaining_ttl("t", 3600, AS_OF)).first()[0] >= 3600


@pytest.mark.parametrize("body,expected", [
    ("[x CEP_ID=abc123 tail", "abc123"),
    ("[x CEP_ID=a CEP_ID=b", "a"),
    ("[x CEP_ID=aCEP_ID=b", "a"),
    ("[x CEP_ID=", ""),
    ("[x no marker", None),
])
def test_correlation_id(spark, body, expected):
    assert one(spark, correlation_id("v"), body) == expected


def test_entry_json_and_alert_text(spark):
    fields = ["severity", "body", "spriority", "hostname", "protocol", "port", "sender", "service", "id",
              "facility", "timestamp"]
    a = ["3", 'say "hi"', "13", "h1", "UDP", "1", "/s", "Nova", "7", "1", "2024-01-01 00:00:00.000"]
    b = ["6", "ok", None, "h2", "UDP", "1", "/s", "Neutron", "8", "1", "2024-01-01 00:00:02.000"]
    df = spark.createDataFrame([tuple(a) + tuple(b)], ", ".join(
        [f"a_{f} string" for f in fields] + [f"b_{f} string" for f in fields]))
    df = df.select(F.struct(*[F.col(f"a_{f}").alias(f) for f in fields]).alias("first"),
                   F.struct(*[F.col(f"b_{f}").alias(f) for f in fields]).alias("second"))
    j = df.select(entry_json("second.")).first()[0]
    assert j.startswith('{"severity":"6","body":"ok","spriority":"",')
    text = df.select(alert_text()).first()[0]
    lines = text.split("\n")
    assert lines[0] == "ErrorAlert: "
    assert lines[1] == "Nova-3-2024-01-01 00:00:00.000"
    assert lines[2] == "Neutron-6-2024-01-01 00:00:02.000"
    assert '"body":"say \\"hi\\""' in lines[3]
    assert text.endswith("\n")


@pytest.mark.parametrize("horizon_id,horizon_s", [("1h", 3600), ("6h", 21600), ("12h", 43200), ("24h", 86400),
                                                   ("1w", 604800), ("1m", 2419200)])
def test_every_horizon_bounds(spark, horizon_id, horizon_s):
    rows = [(AS_OF + dt.timedelta(seconds=5),), (AS_OF - dt.timedelta(seconds=horizon_s),),
            (AS_OF - dt.timedelta(seconds=horizon_s + 1),)]
    got = [r[0] for r in spark.createDataFrame(rows, "t timestamp").select(in_period("t", horizon_s, AS_OF)).collect()]
    assert got == [False, True, False]
