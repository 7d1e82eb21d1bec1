"""JSON parse, parse-body re-derivation, validity and quarantine (PRS1, PRS2, FLT1, FLT2, FLT8)."""

import json

from pyspark.sql import functions as F

from logweave.operators.parse import accepted_entries, parse_entries, quarantine, quarantine_counts, validate
from logweave.schema import LOG_FIELDS


def line(**kw):
    base = {"severity": "3", "body": "gate: 2022-05-03 11:12:13.456 pid=5 INFO web.front [call 1] opened page",
            "spriority": "13", "hostname": "node-a", "protocol": "UDP", "port": "5514", "sender": "/10.9.8.7",
            "service": "Keystone", "id": "1_a", "facility": "1", "timestamp": "2022-05-03 11:12:13.456"}
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not None})


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "seq long, value string")


# what each line tests is noted
SIX = [
    line(severity="6"),                                                      # both levels accepted
    line(severity="3", body="gate: 2022-05-03 11:12:14.000 pid=5 ERROR web.front [call 2] timed out"),
    line(severity="4", timestamp="2022-05-04 00:00:01.000"),                 # times differ
    line(severity="7", body="cron: 2022-05-03 STARTED nightly [job]"),       # first capitals are no level
    line(severity="3", body="nothing to be found in this text", timestamp="2022-05-05 10:00:00.000"),
    line(severity="6", body="gate: 2022-05-03 11:12:15.000 pid=5 WARNING web.front [call 3] slow", timestamp=""),
]


def test_parse_body_decides_which_severity_counts(spark):
    on = {r["seq"] for r in accepted_entries(frame(spark, SIX), parse_body=True).collect()}
    off = {r["seq"] for r in accepted_entries(frame(spark, SIX), parse_body=False).collect()}
    assert on == {0, 1, 2, 5}
    assert off == {0, 1, 2, 4}


def test_multiline_json_and_body_cut(spark):
    raw = ('{"severity":"5","body":"pay: 2022-05-03 07:08:09.010 pid=8 WARNING card.check\n'
           '[card 4\nof 9] refused","spriority":"13","hostname":"h","protocol":"UDP",\n'
           '"port":"5514","sender":"/s","service":"Keystone","id":"x","facility":"1","timestamp":"2022-05-06 01:02:03.004"}')
    on = parse_entries(frame(spark, [raw]), True).first()
    off = parse_entries(frame(spark, [raw]), False).first()
    assert on["json_error"] is None and off["json_error"] is None
    assert on["severity"] == "4" and off["severity"] == "5"
    assert on["body"] == "[card 4"
    assert on["timestamp"] == "2022-05-03 07:08:09.010"
    assert off["timestamp"] == "2022-05-06 01:02:03.004"


def test_reject_reasons(spark):
    values = [
        line(),                                   # accepted
        line(severity=None),                      # key missing
        '{"severity": null, "body": "x"}',        # null counts as missing
        "not json at all",
        "[1, 2, 3]",                              # top-level array
        line(body="x [a] y CRITICALLY"),        # first caps run is not a level
        line(body="no bracket 2016-02-18 01:25:43.889 INFO"),
        line(body="svc 2016-02-18 01:25:43.889 NOTICE [n] z"),
        line(body="svc 2016-02-18 01:25:43.889 DEBUG [n] z"),
        line(extra_key="ignored"),                # unknown keys are ignored
    ]
    got = {r["seq"]: r["reject_reason"] for r in validate(parse_entries(frame(spark, values), True)).collect()}
    assert got == {0: None, 1: "missing_field", 2: "missing_field", 3: "bad_json", 4: "bad_json",
                   5: "no_severity", 6: "no_info", 7: "level_not_accepted", 8: "level_not_accepted", 9: None}
    off = {r["seq"]: r["reject_reason"] for r in validate(parse_entries(frame(spark, [
        line(severity=""), line(timestamp=""), line(severity="9"), line(body="")]), False)).collect()}
    assert off == {0: "no_severity", 1: "no_timestamp", 2: "unknown_severity", 3: "no_info"}


def test_unparseable_time_is_flagged_not_rejected(spark):
    df = validate(parse_entries(frame(spark, [line(body="svc INFO [x] no time")]), True)).first()
    assert df["reject_reason"] is None
    assert df["time_flag"] == "no_body_time"
    assert df["event_time"].year == 1970
    bad = validate(parse_entries(frame(spark, [line(timestamp="Mar  1 12:05:04")]), False)).first()
    assert bad["time_flag"] == "bad_time" and bad["event_time"].year == 1970


def test_quarantine_keeps_text(spark):
    q = quarantine(frame(spark, SIX), True).collect()
    assert {r["seq"] for r in q} == {3, 4}
    assert all(r["raw_value"] == SIX[r["seq"]] for r in q)
    counts = {r["reject_reason"]: r["n_rows"] for r in quarantine_counts(frame(spark, SIX), True).collect()}
    assert counts == {"no_severity": 2}


def test_parse_is_one_pass(spark):
    """Each costly expression appears once in the plan: the reject filter is not pushed below
    the JSON parse, the extractors or the time parse (each sits behind a Generate)."""
    df = accepted_entries(frame(spark, SIX))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert plan.count("regexp_extract(") == 3          # time, level word, message
    assert plan.count("try_to_timestamp") == 7         # one chain of the seven formats


def test_fields_in_order(spark):
    df = parse_entries(frame(spark, SIX), True)
    assert [c for c in df.columns if c in LOG_FIELDS] == list(LOG_FIELDS)
    assert df.where(F.col("json_error").isNull()).count() == 6
