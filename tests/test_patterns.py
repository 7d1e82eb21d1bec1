"""Sequence-pattern goldens (SEQ1-SEQ11)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logweave.operators.patterns import (
    MINUTES, SequencePattern, Step, consecutive_errors, correlated_create_vm, match_sequence,
)


def entries(spark, rows):
    """rows: (seq, 'HH:MM:SS.mmm', severity code, service, body)."""
    data = [(s, dt.datetime.strptime("2017-04-26 " + t, "%Y-%m-%d %H:%M:%S.%f"), sev, svc, body)
            for s, t, sev, svc, body in rows]
    return spark.createDataFrame(data, "seq long, event_time timestamp, severity string, service string, body string") \
        .withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS"))


def pairs(df):
    return sorted((r["first"]["seq"], r["second"]["seq"]) for r in df.collect())


def test_four_errors_one_alert(spark):
    e = entries(spark, [(1, "09:00:00.000", "3", "Nova", "[a]"), (2, "09:06:30.000", "3", "Nova", "[b]"),
                        (3, "11:00:00.000", "3", "Nova", "[c]"), (4, "11:40:00.000", "3", "Nova", "[d]")])
    assert pairs(match_sequence(e, consecutive_errors())) == [(1, 2)]


def test_forty_minutes_apart_no_alert(spark):
    e = entries(spark, [(1, "08:00:00.000", "3", "Nova", "[a]"), (2, "08:40:00.000", "3", "Nova", "[b]")])
    assert pairs(match_sequence(e, consecutive_errors())) == []


def test_overlapping_matches_and_strictness(spark):
    e = entries(spark, [(1, "10:00:00.000", "3", "Nova", "[a]"), (2, "10:01:00.000", "3", "Nova", "[b]"),
                        (3, "10:02:00.000", "3", "Nova", "[c]"), (4, "10:03:00.000", "6", "Nova", "[d]"),
                        (5, "10:04:00.000", "3", "Nova", "[e]"), (6, "10:04:30.000", "3", "Cinder", "[f]"),
                        (7, "10:05:00.000", "3", "Nova", "[g]")])
    # E E E -> 2; an INFO row breaks adjacency; another service does not
    assert pairs(match_sequence(e, consecutive_errors())) == [(1, 2), (2, 3), (5, 7)]


def test_bound_is_strict(spark):
    e = entries(spark, [(1, "10:00:00.000", "3", "Nova", "[a]"), (2, "10:10:00.000", "3", "Nova", "[b]"),
                        (3, "10:19:59.999", "3", "Nova", "[c]")])
    assert pairs(match_sequence(e, consecutive_errors())) == [(2, 3)]


def test_ties_ordered_by_seq(spark):
    e = entries(spark, [(5, "10:00:00.000", "3", "Nova", "[a]"), (3, "10:00:00.000", "6", "Nova", "[b]"),
                        (7, "10:00:00.000", "3", "Nova", "[c]")])
    assert pairs(match_sequence(e, consecutive_errors())) == [(5, 7)]


CORR = [
    (1, "12:00:00.000", "3", "Nova", "[req CEP_ID=vm-42 create failed"),
    (2, "12:00:01.000", "6", "Keystone", "[token CEP_ID=vm-42 issued"),
    (3, "12:00:02.000", "6", "Neutron", "[port CEP_ID=vm-41 bound"),
    (4, "12:00:02.802", "6", "Neutron", "[port CEP_ID=vm-42 bound"),
    (5, "12:00:03.000", "6", "Neutron", "[port CEP_ID=vm-42 again"),
    (6, "12:30:00.000", "3", "Nova", "[req CEP_ID=vm-43 failed"),
    (7, "12:50:00.000", "6", "Neutron", "[port CEP_ID=vm-43 bound"),
]


def test_correlated_next_any_strict(spark):
    e = entries(spark, CORR)
    assert pairs(match_sequence(e, correlated_create_vm())) == [(1, 4)]
    assert pairs(match_sequence(e, correlated_create_vm(contiguity="any"))) == [(1, 4), (1, 5)]
    assert pairs(match_sequence(e, correlated_create_vm(120 * MINUTES))) == [(1, 4), (6, 7)]
    # strict under the correlation key: the Keystone row with the same id sits in between
    assert pairs(match_sequence(e, correlated_create_vm(contiguity="strict"))) == []


def test_alert_struct_and_name(spark):
    e = entries(spark, CORR)
    a = match_sequence(e, correlated_create_vm()).first()
    assert a["alert_name"] == "ErrorAlert" and a["correlation_id"] == "vm-42"
    assert a["first"]["service"] == "Nova" and a["second"]["service"] == "Neutron"


def test_custom_pattern_and_validation(spark):
    e = entries(spark, CORR)
    pat = SequencePattern(Step("a", F.col("service") == "Nova"), Step("b", F.col("service") == "Keystone"),
                          "next", 10_000, name="Custom")
    out = match_sequence(e, pat)
    assert pairs(out) == [(1, 2)] and out.first()["alert_name"] == "Custom"
    with pytest.raises(ValueError):
        from logweave.operators.scan import next_match
        next_match(e.select(F.lit(1).alias("t")), [], "sometimes", 1)


def test_partition_by_override(spark):
    e = entries(spark, [(1, "10:00:00.000", "3", "Nova", "[a]"), (2, "10:01:00.000", "3", "Cinder", "[b]")])
    assert pairs(match_sequence(e, consecutive_errors())) == []
    assert pairs(match_sequence(e, consecutive_errors(), partition_by=[])) == [(1, 2)]


def test_range_exchange_reads_a_materialised_stage(spark):
    """The range exchange's sampling must not re-run the upstream plan: a rebalance sits below it."""
    e = entries(spark, [(i, f"10:{i // 60:02d}:{i % 60:02d}.000", "3", "Nova", "[a]") for i in range(50)])
    a = match_sequence(e, consecutive_errors())
    a.collect()
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "REBALANCE_PARTITIONS_BY_COL" in plan


def test_band_join_parses_input_once(spark):
    """Both join sides of the `any` mode read one materialised stage: from_json appears once."""
    from logweave.operators.parse import accepted_entries
    from logweave.sources.fixtures import read_event_lines
    from tests.conftest import SF_SMALL
    a = match_sequence(accepted_entries(read_event_lines(spark, SF_SMALL)), correlated_create_vm(contiguity="any"))
    a.collect()
    final = a._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("from_json") == 1 and "ReusedExchange" in final, final


def test_alert_properties_on_fixture(spark):
    """Every alert: same key, first before second, within the bound, the right levels, different ids."""
    from logweave.operators.parse import accepted_entries
    from logweave.sources.fixtures import read_event_lines
    from tests.conftest import SF_SMALL
    acc = accepted_entries(read_event_lines(spark, SF_SMALL))
    for pat, key, levels in [(consecutive_errors(120 * MINUTES), "service", ("3", "3")),
                             (correlated_create_vm(120 * MINUTES), "correlation_id", ("3", "6")),
                             (correlated_create_vm(120 * MINUTES, "any"), "correlation_id", ("3", "6"))]:
        rows = match_sequence(acc, pat).collect()
        assert rows
        for r in rows:
            a, b = r["first"], r["second"]
            assert (a["event_time"], a["seq"]) < (b["event_time"], b["seq"])
            assert (b["event_time"] - a["event_time"]).total_seconds() * 1000 < pat.within_ms
            assert (a["severity"], b["severity"]) == levels and a["id"] != b["id"]
            if key == "service":
                assert a["service"] == b["service"] == r["service"]
            else:
                assert f"CEP_ID={r['correlation_id']} " in a["body"] + " " and f"CEP_ID={r['correlation_id']} " in b["body"] + " "


@pytest.mark.parametrize("mode", ["strict", "next", "any"])
def test_empty_and_candidate_free_inputs(spark, mode):
    none = entries(spark, [(1, "10:00:00.000", "6", "Nova", "[a]")]).where("seq < 0")
    assert match_sequence(none, consecutive_errors()).count() == 0
    info_only = entries(spark, [(i, f"10:00:{i:02d}.000", "6", "Nova", "[a]") for i in range(20)])
    pat = correlated_create_vm(contiguity=mode) if mode != "strict" else consecutive_errors()
    assert match_sequence(info_only, pat, num_partitions=4).count() == 0


def test_key_expression_reusing_a_column_name(spark):
    e = entries(spark, [(1, "10:00:00.000", "3", "Nova", "[a]"), (2, "10:01:00.000", "3", "NOVA", "[b]")])
    base = consecutive_errors()
    assert pairs(match_sequence(e, base)) == []
    from dataclasses import replace
    folded = replace(base, key=(("service", F.lower(F.col("service"))),))
    out = match_sequence(e, folded)
    row = out.first()
    assert pairs(out) == [(1, 2)] and row["service"] == "nova"
    assert (row["first"]["service"], row["second"]["service"]) == ("Nova", "NOVA")   # records as they were


def test_pattern_validation(spark):
    err = F.col("severity") == "3"
    with pytest.raises(ValueError):
        SequencePattern(Step("a", err), Step("b", err), "sometimes")
    with pytest.raises(ValueError):
        SequencePattern(Step("a", err), Step("b", err), "next", 0)
