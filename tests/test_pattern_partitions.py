"""The ordered scan must not depend on partitioning or Arrow batch size (cross-slice resolution)."""

import pytest

from logweave.operators.parse import accepted_entries
from logweave.operators.patterns import MINUTES, consecutive_errors, correlated_create_vm, match_sequence
from logweave.plans.oracle import oracle_sql
from logweave.plans.queries import fmt
from logweave.plans.verify import compare, duck
from logweave.sources.fixtures import read_event_lines
from pyspark.sql import functions as F
from tests.conftest import SF_MID

CASES = {
    "alerts_consecutive": (lambda: consecutive_errors(), "service"),
    "alerts_consecutive_2h": (lambda: consecutive_errors(120 * MINUTES), "service"),
    "alerts_correlated": (lambda: correlated_create_vm(), "correlation_id"),
    "alerts_correlated_2h": (lambda: correlated_create_vm(120 * MINUTES), "correlation_id"),
    "alerts_correlated_strict": (lambda: correlated_create_vm(contiguity="strict"), "correlation_id"),
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_MID)


@pytest.fixture(scope="module")
def small_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


@pytest.mark.parametrize("parts", [1, 5, 64])
@pytest.mark.parametrize("name", sorted(CASES))
def test_alerts_independent_of_partitions(spark, con, small_batches, name, parts):
    make, key = CASES[name]
    pattern = make()
    acc = accepted_entries(read_event_lines(spark, SF_MID))
    a = match_sequence(acc, pattern, num_partitions=parts)
    df = a.select(key, F.col("first.seq").alias("first_seq"), F.col("second.seq").alias("second_seq"),
                  fmt("first.event_time").alias("first_time"), fmt("second.event_time").alias("second_time"))
    res = compare(df, con, oracle_sql()[name])
    assert res["ok"], res


def test_unkeyed_global_order(spark):
    """An empty key is one global order, still spread over many slices."""
    from logweave.operators.patterns import SequencePattern, Step
    rows = [(i, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", "3" if i % 3 else "6") for i in range(200)]
    df = spark.createDataFrame(rows, "seq long, ts string, severity string") \
        .select("seq", F.to_timestamp("ts").alias("event_time"), "severity")
    err = F.col("severity") == "3"
    pat = SequencePattern(Step("a", err), Step("b", err), "strict", 2000)
    got = {(r["first"]["seq"], r["second"]["seq"]) for r in match_sequence(df, pat, num_partitions=13).collect()}
    expected = {(i, i + 1) for i in range(199) if i % 3 and (i + 1) % 3}
    assert got == expected
    pat = SequencePattern(Step("a", err), Step("b", F.col("severity") == "6"), "next", 5000)
    got = {(r["first"]["seq"], r["second"]["seq"]) for r in match_sequence(df, pat, num_partitions=13).collect()}
    expected = {(i, (i // 3 + 1) * 3) for i in range(200) if i % 3 and (i // 3 + 1) * 3 < 200}
    assert got == expected
