"""Property test: the range-partitioned scan equals a brute-force definition on random data.

Few keys and many slices force hot keys across slices, chains of slices with
no candidate ("transparent" in next mode), ties on time, and tiny Arrow batches.
"""

import random

import pytest
from pyspark.sql import functions as F

from logweave.operators.scan import next_match


def brute(rows, mode, within):
    out = set()
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for rs in by_key.values():
        rs.sort(key=lambda r: (r[1], r[2]))
        for i, (k, t, s, f, sec) in enumerate(rs):
            if not f:
                continue
            if mode == "strict":
                if i + 1 < len(rs) and rs[i + 1][4] and rs[i + 1][1] - t < within:
                    out.add((s, rs[i + 1][2]))
            else:
                for j in range(i + 1, len(rs)):
                    if rs[j][4]:
                        if rs[j][1] - t < within:
                            out.add((s, rs[j][2]))
                        break
    return out


@pytest.fixture(scope="module")
def tiny_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


@pytest.mark.parametrize("seed", range(20))
def test_scan_matches_brute_force(spark, tiny_batches, seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 150)
    keys = ["a", "b", "c"][: rnd.randint(1, 3)]
    p_first, p_second = rnd.random(), rnd.random() * 0.5
    rows = [(rnd.choice(keys), rnd.randint(0, 60), i, rnd.random() < p_first, rnd.random() < p_second)
            for i in range(n)]
    # a hot stretch of one key with first rows only (transparent slices in next mode)
    if seed % 2 == 0:
        rows += [("b", 30 + (j % 5), n + j, True, False) for j in range(rnd.randint(20, 80))]
    mode = "strict" if seed % 3 == 0 else "next"
    within = rnd.choice([1, 5, 20, 100])
    parts = rnd.choice([1, 2, 7, 16, 40])
    df = spark.createDataFrame([(k, t, s, f, sec, f"p{s}") for k, t, s, f, sec in rows],
                               "k string, t long, seq long, is_first boolean, is_second boolean, payload string")
    if mode == "next":
        df = df.where(F.col("is_first") | F.col("is_second"))
    got = next_match(df, ["k"], mode, within, num_partitions=parts).collect()
    assert all(r["p1"] == f"p{r['seq1']}" and r["p2"] == f"p{r['seq2']}" for r in got)
    assert {(r["seq1"], r["seq2"]) for r in got} == brute(rows, mode, within)
    assert len(got) == len({(r["seq1"], r["seq2"]) for r in got})


@pytest.mark.parametrize("mode", ["strict", "next"])
def test_unkeyed_scan(spark, tiny_batches, mode):
    rnd = random.Random(99)
    rows = [("", rnd.randint(0, 200), i, rnd.random() < 0.5, rnd.random() < 0.3) for i in range(120)]
    df = spark.createDataFrame([(t, s, f, sec, None) for _, t, s, f, sec in rows],
                               "t long, seq long, is_first boolean, is_second boolean, payload string")
    got = {(r["seq1"], r["seq2"]) for r in next_match(df, [], mode, 15, num_partitions=9).collect()}
    assert got == brute(rows, mode, 15)


@pytest.mark.parametrize("mode", ["strict", "next"])
def test_aqe_coalesced_slices_keep_order(spark, tiny_batches, mode):
    """With no explicit count AQE sizes the range exchange by merging adjacent slices; order holds."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rnd = random.Random(5)
        rows = [(rnd.choice(["a", "b"]), rnd.randint(0, 400), i, rnd.random() < 0.5, rnd.random() < 0.3)
                for i in range(400)]
        df = spark.createDataFrame([(k, t, s, f, sec, None) for k, t, s, f, sec in rows],
                                   "k string, t long, seq long, is_first boolean, is_second boolean, payload string")
        if mode == "next":
            df = df.where(F.col("is_first") | F.col("is_second"))
        got = {(r["seq1"], r["seq2"]) for r in next_match(df, ["k"], mode, 25).collect()}
        assert got == brute(rows, mode, 25)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _open_rows_cost(n):
    """Seconds the slice scan takes over ``n`` first rows of one key that all wait."""
    import time
    from unittest import mock

    import numpy as np
    import pandas as pd

    from logweave.operators.scan import _scan_factory

    step = 10_000
    batches = [pd.DataFrame({"k": "a", "t": np.arange(i, i + step), "seq": np.arange(i, i + step), "is_first": True,
                             "is_second": False, "payload": "p"}) for i in range(0, n, step)]
    with mock.patch("pyspark.TaskContext.get") as context:
        context.return_value.partitionId.return_value = 0
        begin = time.perf_counter()
        rows = sum(len(out) for out in _scan_factory(["k"], "next", 10 * n)(iter(batches)))
        assert rows == n + 2  # the waiting rows, one marker, one head
        return time.perf_counter() - begin


def test_waiting_rows_cost_in_proportion():
    _open_rows_cost(50_000)
    small = min(_open_rows_cost(250_000) for _ in range(3))
    large = min(_open_rows_cost(1_000_000) for _ in range(3))
    assert large < 8 * small  # four times the rows; a scan that starts over at each batch takes sixteen times
