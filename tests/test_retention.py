"""Fan-out, expiry, TTL reads, latest-by-key and the table families (FAN1, RD1-RD8, PRS15-18)."""

import datetime as dt

from pyspark.sql import functions as F

from logweave.operators.retention import fan_out, latest_by_key, live, ttl_left, with_expiry
from logweave.operators.views import NODE_KEYS, counts, node_rows, raw_rows, service_rows, stack_rows
from logweave.schema import HORIZONS

AS_OF = dt.datetime(2024, 1, 31)


def accepted(spark, ages_s):
    rows = [(i, "ERROR" if i % 2 else "INFO", f"h{i % 2}", "Nova", AS_OF - dt.timedelta(seconds=a),
             (AS_OF - dt.timedelta(seconds=a)).strftime("%Y-%m-%d %H:%M:%S.000"), f"[b{i}]")
            for i, a in enumerate(ages_s)]
    return spark.createDataFrame(rows, "seq long, level string, hostname string, service string, "
                                       "event_time timestamp, timestamp string, body string")


def test_fan_out_six_horizons(spark):
    df = fan_out(spark.range(3).withColumnRenamed("id", "seq"))
    assert df.count() == 18
    assert {(r["horizon_id"], r["horizon_s"]) for r in df.collect()} == set(HORIZONS)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_stack_rows_period_and_ttl(spark):
    acc = accepted(spark, [10, 4000, 90000, 700000, 3000000, -5])
    st = stack_rows(acc, AS_OF)
    got = {(r["seq"], r["id"]) for r in st.collect()}
    # age 10 s: all horizons; 4000 s: from 6h; 90000 s: from 1w; 700000 s: 1m only; 3e6 s: none; future: none
    assert {h for s, h in got if s == 0} == {"1h", "6h", "12h", "24h", "1w", "1m"}
    assert {h for s, h in got if s == 1} == {"6h", "12h", "24h", "1w", "1m"}
    assert {h for s, h in got if s == 2} == {"1w", "1m"}
    assert {h for s, h in got if s == 3} == {"1m"}
    assert not {h for s, h in got if s in (4, 5)}
    for r in st.collect():
        assert 0 < r["ttl_s"] <= dict(HORIZONS)[r["id"]]
        assert 0 <= r["timeframe"] <= 1440
        assert r["region"] == "boston"
    # point lookup by id prunes to one horizon
    assert st.where(F.col("id") == "24h").count() == 2


def test_node_and_service_rows_ttl_and_live(spark):
    acc = accepted(spark, [10, 7200, 100000])
    nodes = node_rows(acc, AS_OF)
    assert nodes.count() == 18
    assert set(nodes.columns) >= set(NODE_KEYS) | {"seq", "ttl_s", "expires_at", "row_key"}
    # written now with TTL = horizon: 2 hours later only 1h rows have expired
    later = AS_OF + dt.timedelta(hours=2)
    assert {r["id"] for r in live(nodes, later).collect()} == {"6h", "12h", "24h", "1w", "1m"}
    # replayed with ingest = event time: the counters are rolling counts per horizon
    replay = service_rows(acc, F.col("event_time"))
    c = {r["id"]: r["n"] for r in live(replay, AS_OF).groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert c == {"1h": 1, "6h": 2, "12h": 2, "24h": 2, "1w": 3, "1m": 3}
    cnt = counts(replay, AS_OF, ["id", "service"])
    assert cnt.where(F.col("id") == "1w").first()["n_rows"] == 3


def test_ttl_left(spark):
    df = spark.createDataFrame([(1, 100), (2, 3600)], "seq long, ttl_s int")
    stored = with_expiry(df, AS_OF)
    got = {r["seq"]: r["ttl_left"] for r in ttl_left(stored, AS_OF + dt.timedelta(seconds=30.5)).collect()}
    assert got == {1: 69, 2: 3569}
    assert ttl_left(stored, AS_OF + dt.timedelta(seconds=100)).count() == 1


def test_raw_rows_and_latest(spark):
    acc = accepted(spark, [10, 20, 30, 86400 * 3])
    raw = raw_rows(acc)
    assert {r["date"] for r in raw.collect()} == {"2024-1-30", "2024-1-28"}
    latest = latest_by_key(raw, ["date", "service", "loglevel", "region"], ["seq"])
    got = {(r["date"], r["loglevel"], r["seq"]) for r in latest.collect()}
    assert got == {("2024-1-30", "INFO", 2), ("2024-1-30", "ERROR", 1), ("2024-1-28", "ERROR", 3)}


def test_latest_by_key_hot_key_is_pre_aggregated(spark):
    df = spark.range(0, 20000).select(F.lit("hot").alias("k"), F.col("id").alias("seq"),
                                      (F.col("id") * 7 % 1000).alias("v"))
    out = latest_by_key(df, ["k"], ["seq"])
    assert out.first()["seq"] == 19999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_recent_keeps_exactly_what_can_be_live(spark):
    from logweave.operators.views import recent
    month = 2419200
    acc = accepted(spark, [10, month - 1, month, month + 5])
    kept = {r["seq"] for r in recent(acc, AS_OF).collect()}
    live_ids = {r["seq"] for r in live(service_rows(acc, F.col("event_time")), AS_OF).collect()}
    assert kept == live_ids == {0, 1}
