"""Streaming: keyed-state matcher equals batch; late rows dropped; tables per micro-batch (STR1-STR10)."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from logweave.operators.parse import accepted_entries
from logweave.operators.patterns import MINUTES, consecutive_errors, correlated_create_vm, match_sequence
from logweave.sinks.commitlog import read_table
from logweave.streaming.jobs import alerts_stream, run_with_restarts, start_tables_stream
from logweave.sources.fixtures import read_event_lines
from tests.conftest import SF_SMALL


def jline(seq, hhmmss, sev="3", svc="Nova", body_tail="[x] y"):
    body = f"svc 2017-04-26 {hhmmss}.000 1 {'ERROR' if sev == '3' else 'INFO'} m {body_tail}"
    return (seq, json.dumps({"severity": sev, "body": body, "spriority": "1", "hostname": "h", "protocol": "p",
                             "port": "1", "sender": "s", "service": svc, "id": str(seq), "facility": "1",
                             "timestamp": "t"}))


def run_files(spark, chunks, pattern, delay_s=0, future_cap_s=None, progress=None):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for i, rows in enumerate(chunks):
        spark.createDataFrame(rows, "seq long, value string").coalesce(1).write.parquet(f"{d}/src/c{i:03d}")
    stream = spark.readStream.schema("seq long, value string").option("maxFilesPerTrigger", 1).parquet(f"{d}/src/*")
    name = "alerts_" + d.rsplit("-", 1)[-1]
    a = alerts_stream(stream, pattern, delay_s=delay_s, future_cap_s=future_cap_s).select(F.col("first.seq").alias("s1"),
                                                               F.col("second.seq").alias("s2"))
    q = a.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{d}/ck").start()
    q.processAllAvailable()
    q.stop()
    if progress is not None:
        progress.extend(q.recentProgress)
    return sorted((r.s1, r.s2) for r in spark.sql(f"select * from {name}").collect()), d, stream


def test_late_row_dropped_in_stream(spark):
    chunks = [[jline(1, "00:01:00"), jline(2, "00:02:00", "6"), jline(3, "00:03:00")],
              [jline(4, "00:05:00"), jline(5, "00:30:00")],
              [jline(6, "00:00:30")],                    # late: behind the watermark
              [jline(99, "23:00:00", svc="Zed")]]        # moves the watermark past everything
    progress = []
    got, _, _ = run_files(spark, chunks, consecutive_errors(), progress=progress)
    assert got == [(3, 4)]
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p.get("stateOperators", []))
    assert dropped == 1
    batch_lines = spark.createDataFrame([r for c in chunks for r in c], "seq long, value string")
    assert sorted((r["first"]["seq"], r["second"]["seq"]) for r in
                  match_sequence(accepted_entries(batch_lines), consecutive_errors()).collect()) == [(3, 4), (6, 1)]


def test_out_of_order_within_bound(spark):
    chunks = [[jline(2, "00:02:00"), jline(1, "00:01:00")], [jline(3, "00:02:30"), jline(4, "00:02:10", "6")],
              [jline(99, "23:00:00", svc="Zed")]]
    got, _, _ = run_files(spark, chunks, consecutive_errors(), delay_s=120)
    assert got == [(1, 2)]


@pytest.mark.parametrize("make", [lambda: consecutive_errors(120 * MINUTES),
                                  lambda: correlated_create_vm(120 * MINUTES),
                                  lambda: correlated_create_vm(120 * MINUTES, "any"),
                                  lambda: correlated_create_vm(120 * MINUTES, "strict")])
def test_stream_equals_batch_on_fixture(spark, make):
    pattern = make()
    lines = read_event_lines(spark, SF_SMALL)
    acc = accepted_entries(lines)
    ordered = [(r["seq"], r["value"]) for r in
               lines.join(acc.select("seq", "event_time"), "seq").orderBy("event_time", "seq").collect()]
    chunks = [ordered[i:i + 100] for i in range(0, len(ordered), 100)]
    chunks.append([jline(10**9, "23:59:59", svc="Zed")])
    chunks[-1] = [(10**9, chunks[-1][0][1].replace("2017-04-26", "2030-01-01"))]
    got, _, _ = run_files(spark, chunks, pattern)
    exp = sorted((r["first"]["seq"], r["second"]["seq"]) for r in match_sequence(acc, pattern).collect())
    assert got == exp and len(exp) > 0


def test_tables_stream_writes_every_row(spark):
    lines = read_event_lines(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = [(r["seq"], r["value"]) for r in lines.orderBy("seq").collect()]
    for i in range(0, len(rows), 250):
        spark.createDataFrame(rows[i:i + 250], "seq long, value string").coalesce(1).write.parquet(f"{d}/src/c{i:05d}")
    stream = spark.readStream.schema("seq long, value string").option("maxFilesPerTrigger", 1).parquet(f"{d}/src/*")
    q = start_tables_stream(stream, f"{d}/out", checkpoint=f"{d}/ck", available_now=True, keep_latest=True)
    q.awaitTermination()
    n_acc = accepted_entries(lines).count()
    from logweave.operators.retention import latest_by_key
    from logweave.operators.views import RAW_KEYS, raw_rows
    exp = latest_by_key(raw_rows(accepted_entries(lines)), RAW_KEYS, ["seq"])
    got = read_table(spark, f"{d}/out/raw_latest")
    assert sorted(r["seq"] for r in got.collect()) == sorted(r["seq"] for r in exp.collect())
    observed = [p["observedMetrics"]["ingest"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(m["lines"] for m in observed) == len(rows)
    assert sum(m["accepted"] for m in observed) == n_acc
    for name in ("node_rows", "service_rows", "stack_rows", "raw_rows"):
        # stack rows: these events are older than every horizon, so none is due
        stored = read_table(spark, f"{d}/out/{name}").count() if name != "stack_rows" else 0
        assert sum(m[name] for m in observed) == stored == {"stack_rows": 0, "raw_rows": n_acc}.get(name, 6 * n_acc)
    assert read_table(spark, f"{d}/out/quarantine").count() == len(rows) - n_acc
    assert read_table(spark, f"{d}/out/node_rows").select("batch_id").distinct().count() == 4


def test_stack_counter_counts_the_rows_that_are_stored(spark):
    import datetime as dt
    now = dt.datetime.now(dt.timezone.utc)
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = []
    for i, hours in enumerate((0.5, 3, 30, 24 * 10, 24 * 40)):
        when = (now - dt.timedelta(hours=hours)).strftime("%Y-%m-%d %H:%M:%S")
        rows.append((i, jline(i, "00:00:00")[1].replace("2017-04-26 00:00:00", when)))
    spark.createDataFrame(rows, "seq long, value string").write.parquet(f"{d}/src/c0")
    stream = spark.readStream.schema("seq long, value string").parquet(f"{d}/src/*")
    q = start_tables_stream(stream, f"{d}/out", checkpoint=f"{d}/ck", available_now=True)
    q.awaitTermination()
    due = sum(p["observedMetrics"]["ingest"]["stack_rows"] for p in q.recentProgress if p.get("observedMetrics"))
    assert due == read_table(spark, f"{d}/out/stack_rows").count() == 6 + 5 + 2 + 1


def test_file_stream_keeps_line_order(spark):
    """Lines of one millisecond, many of them alike, match as in batch: the file's order decides."""
    import os
    from logweave.sources.text import read_lines
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    os.makedirs(f"{d}/src")
    kinds = [("3", "6", "3", "3")[i % 4] for i in range(400)]
    with open(f"{d}/src/a.txt", "w") as f:
        for k in kinds:
            f.write(jline(7, "00:01:00", k)[1] + "\n")
    with open(f"{d}/src/b.txt", "w") as f:
        f.write(jline(8, "23:00:00", svc="Zed")[1] + "\n")
    arrow = "spark.sql.execution.arrow.maxRecordsPerBatch"
    split = "spark.sql.files.maxPartitionBytes"
    keep = {c: spark.conf.get(c) for c in (arrow, split)}
    # several splits for the file, several Arrow batches for a split
    spark.conf.set(arrow, "7")
    spark.conf.set(split, "8192")
    try:
        lines = read_lines(spark, f"{d}/src", streaming=True)
        numbered = lines.writeStream.format("parquet").option("checkpointLocation", f"{d}/ck0") \
            .trigger(availableNow=True).start(f"{d}/numbered")
        numbered.awaitTermination()
        pattern = consecutive_errors()
        a = alerts_stream(read_lines(spark, f"{d}/src", streaming=True, max_files_per_trigger=1), pattern)
        q = a.select(F.col("first.seq").alias("s1"), F.col("second.seq").alias("s2")).writeStream.format("memory") \
            .queryName("order_" + d.rsplit("-", 1)[-1]).option("checkpointLocation", f"{d}/ck").start()
        q.processAllAvailable()
        q.stop()
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    stored = spark.read.parquet(f"{d}/numbered")
    assert stored.count() == stored.select("seq").distinct().count() == 401
    ordered = [r["value"] for r in stored.where("value not like '%Zed%'").orderBy("seq").collect()]
    assert ordered == [jline(7, "00:01:00", k)[1] for k in kinds]
    batch = match_sequence(accepted_entries(read_lines(spark, f"{d}/src/a.txt")), pattern).count()
    n = spark.sql(f"select * from order_{d.rsplit('-', 1)[-1]}").count()
    assert n == batch == sum(1 for x, y in zip(kinds, kinds[1:]) if x == y == "3")


@pytest.mark.parametrize("mode", ["strict", "next"])
def test_pairs_across_buckets_and_a_spread_backlog(spark, mode):
    """Pairs on both sides of a bucket's edge are found once; a one-service backlog fills many buckets."""
    import random
    from dataclasses import replace
    rnd = random.Random(11)
    rows, second = [], 0
    for i in range(300):
        second += rnd.choice((0, 1, 59, 61, 599, 600, 601))
        h, rest = divmod(second, 3600)
        rows.append(jline(i, f"{h % 24:02d}:{rest // 60:02d}:{rest % 60:02d}", rnd.choice("36")))
        rows[-1] = (i, rows[-1][1].replace("2017-04-26", f"2017-04-{1 + h // 24:02d}"))
    pattern = replace(consecutive_errors(), contiguity=mode)
    end = [(10**6, jline(10**6, "23:00:00", svc="Zed")[1].replace("2017-04-26", "2030-01-01"))]
    exp = sorted((r["first"]["seq"], r["second"]["seq"]) for r in
                 match_sequence(accepted_entries(spark.createDataFrame(rows, "seq long, value string")), pattern).collect())
    progress = []
    got, _, _ = run_files(spark, [rows, end], pattern, progress=progress)
    assert got == exp and len(exp) > 20
    peak = max(op["numRowsTotal"] for p in progress for op in p["stateOperators"])
    left = [op["numRowsTotal"] for p in progress for op in p["stateOperators"]][-1]
    assert peak > 10 and left <= 2       # what is left: buckets of the last row


def test_latest_row_across_kafka_partitions(spark):
    from logweave.sources.kafka import kafka_lines
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    schema = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    early, late = jline(1, "00:01:00", body_tail="[early]")[1], jline(2, "00:01:00", body_tail="[late]")[1]
    # the higher partition holds the older record
    spark.createDataFrame([(None, early.encode(), "t", 5, 900, t, 0), (None, late.encode(), "t", 0, 3, t + dt.timedelta(seconds=1), 0)],
                          schema).write.parquet(f"{d}/src/c0")
    lines = kafka_lines(spark.readStream.schema(schema).parquet(f"{d}/src/*"))
    start_tables_stream(lines, f"{d}/out", checkpoint=f"{d}/ck", available_now=True, keep_latest=True).awaitTermination()
    assert [r["payload"] for r in read_table(spark, f"{d}/out/raw_latest").collect()] == ["[late]"]


def test_run_with_restarts():
    from pyspark.errors import StreamingQueryException

    class Q:
        def __init__(self, fail):
            self.fail = fail

        def awaitTermination(self):
            if self.fail:
                raise StreamingQueryException("boom")

    outcomes = iter([True, True, False])
    sleeps = []
    q = run_with_restarts(lambda: Q(next(outcomes)), attempts=3, delay_s=5, sleep=sleeps.append)
    assert not q.fail and sleeps == [5, 5]
    always = iter([True] * 5)
    with pytest.raises(StreamingQueryException):
        run_with_restarts(lambda: Q(next(always)), attempts=2, delay_s=0, sleep=lambda s: None)


def test_command_line_job_on_files(spark):
    from logweave.__main__ import start
    from logweave.config import PipelineConfig
    lines = read_event_lines(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    import os
    os.makedirs(f"{d}/src")
    with open(f"{d}/src/part-0.txt", "w") as f:
        for r in lines.orderBy("seq").collect():
            f.write(r["value"] + "\n")
    cfg = PipelineConfig.from_args(["--topic", "t", "--broker", "b", "--target-topic", "a", "--tables.path",
                                    f"{d}/tables", "--source.path", f"{d}/src", "--alerts.path", f"{d}/alerts",
                                    "--once", "true"])
    both = start(spark, cfg)
    both.awaitTermination()
    n_acc = accepted_entries(lines).count()
    alerts_q = both.queries[1]
    n_alerts = sum(p["observedMetrics"]["alerts"]["alerts"] for p in alerts_q.recentProgress
                   if p.get("observedMetrics", {}).get("alerts"))
    assert n_alerts == spark.read.text(f"{d}/alerts", wholetext=True).rdd.map(
        lambda r: r[0].count("ErrorAlert: ")).sum()
    assert read_table(spark, f"{d}/tables/raw_rows").count() == n_acc
    assert read_table(spark, f"{d}/tables/node_rows").count() == 6 * n_acc


def test_future_cap_keeps_watermark_honest(spark):
    future = (50, jline(50, "00:00:00")[1].replace("2017-04-26", "2099-01-01"))
    chunks = [[jline(1, "00:01:00"), future], [jline(3, "00:01:30", svc="Cinder")], [jline(2, "00:02:00")],
              [jline(99, "23:00:00", svc="Zed")]]
    # without the cap the future row moves the watermark and row 2 is late
    assert run_files(spark, chunks, consecutive_errors())[0] == []
    progress = []
    assert run_files(spark, chunks, consecutive_errors(), future_cap_s=3600, progress=progress)[0] == [(1, 2)]
    assert sum(p.observedMetrics["future_rows"]["dropped"] for p in progress if p.numInputRows) == 1


def test_future_cap_with_the_join_of_any(spark):
    pattern = correlated_create_vm(contiguity="any")
    future = (50, jline(50, "00:00:00")[1].replace("2017-04-26", "2099-01-01"))
    progress = []
    run_files(spark, [[jline(1, "00:01:00"), future]], pattern, future_cap_s=3600, progress=progress)
    assert sum(p.observedMetrics["future_rows"]["dropped"] for p in progress if p.numInputRows) == 1


def test_disorder_within_bound_equals_batch(spark):
    """Rows shuffled across neighbouring micro-batches give the batch result when the delay covers them."""
    import random
    pattern = correlated_create_vm(120 * MINUTES)
    lines = read_event_lines(spark, SF_SMALL)
    acc = accepted_entries(lines)
    ordered = [(r["seq"], r["value"]) for r in
               lines.join(acc.select("seq", "event_time"), "seq").orderBy("event_time", "seq").collect()]
    rnd = random.Random(7)
    chunks = [ordered[i:i + 100] for i in range(0, len(ordered), 100)]
    for i in range(len(chunks) - 1, 0, -1):       # push a few rows one micro-batch later
        moved = [r for r in chunks[i - 1] if rnd.random() < 0.2]
        chunks[i - 1] = [r for r in chunks[i - 1] if r not in moved]
        chunks[i] = chunks[i] + moved
    for c in chunks:
        rnd.shuffle(c)
    # two sentinels: the first moves the watermark, the second batch evicts with it
    # (processAllAvailable does not wait for the no-data batch that would otherwise do it)
    for k in (1, 2):
        chunks.append([(10**9 + k, jline(10**9 + k, "23:59:59", svc="Zed")[1].replace("2017-04-26", f"203{k}-01-01"))])
    # 100 rows span at most a few days here; a 10-day delay covers any row moved by one batch
    got, _, _ = run_files(spark, chunks, pattern, delay_s=10 * 86400)
    exp = sorted((r["first"]["seq"], r["second"]["seq"]) for r in match_sequence(acc, pattern).collect())
    assert got == exp and len(exp) > 0
