"""Patterns of many steps and conditions across rows against brute force, in batch and in streams (SEQ2, SEQ7, UDF3, STR10)."""

import datetime as dt
import random
import tempfile
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.operators.chain import Way, compose
from logweave.operators.patterns import ChainPattern, Compare, Step, consecutive_errors, match_sequence
from logweave.operators.search import first_beyond, first_other
from logweave.streaming.matcher import _chain_matcher, _matcher, match_sequence_stream

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "seq long, event_time timestamp, service string, level string, x long, y double, host string"
OPS = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "=": lambda a, b: a == b, "<>": lambda a, b: a != b}


def random_rows(seed, n, keys=3, step=3):
    rnd = random.Random(seed)
    t, out = 0, []
    for i in range(n):
        t += rnd.choice((0, 0, 1, step))
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(keys)}"
        out.append((i, DAY + dt.timedelta(seconds=t), key, rnd.choice("ABC"), rnd.choice((None, *range(6))), rnd.choice((None, 0.5, -1.5, 2.25, 3.0)), rnd.choice(("a", "b", None))))
    rnd.shuffle(out)
    return out


COLUMN = {"x": 4, "y": 5, "host": 6}


def brute(rows, levels, strict, compares, within_s, keyed=True):
    """levels[k]: the level of step k; compares: {step: (op, column)}; rows of the matches by seq."""
    out = set()
    for key in {r[2] for r in rows} if keyed else {None}:
        own = sorted((r for r in rows if not keyed or r[2] == key), key=lambda r: (r[1], r[0]))
        for i, first in enumerate(own):
            if first[3] not in levels[0]:
                continue
            at, taken = i, [first]
            for k in range(1, len(levels)):
                def good(r):
                    if r[3] not in levels[k]:
                        return False
                    if k in compares:
                        op, c = compares[k]
                        a, b = r[COLUMN[c]], first[COLUMN[c]]
                        return a is not None and b is not None and OPS[op](a, b)
                    return True
                later = range(at + 1, min(at + 2, len(own))) if strict[k] else range(at + 1, len(own))
                at = next((j for j in later if good(own[j])), None)
                if at is None:
                    break
                taken.append(own[at])
            else:
                if (taken[-1][1] - first[1]).total_seconds() < within_s:
                    out.add(tuple(r[0] for r in taken))
    return out


def pattern_of(levels, strict, compares, within_s, keyed=True):
    steps = tuple(Step(f"s{k}", F.col("level").isin(list(lv)), "strict" if strict[k] else "next",
                       Compare(compares[k][0], F.col(compares[k][1]), F.col(compares[k][1])) if k in compares else None) for k, lv in enumerate(levels))
    return ChainPattern(steps, within_s * 1000, key=(("service", F.col("service")),) if keyed else ())


def found(df):
    rows = df.collect()
    out = {tuple(e["seq"] for e in r["events"]) for r in rows}
    assert len(out) == len(rows)
    return out


CASES = [(["A", "B", "C"], [False, False, False]), (["A", "AB", "B"], [False, True, True]), (["A", "B", "C"], [False, False, True]),
         (["AB", "B", "AC", "C"], [False, True, False, False]), (["A", "A"], [False, False])]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_chain_equals_brute_force_for_any_slices(spark, case):
    levels, strict = CASES[case]
    rows = random_rows(case, 400)
    df = spark.createDataFrame(rows, SCHEMA)
    arrow = "spark.sql.execution.arrow.maxRecordsPerBatch"
    keep = spark.conf.get(arrow)
    for keyed in (True, False):
        expected = brute(rows, levels, strict, {}, 30, keyed)
        assert len(expected) > 5
        for slices, records in ((1, "3"), (7, "10000"), (23, "4")):
            spark.conf.set(arrow, records)
            try:
                assert found(match_sequence(df, pattern_of(levels, strict, {}, 30, keyed), num_partitions=slices)) == expected, (keyed, slices)
            finally:
                spark.conf.set(arrow, keep)


@pytest.mark.parametrize("op,column", [(">", "x"), (">=", "y"), ("<", "y"), ("<=", "x"), ("<>", "host"), ("=", "host"), ("<>", "x")])
@pytest.mark.parametrize("strict", [False, True])
def test_condition_on_the_first_row_equals_brute_force(spark, op, column, strict):
    rows = random_rows(sum(map(ord, op + column)), 300)
    df = spark.createDataFrame(rows, SCHEMA)
    arrow = "spark.sql.execution.arrow.maxRecordsPerBatch"
    keep = spark.conf.get(arrow)
    pattern = pattern_of(["AB", "ABC"], [False, strict], {1: (op, column)}, 25)
    expected = brute(rows, ["AB", "ABC"], [False, strict], {1: (op, column)}, 25)
    assert len(expected) > 5
    for slices, records in ((23, "4"),) if strict else ((1, "7"), (17, "4")):
        spark.conf.set(arrow, records)
        try:
            assert found(match_sequence(df, pattern, num_partitions=slices)) == expected, slices
        finally:
            spark.conf.set(arrow, keep)


def test_three_steps_with_conditions_and_no_all_pairs_plan(spark):
    rows = random_rows(5, 500)
    df = spark.createDataFrame(rows, SCHEMA)
    compares = {1: (">", "x"), 2: ("<>", "host")}
    pattern = pattern_of(["AB", "BC", "AC"], [False] * 3, compares, 40)
    got = match_sequence(df, pattern, num_partitions=11)
    expected = brute(rows, ["AB", "BC", "AC"], [False] * 3, compares, 40)
    assert found(got) == expected and len(expected) > 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rising_values_that_wait_over_many_slices(spark):
    """One key, values that fall for long and rise at the end: every mark waits for one far slice."""
    n = 600
    rows = [(i, DAY + dt.timedelta(milliseconds=i), "k", "A", n - i if i < n - 10 else n + i, 0.0, "a") for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    pattern = pattern_of(["A", "A"], [False, False], {1: (">", "x")}, 3600)
    assert found(match_sequence(df, pattern, num_partitions=31)) == brute(rows, ["A", "A"], [False, False], {1: (">", "x")}, 3600)


def test_no_rows_and_refused_patterns(spark):
    none = spark.createDataFrame([], SCHEMA)
    for compares in ({}, {1: (">", "x")}):
        assert match_sequence(none, pattern_of(["A", "B"], [False, False], compares, 9)).count() == 0
    with pytest.raises(ValueError):
        ChainPattern((Step("one", F.lit(True)),))
    with pytest.raises(ValueError):
        pattern_of(["A", "B"], [False, False], {1: ("like", "x")}, 9)
    with pytest.raises(ValueError):
        match_sequence(none, pattern_of(["A", "B"], [False, False], {1: ("<", "host")}, 9))
    with pytest.raises(ValueError):
        ChainPattern((Step("one", F.lit(True)), Step("two", F.lit(True), "any")))


def test_text_and_key_of_a_chain(spark):
    from logweave.sinks.writers import alerts_to_outbox, alerts_to_text
    fields = "seq long, severity string, body string, spriority string, hostname string, protocol string, port string, sender string, service string, id string, facility string, timestamp string"
    event = lambda k: (k, "3", f"b{k}", None, "h", "p", "1", "s", "Nova", str(k), "1", f"t{k}")
    alerts = spark.createDataFrame([([event(1), event(2), event(3)], "A")], f"events array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>, alert_name string")
    text = alerts_to_text(alerts, with_key=True).first()
    lines = text.value.split("\n")
    assert text.key == "1-2-3" and lines[0] == "ErrorAlert: " and lines[1:4] == ["Nova-3-t1", "Nova-3-t2", "Nova-3-t3"] and len(lines) == 8 and lines[-1] == ""
    assert all(f'"body":"b{k}"' in lines[3 + k] and '"spriority":""' in lines[3 + k] for k in (1, 2, 3))
    assert list(alerts_to_outbox(alerts).first().seqs) == [1, 2, 3]


def test_tables_compose_in_any_grouping():
    a = {1: Way(2, [5], 50, ["p"]), 2: Way(2), 3: Way(0)}
    b = {1: Way(1), 2: Way(3, [7], 70, ["q"]), 3: Way(4, [8], 80, ["r"])}
    c = {1: Way(0), 2: Way(2), 3: Way(4, [9], 90, ["s"])}
    left, right = compose(compose(a, b, 4), c, 4), compose(a, compose(b, c, 4), 4)
    assert left == right and left[1] == Way(4, [5, 7, 9], 90, ["p", "q", "s"]) and left[3].leave == 0
    assert compose(a, None, 4)[1].leave == 0


def test_ordered_searches_against_a_loop():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 64, 100):
        v = rnd.integers(0, 9, n)
        start, wanted = rnd.integers(0, n + 1, 50), rnd.integers(-1, 10, 50)
        for equal in (False, True):
            expected = [next((i for i in range(s, n) if v[i] > w or equal and v[i] == w), n) for s, w in zip(start, wanted)]
            assert first_beyond(v, start, wanted, equal).tolist() == expected
        assert first_other(v, start, wanted).tolist() == [next((i for i in range(s, n) if v[i] != w), n) for s, w in zip(start, wanted)]


# -- streams --------------------------------------------------------------------------------------

def run_stream(spark, rows, pattern, size=60, delay_s=0, state="value"):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    chunks = [ordered[i:i + size] for i in range(0, len(ordered), size)]
    for k in (1, 2):  # rows of their own key move the watermark past all others
        chunks.append([(10**6 + k, dt.datetime(2030 + k, 1, 1), "end", "Z", None, None, None)])
    for i, c in enumerate(chunks):
        spark.createDataFrame(c, SCHEMA).coalesce(1).write.parquet(f"{d}/src/c{i:03d}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{d}/src/*")
    name = "chain_" + d.rsplit("-", 1)[-1]
    out = match_sequence_stream(stream, pattern, delay_s=delay_s, state=state)
    q = out.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{d}/ck").start()
    q.processAllAvailable()
    q.stop()
    return spark.sql(f"select * from {name}"), q.recentProgress


@pytest.mark.parametrize("strict,compares", [([False, False, False], {}), ([False, True, False], {}), ([False, False, False], {1: (">", "x"), 2: ("=", "host")})])
def test_chain_stream_equals_batch(spark, strict, compares):
    rows = random_rows(17, 360, step=7)
    pattern = pattern_of(["A", "AB", "BC"], strict, compares, 30)
    got, _ = run_stream(spark, rows, pattern)
    expected = brute(rows, ["A", "AB", "BC"], strict, compares, 30)
    assert found(got) == expected and len(expected) > 3


@pytest.mark.parametrize("contiguity", ["strict", "next"])
def test_unkeyed_stream_equals_batch_and_spreads_a_backlog(spark, contiguity):
    rows = random_rows(23, 500, step=9)
    pattern = replace(consecutive_errors(20_000), contiguity=contiguity, key=(), first=Step("a", F.col("level") == "A"), second=Step("b", F.col("level").isin("A", "B")))
    expected = sorted((r["first"]["seq"], r["second"]["seq"]) for r in match_sequence(spark.createDataFrame(rows, SCHEMA), pattern).collect())
    got, progress = run_stream(spark, rows, pattern, size=500)
    assert sorted((r["first"]["seq"], r["second"]["seq"]) for r in got.collect()) == expected and len(expected) > 20
    # the backlog of one batch lies in several buckets, each a group of its own
    assert max(op["numRowsTotal"] for p in progress for op in p["stateOperators"]) > 3


@pytest.mark.parametrize("kind", ["strict", "next", "chain"])
def test_state_in_slots_equals_batch(spark, kind):
    rows = random_rows(31, 300, step=9)
    if kind == "chain":
        pattern = pattern_of(["A", "AB", "BC"], [False, True, False], {}, 30)
    else:
        pattern = replace(consecutive_errors(20_000), contiguity=kind, first=Step("a", F.col("level") == "A"), second=Step("b", F.col("level").isin("A", "B")))
    seqs = lambda df: sorted(tuple(e["seq"] for e in r["events"]) if kind == "chain" else (r["first"]["seq"], r["second"]["seq"]) for r in df.collect())
    got, _ = run_stream(spark, rows, pattern, size=100, delay_s=40, state="slots")
    expected = seqs(match_sequence(spark.createDataFrame(rows, SCHEMA), pattern))
    assert seqs(got) == expected and len(expected) > 3


def test_slots_write_what_a_batch_changes():
    """The state that a batch writes does not follow the rows that wait."""
    import pandas as pd
    from logweave.streaming.slots import SlotMatcher

    class Map(dict):
        written = 0
        def getValue(self, k): return self[k]
        def containsKey(self, k): return k in self
        def removeKey(self, k): del self[k]
        def updateValue(self, k, v):
            Map.written += len(v[0])
            self[k] = v

    class Value:
        value = None
        def exists(self): return self.value is not None
        def get(self): return self.value
        def update(self, v): self.value = v
        def clear(self): self.value = None

    class Handle:
        timers = []
        def getMapState(self, *a): return Map()
        def getValueState(self, *a): return Value()
        def registerTimer(self, t): self.timers.append(t)

    class Timers:
        def __init__(self, wm): self.wm = wm
        def getCurrentWatermarkInMs(self): return self.wm

    m = SlotMatcher([], [False, False], [None, None], 3200)
    m.init(Handle())
    batch = lambda lo, n: pd.DataFrame({"t": range(lo, lo + n), "seq": range(lo, lo + n), "flags": [3] * n, "pay": [str(k) for k in range(lo, lo + n)], "own": [True] * n})
    sizes = []
    for k in range(50):  # nothing is released: the rows that wait grow to 5,000
        before = Map.written
        list(m.handleInputRows((), iter([batch(100 * k, 100)]), Timers(0)))
        sizes.append(Map.written - before)
    assert max(sizes) == min(sizes) == 100 and sum(len(v[0]) for v in m.slots.values()) == 5000
    out = pd.concat(m.handleExpiredTimer((), Timers(4000), None))
    assert len(out) == 4000 and min(k[0] for k in m.slots) >= 8 and m.done.get() == (4000, 4000)
    assert not list(m.handleExpiredTimer((), Timers(4000), None))
    late = pd.concat(m.handleInputRows((), iter([batch(3999, 3)]), Timers(4000)))
    assert late["late"].tolist() == [True, True]


class State:
    """What Spark hands to the state function."""

    def __init__(self, watermark):
        self.value, self.watermark = None, watermark

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, at):
        assert at > self.watermark


@pytest.mark.parametrize("kind", ["pair", "chain"])
def test_rows_behind_what_was_released_leave_as_late_rows_once(kind):
    """Spark's own filter drops most of them before; what the state function drops is an output row of its own kind."""
    import pandas as pd
    if kind == "pair":
        fn = _matcher(["k"], "next", 600_000)
        rows = lambda *r: pd.DataFrame([(t, s, True, True, f"r{s}", own) for s, t, own in r], columns=["t", "seq", "is_first", "is_second", "payload", "own"])
    else:
        fn = _chain_matcher(["k"], [False, False], [None, None], 600_000)
        rows = lambda *r: pd.DataFrame([(t, s, 3, f"r{s}", own) for s, t, own in r], columns=["t", "seq", "flags", "pay", "own"])
    state = State(1000)
    first = pd.concat(fn(("x",), iter([rows((1, 500, True), (2, 900, True), (3, 2000, True))]), state))
    assert len(first) == 1 and not first["late"].any()
    state.watermark = 3000
    # one late row of this bucket, one that only looks in from the next, one of the same instant but behind in order, one in time
    out = pd.concat(fn(("x",), iter([rows((4, 700, True), (5, 700, False), (0, 900, True), (6, 2500, True))]), state))
    assert out["late"].sum() == 2 and (~out["late"].astype(bool)).sum() == 2
