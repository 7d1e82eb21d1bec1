"""Sequence patterns in Structured Streaming (STR2, STR3, STR10).

* ``strict`` / ``next``: keyed state with ``applyInPandasWithState`` and an
  event-time timeout. The state's key is the pattern key and a time bucket of
  ``BUCKET_BOUNDS`` bounds. Each row goes to its own bucket; one within a bound of
  its bucket's start also goes to the bucket before, where it may end a match but
  not start one, so no pair across an edge is lost or found twice. A backlog of
  one hot key is so spread over as many tasks as it has buckets, and a bucket's state
  goes once the watermark is past it. The edges are shifted by a hash of the key, lest all
  keys change bucket at one instant. Rows of a group are held until the watermark passes them,
  then released in ``(t, seq)`` order and matched exactly as the batch scan
  does: state holds the rows newer than the watermark, plus (strict) the last
  released row or (next) the open first rows younger than the bound.
* ``any``: a stream-stream inner join on the key with an event-time range,
  so Spark can drop join state once the watermark passes the bound.

* A pattern without a key has the time bucket alone as its state's key: a backlog spreads over its buckets,
  and what crosses an edge is handed over as above.
* chains (``ChainPattern``): the same buckets; state holds the rows of the last bound before the watermark and those
  newer than it. A release matches both together and emits the matches whose last row is new. Comparisons
  with the first row are searched as in batch.

Rows older than the watermark are dropped before the state function (Spark's
``numRowsDroppedByWatermark`` metric counts them, a row sent to two buckets twice), and the state function drops
a row at or before the last position its key has released, so every key is
matched strictly in order. What it drops is counted, each row once, in the observed metric ``late_rows``. The key / candidate filters reference the event-time
column, which keeps them above ``withWatermark``: every accepted row advances
the watermark. Append sinks upstream of the matcher still receive every row.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from logweave.operators.patterns import PAYLOAD_FIELDS, ChainPattern, SequencePattern, chain_rows
from logweave.operators.scan import match_block
from logweave.streaming.slots import SlotMatcher

_STATE = T.StructType([
    T.StructField("p_t", T.ArrayType(T.LongType())),
    T.StructField("p_seq", T.ArrayType(T.LongType())),
    T.StructField("p_f", T.ArrayType(T.BooleanType())),
    T.StructField("p_s", T.ArrayType(T.BooleanType())),
    T.StructField("p_pay", T.ArrayType(T.StringType())),
    # rows carried to the next release: strict, the last row if it may start a match; next, open first rows
    T.StructField("o_t", T.ArrayType(T.LongType())),
    T.StructField("o_seq", T.ArrayType(T.LongType())),
    T.StructField("o_f", T.ArrayType(T.BooleanType())),
    T.StructField("o_s", T.ArrayType(T.BooleanType())),
    T.StructField("o_pay", T.ArrayType(T.StringType())),
    # the last released (t, seq): anything at or before it arrived too late for this key
    T.StructField("done_t", T.LongType()),
    T.StructField("done_seq", T.LongType()),
])
_LATE = T.StructField("late", T.BooleanType())

# length of a time bucket of the keyed state, in time bounds of the pattern: one row in so many goes to two buckets
BUCKET_BOUNDS = 8

_COLS = ("t", "seq", "f", "s", "pay")


def _arrays(values) -> dict:
    t, seq, f, s_, pay = values
    return {"t": np.asarray(t if t is not None else [], dtype=np.int64),
            "seq": np.asarray(seq if seq is not None else [], dtype=np.int64),
            "f": np.asarray(f if f is not None else [], dtype=bool),
            "s": np.asarray(s_ if s_ is not None else [], dtype=bool),
            "pay": np.asarray(pay if pay is not None else [], dtype=object)}


def _take(a: dict, idx) -> dict:
    return {c: a[c][idx] for c in _COLS}


def _cat(*parts: dict) -> dict:
    return {c: np.concatenate([p[c] for p in parts]) for c in _COLS}


def _late(keys: list[str], key: tuple, rows: dict, which: np.ndarray):
    """Rows that came too late, as output rows of their own kind."""
    n = int(which.sum())
    if n:
        out = {k: [v] * n for k, v in zip(keys, key)}
        none = pd.array([None] * n, dtype="Int64")
        yield pd.DataFrame({**out, "seq1": rows["seq"][which], "t1": rows["t"][which], "p1": rows["pay"][which],
                            "seq2": none, "t2": none, "p2": [None] * n, "late": True})


def _matcher(keys: list[str], mode: str, within_ms: int):
    """State function: hold rows until the watermark passes them, then match them in order
    with the same vectorised core as the batch scan (``match_block``)."""

    def fn(key, batches, state):
        if state.exists:
            st = state.get
            pend, carry = _arrays(st[0:5]), _arrays(st[5:10])
            done = (st[10], st[11]) if st[10] is not None else None
        else:
            pend = carry = _arrays([None] * 5)
            done = None
        for pdf in batches:
            new = _arrays((pdf["t"], pdf["seq"], pdf["is_first"], pdf["is_second"], pdf["payload"]))
            if done is not None:
                # at or before the last released row: late for this key
                fresh = (new["t"] > done[0]) | ((new["t"] == done[0]) & (new["seq"] > done[1]))
                yield from _late(keys, key, new, ~fresh & pdf["own"].to_numpy(dtype=bool))
                new = _take(new, fresh)
            pend = _cat(pend, new)
        wm = state.getCurrentWatermarkMs()
        pend = _take(pend, np.lexsort((pend["seq"], pend["t"])))
        ready = pend["t"] <= wm
        released, pend = _take(pend, ready), _take(pend, ~ready)
        out = None
        if len(released["t"]):
            block = _cat(carry, released)
            i, j, keep = match_block(block["t"], block["f"], block["s"], np.zeros(len(block["t"]), dtype=np.int64),
                                     mode, within_ms)
            if len(i):
                out = {k: [v] * len(i) for k, v in zip(keys, key)}
                out.update(seq1=block["seq"][i], t1=block["t"][i], p1=block["pay"][i],
                           seq2=block["seq"][j], t2=block["t"][j], p2=block["pay"][j], late=False)
            carry = _take(block, keep)
            done = (int(block["t"][-1]), int(block["seq"][-1]))
        # carried rows a bound behind the watermark can no longer match anything
        carry = _take(carry, wm - carry["t"] < within_ms)
        if mode == "strict":
            carry = _take(carry, carry["f"])
        if len(pend["t"]):
            wake = int(pend["t"].min())
        elif len(carry["t"]):
            wake = int(carry["t"].min()) + within_ms
        elif done is not None and wm - done[0] <= within_ms:
            # keep the "done" mark a little longer: Spark's own late filter lags one micro-batch
            wake = done[0] + within_ms + 1
        else:
            wake = None
        if wake is None:
            if state.exists:
                state.remove()
        else:
            d_t, d_seq = done if done is not None else (None, None)
            state.update(tuple(pend[c].tolist() for c in _COLS) + tuple(carry[c].tolist() for c in _COLS)
                         + (d_t, d_seq))
            state.setTimeoutTimestamp(max(int(wake), wm + 1))
        if out is not None:
            yield pd.DataFrame(out)

    return fn


def _prepare(entries: DataFrame, pattern: SequencePattern) -> tuple[DataFrame, list[str], T.DataType]:
    # keys go to internal columns (renamed on output), so steps and records see the rows as they are
    keys = [f"_key{i}" for i in range(len(pattern.key))]
    base = entries.select("*", *[c.alias(ik) for ik, (_, c) in zip(keys, pattern.key)])
    rec = F.struct(*[F.col(c) for c in PAYLOAD_FIELDS if c in entries.columns])
    base = base.select(*keys, "event_time", F.unix_millis("event_time").alias("t"), "seq",
                       F.coalesce(pattern.first.where, F.lit(False)).alias("is_first"),
                       F.coalesce(pattern.second.where, F.lit(False)).alias("is_second"),
                       rec.alias("rec"))
    return base, keys, base.schema["rec"].dataType


def _keep_after_watermark(cond) -> "F.Column":
    """``cond`` as one predicate on the event-time column.

    The optimizer pushes filters that do not reference the event-time column
    below ``withWatermark``; the watermark would then advance only on the rows
    that survive them. Wrapping the condition around ``event_time`` keeps the
    filter above, so every accepted row moves the watermark, as in the source.
    """
    return F.when(cond, F.col("event_time")).isNotNull()


def _watermarked(base: DataFrame, delay_s: int, future_cap_s: int | None) -> DataFrame:
    if future_cap_s is not None:
        cap = F.current_timestamp() + F.make_interval(secs=F.lit(int(future_cap_s)))
        base = base.observe("future_rows", F.count(F.when(F.col("event_time") > cap, 1)).alias("dropped"))
        base = base.where(F.col("event_time") <= cap)
    return base.withWatermark("event_time", f"{int(delay_s)} seconds")


def _bucketed(slim: DataFrame, keys: list[str], within_ms: int, counts_before) -> DataFrame:
    """Rows with the ``bucket`` they go to, their ``own`` or the one before, whose matches they may end."""
    length = F.lit(BUCKET_BOUNDS * within_ms).cast("long")
    shifted = F.col("t") + (F.pmod(F.xxhash64(*keys), length) if keys else F.lit(0).cast("long"))
    offset = F.pmod(shifted, length)
    own = F.call_function("div", shifted - offset, length)
    before = F.when((offset < F.lit(within_ms)) & counts_before, F.struct((own - 1).alias("bucket"), F.lit(False).alias("own")))
    places = F.filter(F.array(F.struct(own.alias("bucket"), F.lit(True).alias("own")), before), lambda x: x.isNotNull())
    return slim.select("*", F.inline(places))


_CHAIN_STATE = T.StructType([T.StructField("t", T.ArrayType(T.LongType())), T.StructField("seq", T.ArrayType(T.LongType())),
                             T.StructField("flags", T.ArrayType(T.LongType())), T.StructField("pay", T.ArrayType(T.StringType())),
                             T.StructField("done_t", T.LongType()), T.StructField("done_seq", T.LongType())])


def _chain_matcher(keys: list[str], strict: list[bool], ops: list[str | None], within_ms: int):
    """State function of a chain. ``pay`` is the row's record and compared values; state: the rows of the last bound and newer ones."""
    from logweave.operators.chain import matches_in_order

    def fn(key, batches, state):
        rows, done = {"t": np.zeros(0, np.int64), "seq": np.zeros(0, np.int64), "flags": np.zeros(0, np.int64), "pay": np.zeros(0, object)}, None
        if state.exists:
            held = state.get
            rows = {c: np.asarray(v if v is not None else [], dtype=rows[c].dtype) for c, v in zip(rows, held[:4])}
            done = (held[4], held[5]) if held[4] is not None else None
        for pdf in batches:
            new = {c: pdf[c].to_numpy(dtype=rows[c].dtype) for c in rows}
            if done is not None:
                fresh = (new["t"] > done[0]) | ((new["t"] == done[0]) & (new["seq"] > done[1]))
                n = int((~fresh & pdf["own"].to_numpy(dtype=bool)).sum())
                if n:
                    yield pd.DataFrame({**{k: [v] * n for k, v in zip(keys, key)}, "pays": [None] * n, "late": True})
                new = {c: x[fresh] for c, x in new.items()}
            rows = {c: np.concatenate([rows[c], new[c]]) for c in rows}
        wm = state.getCurrentWatermarkMs()
        order = np.lexsort((rows["seq"], rows["t"]))
        rows = {c: x[order] for c, x in rows.items()}
        ready = rows["t"] <= wm
        if ready.any():
            t, seq, flags, pay = (rows[c][ready] for c in ("t", "seq", "flags", "pay"))
            taken = matches_in_order(t, flags, pay, strict, ops, within_ms)
            if done is not None and len(taken):
                last = taken[:, -1]
                taken = taken[(t[last] > done[0]) | ((t[last] == done[0]) & (seq[last] > done[1]))]
            if len(taken):
                yield pd.DataFrame({**{k: [v] * len(taken) for k, v in zip(keys, key)}, "pays": [list(x) for x in pay[taken]], "late": False})
            if done is None or (int(t[-1]), int(seq[-1])) > done:
                done = int(t[-1]), int(seq[-1])
        # a match that a later row ends begins less than a bound before it
        rows = {c: x[rows["t"] > wm - within_ms] for c, x in rows.items()}
        pending = rows["t"][rows["t"] > wm]
        wake = int(pending.min()) if len(pending) else int(rows["t"].max()) + within_ms if len(rows["t"]) else None
        if wake is None:
            if state.exists:
                state.remove()
        else:
            state.update((rows["t"].tolist(), rows["seq"].tolist(), rows["flags"].tolist(), rows["pay"].tolist(), *(done or (None, None))))
            state.setTimeoutTimestamp(max(wake, wm + 1))
    return fn


def match_chain_stream(entries: DataFrame, pattern: ChainPattern, delay_s: int = 0, future_cap_s: int | None = None,
                       state: str = "value") -> DataFrame:
    """Streaming matches ``(key..., events, alert_name)`` of a chain; see :func:`match_sequence_stream`."""
    base, keys, strict, rec_type = chain_rows(entries, pattern, keep=("event_time",))
    ops = [s.compare.op if s.compare else None for s in pattern.steps]
    base = _watermarked(base, delay_s, future_cap_s)
    wanted = F.lit(True)
    for k in keys:
        wanted = wanted & F.col(k).isNotNull()
    if not any(strict):
        wanted = wanted & (F.col("flags") != 0)
    base = base.where(_keep_after_watermark(wanted))
    values = [c for c in base.columns if c.startswith(("_own", "_first"))]
    slim = base.select(*keys, "event_time", "t", "seq", "flags", F.to_json(F.struct(F.when(F.col("flags") != 0, F.to_json("rec")).alias("rec"), *values)).alias("pay"))
    slim = _bucketed(slim, keys, pattern.within_ms, F.lit(True))
    # a row of the next bucket starts nothing here
    slim = slim.withColumn("flags", F.when(F.col("own"), F.col("flags")).otherwise(F.col("flags").bitwiseAND(~1)))
    out = T.StructType([slim.schema[k] for k in keys] + [T.StructField("pays", T.ArrayType(T.StringType())), _LATE])
    groups = slim.groupBy(*keys, "bucket")
    if state == "slots":
        # null keys were removed; Python's processor takes the columns it names
        found = groups.transformWithStateInPandas(SlotMatcher(keys, strict, ops, pattern.within_ms), out, "Append", "EventTime")
    else:
        found = groups.applyInPandasWithState(_chain_matcher(keys, strict, ops, pattern.within_ms), out, _CHAIN_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    found = found.observe("late_rows", F.count(F.when(F.col("late"), 1)).alias("dropped")).where(~F.col("late"))
    names = [k for k, _ in pattern.key]
    return found.select(*[F.col(k).alias(n) for k, n in zip(keys, names)],
                        F.transform("pays", lambda p: F.from_json(F.get_json_object(p, "$.rec"), rec_type)).alias("events"), F.lit(pattern.name).alias("alert_name"))


def match_sequence_stream(entries: DataFrame, pattern: SequencePattern | ChainPattern, delay_s: int = 0,
                          future_cap_s: int | None = None, state: str = "value") -> DataFrame:
    """Streaming alerts ``(key..., first, second, alert_name)`` (a chain: ``events``) with a bounded out-of-orderness watermark.

    ``future_cap_s``: drop rows dated more than this many seconds after the
    micro-batch's processing time before they reach the watermark, so one
    future-dated row cannot make every later row "late". Their number is the observed metric
    ``future_rows``. Spark keeps one processing time for a micro-batch and its replays.

    ``state``: ``"value"`` holds a key's rows as one value, which each change writes whole; ``"slots"`` holds them by
    time slots (:mod:`logweave.streaming.slots`), so a batch writes its own rows' slots only, for streams whose
    rows wait long for the watermark.
    """
    if state not in ("value", "slots"):
        raise ValueError(f"state must be 'value' or 'slots', not {state!r}")
    if isinstance(pattern, ChainPattern):
        return match_chain_stream(entries, pattern, delay_s, future_cap_s, state)
    if state == "slots" and pattern.contiguity != "any":
        steps = (pattern.first, replace(pattern.second, contiguity=pattern.contiguity))
        chain = match_chain_stream(entries, ChainPattern(steps, pattern.within_ms, pattern.name, pattern.key), delay_s, future_cap_s, state)
        return chain.select(*[k for k, _ in pattern.key], F.col("events")[0].alias("first"), F.col("events")[1].alias("second"), "alert_name")
    base, keys, rec_type = _prepare(entries, pattern)
    names = [k for k, _ in pattern.key]
    base = _watermarked(base, delay_s, future_cap_s)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    if pattern.contiguity == "strict":
        base = base.where(_keep_after_watermark(has_key))
    else:
        base = base.where(_keep_after_watermark(has_key & (F.col("is_first") | F.col("is_second"))))
    w = pattern.within_ms
    if pattern.contiguity == "any":
        f = base.where(_keep_after_watermark(F.col("is_first"))).select(*[F.col(k).alias(f"f_{k}") for k in keys],
                                          F.col("event_time").alias("t1_time"), F.col("t").alias("t1"),
                                          F.col("seq").alias("seq1"), F.col("rec").alias("first"))
        s = base.where(_keep_after_watermark(F.col("is_second"))).select(*[F.col(k).alias(f"s_{k}") for k in keys],
                                           F.col("event_time").alias("t2_time"), F.col("t").alias("t2"),
                                           F.col("seq").alias("seq2"), F.col("rec").alias("second"))
        cond = [F.col(f"f_{k}") == F.col(f"s_{k}") for k in keys] + [
            F.col("t2_time") >= F.col("t1_time"),
            F.col("t2_time") < F.col("t1_time") + F.expr(f"INTERVAL {w} MILLISECONDS"),
            (F.col("t2") > F.col("t1")) | ((F.col("t2") == F.col("t1")) & (F.col("seq2") > F.col("seq1"))),
        ]
        cond_all = F.lit(True)
        for c in cond:
            cond_all = cond_all & c
        out = f.join(s, cond_all, "inner").select(*[F.col(f"f_{k}").alias(n) for k, n in zip(keys, names)],
                                                  "first", "second")
        return out.withColumn("alert_name", F.lit(pattern.name))
    if pattern.contiguity not in ("strict", "next"):
        raise ValueError(f"unknown contiguity {pattern.contiguity!r}")
    slim = base.select(*keys, "event_time", "t", "seq", "is_first", "is_second",
                       F.when(F.col("is_first") | F.col("is_second"), F.to_json("rec")).alias("payload"))
    # strict: any row near the start may break a run of the bucket before; next: only second rows count
    slim = _bucketed(slim, keys, w, F.lit(True) if pattern.contiguity == "strict" else F.col("is_second"))
    slim = slim.withColumn("is_first", F.col("is_first") & F.col("own"))
    slim = slim.withColumn("payload", F.when(F.col("is_first") | F.col("is_second"), F.col("payload")))
    key_fields = [slim.schema[k] for k in keys]
    out_schema = T.StructType(key_fields + [
        T.StructField("seq1", T.LongType()), T.StructField("t1", T.LongType()), T.StructField("p1", T.StringType()),
        T.StructField("seq2", T.LongType()), T.StructField("t2", T.LongType()), T.StructField("p2", T.StringType()), _LATE,
    ])
    pairs = slim.groupBy(*keys, "bucket").applyInPandasWithState(_matcher(keys, pattern.contiguity, w), out_schema, _STATE, "append",
                                           GroupStateTimeout.EventTimeTimeout)
    pairs = pairs.observe("late_rows", F.count(F.when(F.col("late"), 1)).alias("dropped")).where(~F.col("late"))
    return pairs.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.from_json("p1", rec_type).alias("first"),
                        F.from_json("p2", rec_type).alias("second"), F.lit(pattern.name).alias("alert_name"))
