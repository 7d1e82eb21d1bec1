"""Pattern state in time slots, so that a micro-batch writes what it changes (STR10).

The state of a key and time bucket (see :mod:`logweave.streaming.matcher`) is a map from slots, a small part of the
time bound long, to the rows of that time. New rows change their slots and no others, however many rows
wait for the watermark. A timer at the earliest waiting row releases what the watermark has passed: the slots of the
last bound before it are read, matches whose last row is new are emitted, and slots that can no longer
be part of a match are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SLOTS_A_BOUND = 32
_ROWS = T.StructType([T.StructField("t", T.ArrayType(T.LongType())), T.StructField("seq", T.ArrayType(T.LongType())),
                      T.StructField("flags", T.ArrayType(T.LongType())), T.StructField("pay", T.ArrayType(T.StringType()))])
_KINDS = {"t": np.int64, "seq": np.int64, "flags": np.int64, "pay": object}


class SlotMatcher(StatefulProcessor):
    def __init__(self, keys: list[str], strict: list[bool], ops: list[str | None], within_ms: int):
        self.keys, self.strict, self.ops, self.within = keys, strict, ops, within_ms
        self.length = max(1, within_ms // SLOTS_A_BOUND)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", T.StructType([T.StructField("slot", T.LongType())]), _ROWS)
        #: the last released (t, seq): anything at or before it is late for this key
        self.done = handle.getValueState("done", T.StructType([T.StructField("t", T.LongType()), T.StructField("seq", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done = tuple(self.done.get()) if self.done.exists() else None
        new = {c: [] for c in _KINDS}
        for pdf in rows:
            fresh = np.ones(len(pdf), bool)
            if done is not None:
                t, seq = pdf["t"].to_numpy(), pdf["seq"].to_numpy()
                fresh = (t > done[0]) | ((t == done[0]) & (seq > done[1]))
                n = int((~fresh & pdf["own"].to_numpy(dtype=bool)).sum())
                if n:
                    yield pd.DataFrame({**{k: [v] * n for k, v in zip(self.keys, key)}, "pays": [None] * n, "late": True})
            for c in new:
                new[c].append(pdf[c].to_numpy(dtype=_KINDS[c])[fresh])
        got = {c: np.concatenate(x) if x else np.zeros(0, _KINDS[c]) for c, x in new.items()}
        if not len(got["t"]):
            return
        slot = got["t"] // self.length
        for s in np.unique(slot).tolist():
            held = self.slots.getValue((s,)) if self.slots.containsKey((s,)) else ([], [], [], [])
            self.slots.updateValue((s,), tuple(list(h) + got[c][slot == s].tolist() for c, h in zip(_KINDS, held)))
        self.handle.registerTimer(max(int(got["t"].min()), timerValues.getCurrentWatermarkInMs()) + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        from logweave.operators.chain import matches_in_order

        wm = timerValues.getCurrentWatermarkInMs()
        done = tuple(self.done.get()) if self.done.exists() else None
        slots = sorted(k[0] for k in self.slots.keys())
        since = done[0] - self.within if done else slots[0] * self.length if slots else 0
        near = [s for s in slots if s * self.length <= wm and (s + 1) * self.length > since]
        parts = [self.slots.getValue((s,)) for s in near]
        rows = {c: np.concatenate([np.asarray(p[k], _KINDS[c]) for p in parts]) if parts else np.zeros(0, _KINDS[c]) for k, c in enumerate(_KINDS)}
        waiting = rows["t"][rows["t"] > wm]
        order = np.lexsort((rows["seq"], rows["t"]))
        order = order[rows["t"][order] <= wm]
        t, seq, flags, pay = (rows[c][order] for c in _KINDS)
        if len(t) and (done is None or (int(t[-1]), int(seq[-1])) > done):
            taken = matches_in_order(t, flags, pay, self.strict, self.ops, self.within)
            if done is not None and len(taken):
                last = taken[:, -1]
                taken = taken[(t[last] > done[0]) | ((t[last] == done[0]) & (seq[last] > done[1]))]
            if len(taken):
                yield pd.DataFrame({**{k: [v] * len(taken) for k, v in zip(self.keys, key)}, "pays": [list(x) for x in pay[taken]], "late": False})
            self.done.update((int(t[-1]), int(seq[-1])))
            done = int(t[-1]), int(seq[-1])
        for s in slots:
            if (s + 1) * self.length <= wm - self.within:
                self.slots.removeKey((s,))
        left = [s for s in slots if (s + 1) * self.length > wm - self.within]
        later = [s * self.length for s in left if s * self.length > wm]
        wake = min([*waiting.tolist(), *later], default=None)
        if wake is None and (left or done is not None and wm - done[0] <= self.within):
            # nothing waits; what is held goes a bound later
            wake = max([(s + 1) * self.length for s in left] + [done[0] if done else 0]) + self.within
        if wake is not None:
            self.handle.registerTimer(max(int(wake), wm) + 1)
        elif done is not None:
            self.done.clear()

    def close(self) -> None:
        pass
