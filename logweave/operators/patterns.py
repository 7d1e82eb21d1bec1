"""Sequence patterns over an event-time ordered stream (SEQ1-SEQ11, UDF3).

A pattern is data: two steps with a boolean ``Column`` each, a contiguity and a
time bound. ``match_sequence`` turns it into Spark jobs:

* ``strict`` (SEQ4): the step-2 row is the very next row of the key;
* ``next``   (SEQ5): the earliest later step-2 row of the key (others skipped);
* ``any``    (SEQ5): every later step-2 row of the key within the bound.

``strict`` and ``next`` use the range-partitioned ordered scan in
:mod:`logweave.operators.scan`; ``any`` is a band equi-join on
``(key, time bucket)``. Rows are ordered by ``(event_time, seq)``; ``seq``
breaks ties in arrival order. The bound is strict: ``t2 - t1 < within``.

A ``ChainPattern`` has any number of steps, each ``strict`` or ``next`` after the step before; its bound lies
between the first and the last row. Without comparisons it runs as one automaton scan
(:mod:`logweave.operators.chain`). A step may also compare its row with the first row (SEQ7); then each
step is an ordered search (:mod:`logweave.operators.search`).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from logweave.functions.body import correlation_id
from logweave.operators.chain import chain_matches
from logweave.operators.scan import next_match
from logweave.operators.search import ORDERED, OTHER, SAME, search
from logweave.schema import LOG_FIELDS, SEVERITY_CODES
from logweave.session import staged_table

PAYLOAD_FIELDS = ("seq",) + LOG_FIELDS + ("level", "event_time")


@dataclass(frozen=True)
class Compare:
    """A condition across rows (SEQ7): ``column`` of the step's row stands in ``op`` to ``first`` of the first row.

    ``op``: ``<``, ``<=``, ``>``, ``>=`` (numbers, dates, times), ``=`` or ``<>`` (compared as text). A null fails.
    """
    op: str
    column: Column
    first: Column


@dataclass(frozen=True)
class Step:
    """A named condition; in a ``ChainPattern`` also how the row follows the step before."""
    name: str
    where: Column
    contiguity: str = "next"            # strict | next
    compare: Compare | None = None


@dataclass(frozen=True)
class SequencePattern:
    """Pattern contract (SEQ2): steps, contiguity, bound, and the key it is matched under."""
    first: Step
    second: Step
    contiguity: str = "strict"          # strict | next | any
    within_ms: int = 10 * 60 * 1000
    name: str = "ErrorAlert"
    key: tuple[tuple[str, Column], ...] = field(default_factory=tuple)

    def __post_init__(self):
        if self.contiguity not in ("strict", "next", "any"):
            raise ValueError(f"contiguity must be 'strict', 'next' or 'any', not {self.contiguity!r}")
        if self.within_ms <= 0:
            raise ValueError("the time bound must be positive")


@dataclass(frozen=True)
class ChainPattern:
    """Pattern contract for any number of steps (SEQ2, UDF3)."""
    steps: tuple[Step, ...]
    within_ms: int = 10 * 60 * 1000
    name: str = "ErrorAlert"
    key: tuple[tuple[str, Column], ...] = field(default_factory=tuple)

    def __post_init__(self):
        if not 2 <= len(self.steps) <= 62:
            raise ValueError("a chain has 2 to 62 steps")
        for step in self.steps[1:]:
            if step.contiguity not in ("strict", "next"):
                raise ValueError(f"a step of a chain is 'strict' or 'next', not {step.contiguity!r}")
            if step.compare is not None and step.compare.op not in (*ORDERED, SAME, OTHER):
                raise ValueError(f"no comparison {step.compare.op!r}")
        if self.steps[0].compare is not None:
            raise ValueError("the first step has no row to compare with")
        if self.within_ms <= 0:
            raise ValueError("the time bound must be positive")


MINUTES = 60 * 1000


def consecutive_errors(within_ms: int = 10 * MINUTES) -> SequencePattern:
    """Two consecutive ERROR rows of a service within the bound (SEQ8)."""
    err = F.col("severity") == SEVERITY_CODES["ERROR"]
    return SequencePattern(Step("First Event", err), Step("Second Event", err), "strict", within_ms,
                           key=(("service", F.col("service")),))


def correlated_create_vm(within_ms: int = 10 * MINUTES, contiguity: str = "next") -> SequencePattern:
    """Nova ERROR then Neutron INFO with the same correlation id, within the bound (SEQ9, SEQ10).

    The "same id as the first event" condition (SEQ7) is expressed as the key.
    """
    marker = F.col("body").contains("CEP_ID")
    first = (F.col("severity") == SEVERITY_CODES["ERROR"]) & (F.col("service") == "Nova") & marker
    second = (F.col("severity") == SEVERITY_CODES["INFO"]) & (F.col("service") == "Neutron") & marker
    return SequencePattern(Step("First Event", first), Step("Second Event", second), contiguity, within_ms,
                           key=(("correlation_id", correlation_id("body")),))


def _payload(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in PAYLOAD_FIELDS if c in df.columns])


def consecutive_chain(length: int = 3, within_ms: int = 120 * MINUTES) -> ChainPattern:
    """``length`` ERROR rows of a service in a row."""
    err = F.col("severity") == SEVERITY_CODES["ERROR"]
    return ChainPattern(tuple(Step(f"Event {k + 1}", err, "strict") for k in range(length)), within_ms, key=(("service", F.col("service")),))


def escalation(within_ms: int = 120 * MINUTES) -> ChainPattern:
    """A row of a host, then the earliest one that is more severe (a lower code) than that."""
    code = F.col("severity").cast("int")
    return ChainPattern((Step("First Event", F.lit(True)), Step("Second Event", F.lit(True), compare=Compare("<", code, code))), within_ms,
                        key=(("hostname", F.col("hostname")),))


def spreading_error(within_ms: int = 120 * MINUTES) -> ChainPattern:
    """An ERROR of a service, then its earliest ERROR on another host."""
    err, host = F.col("severity") == SEVERITY_CODES["ERROR"], F.col("hostname")
    return ChainPattern((Step("First Event", err), Step("Second Event", err, compare=Compare("<>", host, host))), within_ms, key=(("service", F.col("service")),))


def _compared(op: str, value: Column, df: DataFrame) -> Column:
    """A value as the search takes it: long or double to be ordered, text to be told apart."""
    if op not in ORDERED:
        return value.cast("string")
    kind = df.select(value.alias("v")).schema["v"].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return value.cast("long")
    if isinstance(kind, (T.FractionalType,)):
        return value.cast("double")
    raise ValueError(f"values of type {kind.simpleString()} are not compared by size")


def chain_rows(entries: DataFrame, pattern: ChainPattern, keep: tuple[str, ...] = ()) -> tuple[DataFrame, list[str], list[bool], T.DataType]:
    """Rows with their key, place, ``flags`` (a bit for each step satisfied), record and compared values
    (``_own<k>``, ``_first<k>``), then the key columns, which steps are strict, and the record's type."""
    steps = pattern.steps
    keys = [f"_key{i}" for i in range(len(pattern.key))]
    compares = {k: s.compare for k, s in enumerate(steps) if s.compare is not None}
    flags = F.lit(0).cast("long")
    for k, s in enumerate(steps):
        flags = flags + F.when(s.where, F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
    base = entries.select("*", *[c.alias(ik) for ik, (_, c) in zip(keys, pattern.key)])
    base = base.select(*keys, *keep, F.unix_millis("event_time").alias("t"), "seq", flags.alias("flags"), _payload(entries).alias("rec"),
                       *[_compared(c.op, c.column, entries).alias(f"_own{k}") for k, c in compares.items()],
                       *[_compared(c.op, c.first, entries).alias(f"_first{k}") for k, c in compares.items()])
    return base, keys, [False, *[s.contiguity == "strict" for s in steps[1:]]], base.schema["rec"].dataType


def match_chain(entries: DataFrame, pattern: ChainPattern, num_partitions: int | None = None) -> DataFrame:
    """``(key..., events array<struct>, alert_name)``: the rows of each match, step by step."""
    steps, names = pattern.steps, [k for k, _ in pattern.key]
    compares = {k: s.compare for k, s in enumerate(steps) if s.compare is not None}
    base, keys, strict, rec_type = chain_rows(entries, pattern)
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    if not any(strict):
        base = base.where("flags <> 0")
    base = base.withColumn("payload", F.when(F.col("flags") != 0, F.to_json("rec"))).drop("rec")
    if not compares:
        found = chain_matches(base, keys, strict, pattern.within_ms, num_partitions)
        out = found.select(*keys, F.col("pays").alias("pays"))
    else:
        base = staged_table(base, "candidates")  # read by every step
        kind = T.StructType([T.StructField("pays", T.ArrayType(T.StringType())), T.StructField("v", T.StructType([base.schema[f"_first{k}"] for k in compares]))])
        carry = F.to_json(F.struct(F.array("payload").alias("pays"), F.struct(*[F.col(f"_first{k}") for k in compares]).alias("v")))
        found = base.where(F.col("flags").bitwiseAND(1) != 0).select(*keys, "t", "seq", F.col("t").alias("t1"), carry.alias("carry"))
        for k in range(1, len(steps)):
            held, own = F.from_json("carry", kind), compares.get(k)
            none = F.lit(None).cast("long")
            marks = found.withColumn("v", held[f"v"][f"_first{k}"] if own else none)
            rows = base.select(*keys, "t", "seq", (F.col("flags").bitwiseAND(1 << k) != 0).alias("ok"), (F.col(f"_own{k}") if own else none).alias("v"), "payload")
            hits = search(marks, rows, keys, strict[k], own.op if own else None, pattern.within_ms, num_partitions)
            found = hits.select(*keys, F.col("t2").alias("t"), F.col("seq2").alias("seq"), "t1",
                                F.to_json(F.struct(F.concat(held["pays"], F.array("p2")).alias("pays"), held["v"].alias("v"))).alias("carry"))
        out = found.select(*keys, F.from_json("carry", kind)["pays"].alias("pays"))
    return out.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.transform("pays", lambda p: F.from_json(p, rec_type)).alias("events"),
                      F.lit(pattern.name).alias("alert_name"))


def match_sequence(entries: DataFrame, pattern: SequencePattern | ChainPattern, num_partitions: int | None = None,
                   partition_by: list[str] | None = None) -> DataFrame:
    """Alerts as ``(key..., first struct, second struct, alert_name)`` (SEQ1, SEQ11); of a chain as
    ``(key..., events array<struct>, alert_name)``.

    ``entries`` are accepted rows with ``seq`` and ``event_time``. The key is
    the pattern's, or ``partition_by`` (column names) when given; an empty key
    means one global order, still spread over many tasks by the scan.
    """
    if partition_by is not None:
        pattern = replace(pattern, key=tuple((c, F.col(c)) for c in partition_by))
    if isinstance(pattern, ChainPattern):
        return match_chain(entries, pattern, num_partitions)
    names = [k for k, _ in pattern.key]
    # keys are evaluated into internal columns, so the steps and the records see the rows as
    # they are even when a key expression reuses a column's name; they are renamed at the end
    keys = [f"_key{i}" for i in range(len(names))]
    base = entries.select("*", *[c.alias(ik) for ik, (_, c) in zip(keys, pattern.key)])
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    base = base.select(
        *keys, F.unix_millis("event_time").alias("t"), "seq",
        F.coalesce(pattern.first.where, F.lit(False)).alias("is_first"),
        F.coalesce(pattern.second.where, F.lit(False)).alias("is_second"),
        _payload(entries).alias("rec"))
    w = pattern.within_ms

    if pattern.contiguity == "any":
        # Band join on (key, time bucket): a match lies in the first row's bucket or the next.
        # The candidate rows are rebalanced once (one materialised stage holding the parsed
        # rows), then a Generate gives each row its roles: a first row goes to its own and
        # the next bucket, a second row to its own. Both join sides filter on the generated
        # role, which cannot move below the Generate, so they share the one stage and the
        # input is parsed once.
        bucket = F.floor(F.col("t") / F.lit(w)).cast("long")
        roles = F.concat(
            F.when(F.col("is_first"), F.array(F.struct(F.lit("F").alias("role"), bucket.alias("b")),
                                              F.struct(F.lit("F").alias("role"), (bucket + 1).alias("b"))))
             .otherwise(F.array().cast("array<struct<role:string,b:bigint>>")),
            F.when(F.col("is_second"), F.array(F.struct(F.lit("S").alias("role"), bucket.alias("b"))))
             .otherwise(F.array().cast("array<struct<role:string,b:bigint>>")))
        staged = base.where(F.col("is_first") | F.col("is_second")).hint("rebalance", "seq") \
            .select(*keys, "t", "seq", "rec", F.inline(roles))
        f = staged.where(F.col("role") == "F").select(*keys, F.col("t").alias("t1"), F.col("seq").alias("seq1"),
                                                      F.col("rec").alias("first"), "b")
        s = staged.where(F.col("role") == "S").select(*[F.col(k).alias(f"_{k}") for k in keys],
                                                      F.col("t").alias("t2"), F.col("seq").alias("seq2"),
                                                      F.col("rec").alias("second"), F.col("b").alias("b2"))
        cond = [f["b"] == s["b2"]] + [f[k] == s[f"_{k}"] for k in keys]
        cond += [(s["t2"] > f["t1"]) | ((s["t2"] == f["t1"]) & (s["seq2"] > f["seq1"])),
                 s["t2"] - f["t1"] < w]
        out = f.join(s, cond, "inner").select(*[f[k].alias(n) for k, n in zip(keys, names)], "first", "second")
    else:
        cand = base if pattern.contiguity == "strict" else base.where(F.col("is_first") | F.col("is_second"))
        # the records travel with the scan as JSON text (only for rows that can be in a match),
        # so no join back on seq is needed
        rec_type = base.schema["rec"].dataType
        cand = cand.withColumn("payload", F.when(F.col("is_first") | F.col("is_second"), F.to_json("rec")))
        pairs = next_match(cand, keys, pattern.contiguity, w, num_partitions)
        out = pairs.select(*[F.col(k).alias(n) for k, n in zip(keys, names)],
                           F.from_json("p1", rec_type).alias("first"), F.from_json("p2", rec_type).alias("second"))
    return out.withColumn("alert_name", F.lit(pattern.name))
