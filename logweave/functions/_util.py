from __future__ import annotations

from pyspark.sql import Column, functions as F


def col(c: "str | Column") -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(d: dict) -> Column:
    """A constant ``map<string,string>`` column (folded by the optimizer)."""
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)
