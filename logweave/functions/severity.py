"""Severity code <-> name (PRS6, PRS7) and the accepted-level test (FLT2)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logweave.functions._util import col, literal_map
from logweave.schema import ACCEPTED_LEVELS, SEVERITY_CODES, SEVERITY_NAMES


def severity_name(code: "str | Column", strict: bool = False) -> Column:
    """Level name of a syslog code. Unknown codes give null, or fail the job when ``strict``."""
    name = F.element_at(literal_map(SEVERITY_NAMES), col(code))
    if strict:
        return F.when(name.isNull(), F.raise_error(F.concat(F.lit("unknown syslog code: "), col(code)))) \
            .otherwise(name)
    return name


def severity_code(name: "str | Column") -> Column:
    return F.element_at(literal_map(SEVERITY_CODES), col(name))


def accepted_level(name: "str | Column", levels=ACCEPTED_LEVELS) -> Column:
    return col(name).isin(list(levels))
