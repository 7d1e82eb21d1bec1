"""Table-spec files: ``name:col;col;...`` per line (SRC6), or all-``;`` (SRC7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def parse_table_specs(lines: DataFrame, value_col: str = "value", all_semicolons: bool = False) -> DataFrame:
    v = F.trim(F.col(value_col))
    if all_semicolons:
        parts = F.split(v, ";")
        name = F.element_at(parts, 1)
        cols = F.slice(parts, 2, F.size(parts) - 2)
    else:
        name = F.split_part(v, F.lit(":"), F.lit(1))
        cols = F.split(F.split_part(v, F.lit(":"), F.lit(2)), ";")
    cols = F.filter(F.transform(cols, lambda c: F.trim(c)), lambda c: c != "")
    out = lines.where(v != "").select(F.trim(name).alias("table_name"), cols.alias("columns"))
    return out.withColumn("arity", F.size("columns"))


def read_table_specs(spark: SparkSession, path: str, all_semicolons: bool = False) -> DataFrame:
    return parse_table_specs(spark.read.text(path), all_semicolons=all_semicolons)


def spec_schema(columns: list[str], types: dict | None = None) -> T.StructType:
    """``StructType`` for a spec; columns default to string."""
    types = types or {}
    return T.StructType([T.StructField(c, types.get(c, T.StringType()), True) for c in columns])
