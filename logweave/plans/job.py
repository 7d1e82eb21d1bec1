"""The whole job as batch plans: parse once, four tables, quarantine, one alert stream.

``run_batch`` parses the input exactly once: the parsed rows (accepted and
rejected) are written as one Parquet table partitioned by ``status``. Every
output is then derived from column-pruned reads of that table, so the JSON
parse is not repeated per output, and the written table cuts the lineage (a
lost executor recomputes from it, not from the raw input). Row counters
(UDF2) are ``observe`` metrics computed inside the write jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from logweave.operators.parse import parse_entries, validate
from logweave.operators.patterns import SequencePattern, correlated_create_vm, match_sequence
from logweave.operators.views import Placement, node_rows, raw_rows, service_rows, stack_rows
from logweave.sinks.writers import TABLE_PARTITIONS, alerts_to_text, write_table


@dataclass
class Outputs:
    accepted: DataFrame
    quarantine: DataFrame
    tables: dict[str, DataFrame]
    alerts: DataFrame
    observations: dict[str, Observation]


def split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validated rows -> (accepted, quarantine)."""
    accepted = parsed.where(F.col("reject_reason").isNull()).drop("raw_value", "json_error", "reject_reason")
    quarantine = parsed.where(F.col("reject_reason").isNotNull()).select("seq", "raw_value", "reject_reason")
    return accepted, quarantine


def derive(accepted: DataFrame, quarantine: DataFrame, as_of, place: Placement = Placement(),
           pattern: SequencePattern | None = None, observe: bool = True) -> Outputs:
    tables = {
        "node_rows": node_rows(accepted, as_of, place),
        "service_rows": service_rows(accepted, as_of, place),
        "stack_rows": stack_rows(accepted, as_of, place),
        "raw_rows": raw_rows(accepted, place),
    }
    observations = {}
    if observe:
        for name in list(tables):
            obs = Observation(name)
            tables[name] = tables[name].observe(obs, F.count(F.lit(1)).alias("rows"))
            observations[name] = obs
    alerts = match_sequence(accepted, pattern or correlated_create_vm())
    return Outputs(accepted, quarantine, tables, alerts, observations)


def build(lines: DataFrame, as_of, parse_body: bool = True, place: Placement = Placement(),
          pattern: SequencePattern | None = None, observe: bool = True) -> Outputs:
    """All outputs as lazy plans over ``lines`` (each action parses the lines it needs)."""
    accepted, quarantine = split(validate(parse_entries(lines, parse_body)))
    return derive(accepted, quarantine, as_of, place, pattern, observe)


def run_batch(lines: DataFrame, out_path: str, as_of, parse_body: bool = True,
              place: Placement = Placement(), pattern: SequencePattern | None = None,
              mode: str = "overwrite") -> dict[str, int]:
    """Parse once into ``out_path/parsed``, then write the tables, quarantine and alert text from it.

    ``mode="overwrite"`` (default) makes a rerun after a failure replace its own output
    rather than add to it; ``"append"`` adds a run to existing tables.
    """
    spark = lines.sparkSession
    parsed = validate(parse_entries(lines, parse_body)).withColumn(
        "status", F.when(F.col("reject_reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected")))
    # the line as read is stored for rejects only
    parsed = parsed.withColumn("raw_value", F.when(F.col("status") == "rejected", F.col("raw_value"))).drop("json_error")
    obs = Observation("parsed")
    parsed = parsed.observe(obs, F.count(F.lit(1)).alias("lines"),
                            F.count(F.when(F.col("status") == "accepted", 1)).alias("accepted"))
    write_table(parsed, f"{out_path}/parsed", ["status"], mode="overwrite")
    stored = spark.read.parquet(f"{out_path}/parsed")
    # the quarantine is the "rejected" partition of the parsed table
    accepted, _ = split(stored.where(F.col("status") == "accepted").drop("status"))
    _, quarantine = split(stored.where(F.col("status") == "rejected").drop("status"))
    o = derive(accepted, quarantine, as_of, place, pattern)
    for name, df in o.tables.items():
        write_table(df, f"{out_path}/{name}", TABLE_PARTITIONS[name], mode=mode)
    alerts_to_text(o.alerts).write.mode(mode).text(f"{out_path}/alerts")
    counters = {name: int(ob.get.get("rows", 0)) for name, ob in o.observations.items()}
    counters.update({k: int(v) for k, v in obs.get.items()})
    return counters
