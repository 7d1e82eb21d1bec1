"""Query plans: the driver registry, its DuckDB oracles and the batch job builder."""
