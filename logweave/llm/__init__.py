"""Training-data operators: sharding of text corpora into clean, deduplicated, packed sequences.

Nothing outside this folder imports it. ``queries.QUERIES`` / ``queries.SQL`` hold the driver
queries ``opN_<name>`` and their DuckDB equivalents.
"""
