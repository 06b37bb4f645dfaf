"""Composed pipelines, the registered queries and their DuckDB oracles."""
