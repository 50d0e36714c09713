"""Proxy inputs, the registered queries and their DuckDB oracles."""
