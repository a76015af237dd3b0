"""Binds the reports to the generated test tables: domain views, queries and their DuckDB oracles."""
