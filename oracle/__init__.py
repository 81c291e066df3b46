"""DuckDB side of the correctness gate: SQL text per registered query, and a runner."""
