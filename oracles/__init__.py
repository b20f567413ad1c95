"""Independent SQL for every deterministic query, written for DuckDB."""
