"""Independent checks: the DuckDB oracle SQL for every registered query."""
