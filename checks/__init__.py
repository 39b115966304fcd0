"""Correctness checks: DuckDB oracle SQL for every registered query, and the compare harness."""
