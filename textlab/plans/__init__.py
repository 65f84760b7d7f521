"""Registered queries: each pairs a Spark builder with DuckDB oracle SQL."""
