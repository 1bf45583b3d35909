"""Sinks: Parquet tables and, beside them, JSON and CSV side files."""
