"""Scans: stored tables and raw files."""
