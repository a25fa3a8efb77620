"""Readers and writers: raw CSV tables, stand-in tables, parquet, JSON and CSV artifacts."""
