"""Reads: Parquet scans and typed records from landed JSON."""
