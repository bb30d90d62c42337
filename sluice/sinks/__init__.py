"""Sinks: Parquet export, JDBC write-back and truncate, catalog tables."""
