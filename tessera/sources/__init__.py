"""Scans: the parquet test tables, text/JSON/CSV readers and derived views."""
