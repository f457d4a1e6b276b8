"""Inputs: the driver's Parquet tables, the domain fixtures derived from them,
and the CSV scans of the raw files."""
