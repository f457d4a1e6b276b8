"""Generic DataFrame operators: dedup, rule engine, joins, set operations."""
