"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup side above this many bytes of column data is not hinted.
DEFAULT_BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """`broadcast(df)` when its own rows (after any `distinct` in it, so repeats
    do not count) hold at most `max_bytes` of text, else `df` unchanged: the
    optimizer then chooses, and AQE splits a hot join partition.  The check
    sums the bytes where the rows are and returns one number."""
    row = sum((F.coalesce(F.octet_length(F.to_json(F.struct(F.col(c)))), F.lit(0)) + 8 for c in df.columns), F.lit(0))
    size = df.agg(F.sum(row)).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
