"""Scalar helpers, ANSI-safe (bad text gives NULL instead of an error)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column, fmt: str) -> Column:
    """`to_date` that yields NULL for text not in `fmt`."""
    return F.try_to_date(text, fmt)
