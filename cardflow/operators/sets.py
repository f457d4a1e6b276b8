"""Set operations of the reference, as plain DataFrame calls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT: distinct rows of `a` not in `b` (NULL-safe).

    When `b` is a filter of `a` (the reference's use), Catalyst rewrites this
    into one filter plus a distinct with map-side combine -- no join.  Else it
    is a NULL-safe left anti join, whose skewed partitions AQE can split."""
    return a.subtract(b)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of several frames, matched by column name."""
    return reduce(lambda x, y: x.unionByName(y), frames)
