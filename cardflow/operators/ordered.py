"""Order-dependent operators that stay balanced when one group is huge.

`lag(v) OVER (PARTITION BY p ORDER BY o)` as a window sends a whole group to
one task.  `lag_by_range` gives the same result without that limit:

1. the rows are written once, which tells their number, and range-partitioned
   on the full sort key (p ascending, then o) into ranges of bounded size: the
   sampled boundaries cut a hot group into several ranges, each its own task;
2. a window over (range id, p) computes the lag inside each range; its result
   is written once, so everything after it reads the same ranges;
3. only the first row of a range can miss its predecessor, which is the last
   row of the previous non-empty range when that row is in the same group.
   A table with one row per range fills those in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.operators.joins import broadcast_if_small
from cardflow.session import materialize

#: Rows that a range aims at, and the fewest for which another range pays: every range
#: writes to every partition of the window's shuffle.
ROWS_PER_RANGE = 1_000_000
LEAST_ROWS_PER_RANGE = 50_000


def range_count(rows: int, partitions: int) -> int:
    """Ranges for `rows` rows: one per shuffle partition, but fewer of few rows and more of many."""
    return max(1, min(partitions, -(-rows // LEAST_ROWS_PER_RANGE)), -(-rows // ROWS_PER_RANGE))


def lag_by_range(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], value: str, out: str,
                 num_partitions: int | None = None) -> DataFrame:
    """`df` plus `out` = lag(`value`, 1) over (partition by `partition_by`
    order by `order_by`), where `order_by` are sort expressions such as
    `F.col("m").desc()`.  The order must be total within a group for the
    result to be deterministic."""
    part, order = list(partition_by), list(order_by)
    rows = materialize(df, "lag-rows")
    n = num_partitions or range_count(rows.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    group = F.struct(*part)
    w = Window.partitionBy("_pid", *part).orderBy(*order)
    local = (rows.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in part], *order)
             .withColumn("_pid", F.spark_partition_id())
             .withColumns({out: F.lag(value).over(w), "_rn": F.row_number().over(w),
                           "_tail": F.lead(F.lit(True)).over(w).isNull()}))
    local = materialize(local, "lag-ranges")

    # Per range: its first group (groups ascend, NULLs first, as struct order
    # does) and the last row of its last group.
    ends = local.filter((F.col("_rn") == 1) | F.col("_tail"))
    bounds = ends.groupBy("_pid").agg(
        F.min(group).alias("_first"),
        F.max_by(F.struct(group.alias("p"), F.col(value).alias("v")),
                 F.when(F.col("_tail"), F.struct(F.lit(1).alias("t"), group.alias("p")))).alias("_last"))
    # One row per non-empty range: a single ordered pass over at most n rows.
    prev = F.lag("_last").over(Window.orderBy("_pid"))
    fix = (bounds.withColumn("_prev", prev)
           .filter(F.col("_prev").isNotNull() & F.col("_prev.p").eqNullSafe(F.col("_first")))
           .select("_pid", "_first", F.col("_prev.v").alias("_fix"), F.lit(True).alias("_has_fix")))
    # At most one row per range of ROWS_PER_RANGE rows; broadcast behind a check of its bytes.
    joined = local.join(broadcast_if_small(materialize(fix, "lag-fix")), on="_pid", how="left")
    head = (F.col("_rn") == 1) & F.coalesce(F.col("_has_fix"), F.lit(False)) & group.eqNullSafe(F.col("_first"))
    return joined.select(*df.columns, F.when(head, F.col("_fix")).otherwise(F.col(out)).alias(out))
