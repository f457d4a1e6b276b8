"""Deterministic, skew-safe "one row per key".

`dropDuplicates(keys)` keeps an arbitrary row; a window `row_number()` over the
key is deterministic but sends every row of a key to one task, which breaks
when one key holds a large share of the data.  Here:

1. `distinct` removes copies (partial aggregation collapses them map-side);
2. keys with more than a fourth of an average partition's rows are hot.  They
   are found from the distinct rows' counts per key and there are at most 4 of
   them per shuffle partition, so their list is broadcast;
3. a window over (key, salt) numbers the rows: a hot key is cut into as many
   salts as its rows ask for, any other key has one;
4. of a hot key's salts the one that holds its first row is the `min` of an
   ordering struct, again with partial aggregation and only over hot rows.

So the rows are shuffled twice, as by `distinct` and a plain window, and all
steps share one scan of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Hot keys (one short row each) that are broadcast, by their bound.
MAX_HOT = 1 << 17

def _resolved(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The frame's own spelling of column names given in any case."""
    own = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in own]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {', '.join(df.columns)}")
    return [own[n.lower()] for n in names]


def flag_first_per_key(df: DataFrame, key: Sequence[str], flag: str = "is_first",
                       order: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of `df` plus a boolean `flag`: TRUE for the first row of
    each `key` in ascending order over `order` (default: all columns in
    schema order), NULLs last; FALSE for the others.  A NULL key is a key.
    Names resolve in any case."""
    key, cols = _resolved(df, list(key)), list(df.columns)
    ordering = _resolved(df, list(order or cols))
    parts = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.distinct()

    per_key = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(F.count(F.lit(1)).alias("_n"))
    total = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    hot = (per_key.filter(F.col("_n") * F.lit(parts) > total)
           .withColumn("_salts", F.ceil(F.col("_n") * F.lit(parts) / total)).drop("_n"))

    def same_key(left: DataFrame, right: DataFrame):
        cond = F.lit(True)
        for i, k in enumerate(key):
            cond = cond & left[k].eqNullSafe(right[f"_k{i}"])
        return cond

    # at most `parts` keys are hot; beyond MAX_HOT of them the planner chooses from measured sizes
    few = F.broadcast if parts <= MAX_HOT else (lambda df: df)
    names = [f"_k{i}" for i in range(len(key))]
    salted = (rows.join(few(hot), same_key(rows, hot), "left").drop(*names)
              .withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0))
                          .otherwise(F.pmod(F.xxhash64(*cols), F.col("_salts")))))

    first = F.struct(*[e for i, c in enumerate(ordering) for e in
                       ([F.col(c).isNull().alias(f"z{i}")] if df.schema[c].nullable else []) + [F.col(c).alias(f"o{i}")]])
    best = (salted.filter(F.col("_salts").isNotNull())
            .groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)])
            .agg(F.min_by("_salt", first).alias("_best")))
    window = Window.partitionBy(*key, "_salt").orderBy(*[F.col(c).asc_nulls_last() for c in ordering])
    numbered = salted.withColumn("_rn", F.row_number().over(window))
    joined = numbered.join(few(best), same_key(numbered, best), "left")
    return joined.select(*cols, ((F.col("_rn") == 1) & (F.col("_salts").isNull() | (F.col("_salt") == F.col("_best"))))
                         .alias(flag))


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key (the first in the total order of `flag_first_per_key`)."""
    return flag_first_per_key(df, key, "_first", order).filter("_first").drop("_first")
