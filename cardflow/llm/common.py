"""Parts that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardflow.session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` into the shared folder and read it back: a step boundary that
    survives lost executors and that later branches read instead of recomputing."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of `docs` whose identifier (null included) is in `kept`."""
    ids = kept.select(F.col("doc_id").alias("_only"))
    return docs.join(ids, docs[id_col].eqNullSafe(ids["_only"]), "left_semi")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def seeded(seed: int, *cols: Column | str) -> Column:
    """A seeded 60-bit hash (the start of an MD5), plain enough to restate in SQL."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 15), 16, 10).cast("long")


def unit(h: Column) -> Column:
    """A 60-bit hash as a number from 0 to 1 that rises with it."""
    return h.cast("double") / F.lit(float(1 << 60))


def ranked(df: DataFrame, group: str, order: list[Column], out: str, total: str) -> DataFrame:
    """Adds `out`, the 0-based rank of each row inside its `group` by `order`, and `total`, the
    group's rows, without bringing a group into one task.  `df` is a written table and
    `group` has no nulls; rows equal in `order` are ranked by their place in the table.

    Spark range-partitions the rows by (group, order, place), so neither a large group nor
    many rows with one key meet in one range.  A running sum over the ranges of a group gives
    the first rank of each, and `row_number` ranks inside a range.
    """
    full = [*order, F.col("_rk_row")]
    rows = df.withColumn("_rk_row", F.monotonically_increasing_id())
    dealt = saved(rows.repartitionByRange(partitions(df.sparkSession), F.col(group), *full)
                  .withColumn("_rk_part", F.spark_partition_id()), "rank-ranges")
    own = Window.partitionBy(group)
    before = own.orderBy("_rk_part").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy(group, "_rk_part").agg(F.count(F.lit(1)).alias("_rk_n")).select(
        group, "_rk_part", F.coalesce(F.sum("_rk_n").over(before), F.lit(0)).alias("_rk_first"), F.sum("_rk_n").over(own).alias(total))
    inside = F.row_number().over(Window.partitionBy(group, "_rk_part").orderBy(*full)) - 1
    return (dealt.withColumn("_rk_in", inside).join(saved(first, "rank-first"), [group, "_rk_part"])
            .withColumn(out, (F.col("_rk_first") + F.col("_rk_in")).cast("long"))
            .drop("_rk_row", "_rk_part", "_rk_first", "_rk_in"))
