"""Exact dedup by content sort.

Rows are range-partitioned by their content: Spark samples the keys, picks splitters
and every partition is sorted (an external sort that spills), which places equal texts
next to each other; a window over the full text compares neighbours byte by byte and
keeps one identifier of each run.

* The splitter key is (first 32 bytes, 64-bit digest, salt): the sample that the driver
  gets stays small however long the texts are.  The comparison is over whole texts.
* A text with more rows than a fourth of an average partition is cut by a salt (of the
  identifier and the row's own number, so that repeated rows part as well) into parts of
  about that size (at most 4 texts per partition can be so frequent; their list is
  broadcast behind a check of its bytes).  Part leaders, one per part, carry the whole text and are
  grouped by it to join the parts again; nothing else of the group moves twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardflow.llm.common import partitions, saved
from cardflow.operators.joins import broadcast_if_small


def frequent(keyed: DataFrame) -> DataFrame:
    """(h, parts) of the content hashes `h` with more rows than a fourth of an average
    partition: at most 4 rows per partition."""
    often = keyed.count() // (4 * partitions(keyed.sparkSession)) + 1
    hot = (keyed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > often)
           .select("h", F.ceil(F.col("n") / F.lit(often)).alias("parts")))
    return saved(hot, "dedup-hot")


def first_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of the rows with equal texts the one that `exact_dedup` keeps, whole: the smallest
    identifier (null after all others); of rows that share it too the one whose other
    columns, as JSON, come first.  Texts are shuffled once, and of frequent texts, which
    meet where they are read, only one copy a task.  Columns may have any name and type.
    """
    p = partitions(df.sparkSession)
    others = [F.col(f"`{c}`") for c in df.columns if c not in (id_col, text_col)]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                 (F.to_json(F.struct(*others)) if others else F.lit("")).alias("rest")).alias("rank"))
    body = F.encode(F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")), "UTF-8")
    keyed = rows.withColumn("h", F.xxhash64(body))
    hot = frequent(keyed)
    none_hot = hot.isEmpty()
    cold = keyed if none_hot else keyed.join(broadcast_if_small(hot), "h", "left_anti")
    ranged = cold.withColumn("head", F.substring(body, 1, 32)).repartitionByRange(p, "head", "h").withColumn("body", body)
    run = Window.partitionBy("head", "h", "body").orderBy("rank")
    first = ranged.withColumn("rn", F.row_number().over(run)).filter("rn = 1").select("row.*")
    if none_hot:
        return first
    copies = keyed.join(broadcast_if_small(hot), "h", "left_semi").withColumn("body", body)
    return first.unionByName(copies.groupBy("body").agg(F.min_by("row", "rank").alias("row")).select("row.*"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    `keep` is "min" or "max": which identifier of a group of equal texts stays.
    A null text counts as empty, so null and empty texts are one group.  Identifiers
    may repeat: of rows with equal text and equal identifier exactly one is kept.  A
    null identifier sorts after all others and is kept only where the group has no
    other.  Other columns of `df` are not read, so their names cannot clash.  An empty
    table gives an empty result.
    """
    if keep not in ("min", "max"):
        raise ValueError(f"keep must be 'min' or 'max', not {keep!r}")
    spark = df.sparkSession
    p = partitions(spark)
    body = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = df.select(F.col(id_col).alias("doc_id"), body.alias("body"), F.monotonically_increasing_id().alias("row"))
    keyed = rows.withColumn("h", F.xxhash64("body"))

    salted = (keyed.join(broadcast_if_small(frequent(keyed)), "h", "left")
              .withColumn("salt", F.when(F.col("parts").isNull(), F.lit(0))
                          .otherwise(F.pmod(F.xxhash64("doc_id", "row"), F.col("parts"))).cast("int"))
              .withColumn("head", F.substring("body", 1, 32)))
    ranged = salted.repartitionByRange(p, "head", "h", "salt")
    first = F.col("doc_id").asc_nulls_last() if keep == "min" else F.col("doc_id").desc_nulls_last()
    run = Window.partitionBy("head", "h", "salt", "body")
    parts = ranged.select(
        "doc_id", F.col("parts").isNotNull().alias("hot"),
        F.sha2("body", 256).alias("text_sha256"),
        F.row_number().over(run.orderBy(first)).alias("rn"),
        F.first("doc_id").over(run.orderBy(first).rowsBetween(Window.unboundedPreceding,
                                                              Window.unboundedFollowing)).alias("part_keep"),
        F.count(F.lit(1)).over(run.orderBy(first).rowsBetween(Window.unboundedPreceding,
                                                              Window.unboundedFollowing)).alias("part_size"),
        "body", "salt")
    parts = saved(parts.select("doc_id", "hot", "text_sha256", "rn", "part_keep", "part_size", "salt",
                               F.when(F.col("hot") & (F.col("rn") == 1), F.col("body")).alias("leader")),
                  "dedup-parts")
    whole = parts.filter(~F.col("hot")).select(
        "doc_id", F.col("part_keep").alias("keep_id"), F.col("part_size").alias("group_size"),
        (F.col("rn") == 1).alias("kept"), "text_sha256")

    # the part that holds the identifier that stays (a null one only if there is no other)
    known = F.col("part_keep").isNotNull()
    best = (F.min_by("salt", F.struct(~known, "part_keep", "salt")) if keep == "min"
            else F.max_by("salt", F.struct(known, F.col("part_keep"), F.col("salt"))))
    groups = (parts.filter(F.col("leader").isNotNull())
              .groupBy("leader").agg((F.min if keep == "min" else F.max)("part_keep").alias("keep_id"),
                                     F.sum("part_size").alias("group_size"),
                                     F.first("text_sha256").alias("text_sha256"), best.alias("best_salt"))
              .drop("leader"))
    # one row per frequent text
    split = parts.filter("hot").join(broadcast_if_small(groups), "text_sha256").select(
        "doc_id", "keep_id", "group_size",
        ((F.col("rn") == 1) & (F.col("salt") == F.col("best_salt"))).alias("kept"), "text_sha256")
    return whole.unionByName(split).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", "text_sha256")
