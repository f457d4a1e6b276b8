"""The corpus pipeline: five stages over `documents`, each written and read by the next.

The decisions of a stage take effect in its result.  All stages but the last return the
columns of `documents`; the last returns the place of each document in a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.llm import exact_dedup, near_dedup, packing, pii, quality
from cardflow.llm.common import documents, only, saved


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.  It learns from the labels of
    the documents it is given."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.select(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, one with the smallest doc_id (null after all others);
    of rows that share this doc_id and text the one whose other columns, as JSON, come first."""
    return exact_dedup.first_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more, and
    what such links reach) one row stays, the one with the smallest doc_id (null after all
    others; of rows that share it the one with the smallest digest of its text).

    Rows are told apart by a number of their own, as identifiers may repeat or be null."""
    row, own = "_row", list(docs.columns)
    while row in own:
        row += "_"
    rows = saved(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    groups = near_dedup.near_groups(rows, percent=80, id_col=row).select(F.col("doc_id").alias("_at"), "component_id")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", F.sha2(F.col("text").cast("string").cast("binary"), 256).alias("sha"),
                     F.col(row).alias("_at"))
    kept = (rows.select(first.alias("_first")).join(groups, F.col("_first._at") == F.col("_at"))
            .groupBy("component_id").agg(F.min("_first").alias("_first")).select(F.col("_first._at").alias("doc_id")))
    return only(rows, kept, id_col=row).select(*own)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows."""
    return pii.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document in batches of padded rows within the token budget."""
    return packing.pack(docs)


STAGES = [("quality", keep_good), ("exact dedup", drop_exact_copies), ("near dedup", drop_near_copies),
          ("personal data", mask_personal_data), ("packing", pack)]
#: Trained models and bucket edges are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
