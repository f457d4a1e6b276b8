"""Sharding by proportional stratified interleaving.

Within each source the rows are shuffled by a seeded hash and ranked; rank r of n gets
the fractional rank (r + 1/2) / n.  Sorting all rows by it interleaves the sources in
proportion, and cutting that order into equal runs gives shards of equal row counts
(at most one apart) in which every source has its share of the whole.  Both ranks are
computed in ranges (`common.ranked`): no source, identifier or table meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import ranked, saved, seeded

MISSING = "\x00null"  # stratum of rows without a source


def interleaved_shards(df: DataFrame, shards: int = 24, seed: int = 20240101, id_col: str = "doc_id",
                       text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard, source.

    Law `rows`: shard counts are at most one apart; slots run from 0 without gaps.
    `size` is the text's UTF-8 bytes (null: none) plus 8.  A null source is a stratum
    of its own; a null text has the checksum of the empty text.  Rows that repeat an
    identifier are ordered by checksum and size; rows equal in all of these can take
    each other's slots, which does not change the result.  With fewer rows than
    shards some shards stay empty; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    body = F.encode(text, "UTF-8")
    thin = saved(df.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
        F.coalesce(F.col(source_col).cast("string"), F.lit(MISSING)).alias("stratum"),
        seeded(seed, id_col).alias("h")), "shard-rows")
    tie = ["h", "doc_id", "text_crc32", "size"]
    order = [F.col(c).asc() for c in tie]
    within = ranked(thin, "stratum", order, "r", "n")
    within = saved(within.withColumn("share", (F.col("r") + F.lit(0.5)) / F.col("n"))
                   .withColumn("all", F.lit(0)), "shard-shares")
    placed = ranked(within, "all", [F.col("share").asc(), F.col("stratum").asc(), *order], "p", "rows")
    # shard s takes the places from ceil(s * rows / shards) on
    shard = F.expr(f"cast(p * {shards}L div rows as long)")
    start = F.expr(f"(shard * rows + {shards - 1}) div {shards}L")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("p") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.when(F.col("stratum") != MISSING, F.col("stratum")).alias("source"))
