"""Packing by optimal length buckets.

Rows of a batch are padded to the upper edge of their length bucket.  Spark counts the
lengths of the whole table; on that histogram dynamic programming finds the bucket
edges with the least padding; inside each bucket rows are shuffled and cut into batches
that hold as many padded rows as the token budget allows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import ranked, saved, seeded

#: Lengths up to FINE are counted one by one; beyond, cells are 1/FINE of the length's
#: power of two wide.  So a histogram has at most FINE cells per doubling of the length
#: (under 150,000 for texts of any size that a column can hold).
FINE = 4096


def word_count(text: Column) -> Column:
    """Words (runs without white space \\x20, \\x09-\\x0D) of a text; null: none."""
    t = F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x09-\x0D\x20]+", " "))
    return F.when(t == "", F.lit(0)).otherwise(F.length(t) - F.length(F.translate(t, " ", "")) + 1).cast("long")


def cell(length: Column) -> Column:
    """Upper edge of the histogram cell of a length (the length itself up to FINE)."""
    wide = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double")))
                                        - F.lit(int(np.log2(FINE)))))
    return F.when(length <= FINE, length).otherwise((F.ceil(length / wide) * wide).cast("long")).cast("long")


def best_edges(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper edges of at most `buckets` buckets over the sorted `lengths` (with `counts`
    rows each) that minimise the sum of edge - length over all rows.

    With C the running count, a last bucket (i, j] costs length_j * (C_j - C_i) up to a
    constant, so the best i for j is the lowest of the lines dp_i - length_j * C_i at
    length_j: the envelope of lines gives each layer in linear time.
    """
    m, run = len(lengths), np.concatenate([[0], np.cumsum(counts)]).astype(object)
    if m == 0:
        return []
    best = [None] * (m + 1)
    best[0] = 0
    back: list[list[int]] = []
    for _ in range(min(buckets, m)):
        hull: list[tuple[int, int, int]] = []  # slope C_i (rising), intercept dp_i, i
        nxt, frm, at = [None] * (m + 1), [-1] * (m + 1), 0
        nxt[0] = 0
        for j in range(1, m + 1):
            i = j - 1
            if best[i] is not None:
                s, c = run[i], best[i]
                # drop lines that the new one and their predecessor cover
                while len(hull) >= 2 and ((c - hull[-2][1]) * (hull[-1][0] - hull[-2][0])
                                          <= (hull[-1][1] - hull[-2][1]) * (s - hull[-2][0])):
                    hull.pop()
                hull.append((s, c, i))
                at = min(at, len(hull) - 1)
            if not hull:
                continue
            x = int(lengths[j - 1])
            while at + 1 < len(hull) and hull[at + 1][1] - x * hull[at + 1][0] <= hull[at][1] - x * hull[at][0]:
                at += 1
            nxt[j], frm[j] = hull[at][1] - x * hull[at][0] + x * run[j], hull[at][2]
        back.append(frm)
        best = nxt
    edges, j = [], m
    for frm in reversed(back):
        if j == 0:
            break
        edges.append(int(lengths[j - 1]))
        j = frm[j]
    return edges[::-1]


def pack(df: DataFrame, buckets: int = 12, budget: int = 32768, seed: int = 7, id_col: str = "doc_id",
         text_col: str = "text", length: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, n_tokens, bucket, bucket_len, batch, slot, padding.

    `length` is the token count of a row (default: words of the text; null: 0).  A
    batch has floor(budget / bucket_len) rows at most, and at least one: a row longer
    than the budget is a batch of its own and is not cut.  Empty texts have length 0
    and take part.  Rows that repeat an identifier are packed each; an empty table
    gives an empty result.
    """
    n = F.coalesce((word_count(F.col(text_col)) if length is None else length).cast("long"), F.lit(0))
    thin = saved(df.select(F.col(id_col).alias("doc_id"), n.alias("n_tokens"))
                 .withColumn("h", seeded(seed, "doc_id", "n_tokens")), "pack-rows")
    # one row per histogram cell, whatever the number of documents
    hist = sorted((r["c"], r["k"]) for r in
                  thin.groupBy(cell(F.col("n_tokens")).alias("c")).agg(F.count(F.lit(1)).alias("k")).collect())
    edges = best_edges(np.array([c for c, _ in hist], dtype=np.int64), np.array([k for _, k in hist], dtype=np.int64),
                       buckets)
    edge_list = F.array(*[F.lit(e).cast("long") for e in edges]) if edges else F.array().cast("array<bigint>")
    bucket = F.size(F.filter(edge_list, lambda e: e < F.col("n_tokens")))
    cut = thin.withColumn("bucket", bucket.cast("int"))
    order = [F.col("h").asc(), F.col("doc_id").asc(), F.col("n_tokens").asc()]
    placed = ranked(cut, "bucket", order, "r", "rows")
    placed = placed.withColumn("bucket_len", F.element_at(edge_list, F.col("bucket") + 1))
    room = F.greatest(F.lit(1), F.expr(f"{int(budget)}L div greatest(bucket_len, 1L)"))
    return placed.withColumn("room", room).select(
        "doc_id", "n_tokens", "bucket", "bucket_len", F.expr("cast(r div room as long)").alias("batch"),
        F.expr("cast(r % room as int)").alias("slot"), (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
