"""Connected components of a link table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import saved


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none itself."""
    n = edges.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("d")).first()
    if n["n"] != n["d"]:
        return False
    return edges.join(edges.select(F.col("v").alias("u")), "u", "left_semi").limit(1).count() == 0


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest
    node that links reach.

    Alternates two steps until the links are stars: every node's larger neighbours are
    linked to its smallest one, then every node's smaller ones.  The number of rounds grows
    with the logarithm of the nodes, also on long chains, and each round's links are
    written to the shared folder.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .filter("u > v").distinct(), "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that a node with very many links is a skewed join that Spark can split
        least = saved(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "links-least")
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u > v").distinct())
        joined = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        edges = saved(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))).filter("u > v").distinct(), "links")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return saved(stars.unionByName(stars.select(F.col("component").alias("node"), "component")).distinct(), "components")
