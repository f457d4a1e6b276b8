"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text is cut into sections at line ends and each section into paragraphs, pieces that
end at a sentence's end or after 64 characters; the pieces joined are the text again.
A leaf is the SHA-256 of its piece, a section's node that of its leaves, the root that
of the sections' nodes, so equal roots mean equal texts.  Two trees are compared from
the root down: equal branches agree, differing ones lead to the pieces that were edited,
and equal leaves, each with its number among the same ones, tell how alike they are.

The neighbour of a document in descending order of identifiers comes from one range
cut: Spark range-partitions the keys of the rows (no texts), the last key of each range is
a row of a small table, and each document finds its range in it by binary search; the
largest row of each range is also given to the range above it, and a window inside a
range finds the next row.  Texts are shuffled once, each tree is built once.  The key ends
in the head and hash of the text and the row's own number, so that rows which repeat an
identifier are cut into ranges too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.llm.common import partitions, saved
from cardflow.operators.joins import broadcast_if_small

#: A piece: up to 64 characters, with the marks that end a sentence; marks alone; a line end.
PIECE = r"[^.!?\n]{1,64}[.!?]{0,8}|[.!?]{1,8}"


def sections(text: Column) -> Column:
    """Leaves of each section: array<array<string>> of SHA-256 digests."""
    return F.transform(F.split(text, "\n", -1), lambda s: F.transform(
        F.regexp_extract_all(s, F.lit(PIECE), F.lit(0)), lambda p: F.sha2(p.cast("binary"), 256)))


def root(tree: Column) -> Column:
    """The root of the sections' leaves."""
    nodes = F.transform(tree, lambda leaves: F.sha2(F.concat_ws(",", leaves).cast("binary"), 256))
    return F.sha2(F.concat_ws(";", nodes).cast("binary"), 256)


#: Powers of two from large to small, for searches in arrays.
STEPS = [1 << k for k in range(29, -1, -1)]


def steps() -> Column:
    return F.array(*[F.lit(k) for k in STEPS])


def bisected(ordered: Column, x: Column) -> Column:
    """How many entries of a sorted array are less than x, by binary search."""
    return F.reduce(steps(), F.lit(0), lambda n, k: F.when(F.get(ordered, n + k - 1) < x, n + k).otherwise(n))


def numbered(leaves: Column) -> Column:
    """The leaves in their order, each mixed with its number among the equal ones before it:
    in the sorted list equal leaves are a run, and its length up to a leaf is found by steps
    of powers of two."""
    sorted_ = F.array_sort(F.transform(leaves, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def token(run: Column, y: Column, at: Column) -> Column:
        same = lambda n: F.get(run, at - n)["x"] == y["x"]
        long = F.reduce(steps(), F.lit(0), lambda n, k: F.when(same(n + k), n + k).otherwise(n))
        return F.struct(y["i"].alias("i"), F.xxhash64(y["x"], F.when(same(F.lit(1)), long).otherwise(F.lit(0))).alias("x"))

    def of(run: Column) -> Column:
        return F.transform(F.array_sort(F.transform(run, lambda y, at: token(run, y, at))), lambda z: z["x"])

    return F.element_at(F.transform(F.array(sorted_), of), 1)


def summary(text: Column) -> Column:
    """struct<root, nodes, tree, leaves>: the root, the sections' nodes and their leaves (as
    64-bit numbers), and all leaves numbered among equal ones, with the tree computed once."""
    def of(tree: Column) -> Column:
        short = F.transform(tree, lambda leaves: F.transform(leaves, lambda x: F.xxhash64(x)))
        return F.struct(
            root(tree).alias("root"), F.transform(tree, lambda leaves: F.xxhash64(F.concat_ws(",", leaves))).alias("nodes"),
            short.alias("tree"), numbered(F.flatten(short)).alias("leaves"))

    return F.element_at(F.transform(F.array(sections(text)), of), 1)


def likeness(a: Column, b: Column) -> Column:
    """Share of numbered leaves that two summaries have in common, of those that either has,
    times the share of the common leaves that follow one another in both; 1 for equal
    roots and less for others."""
    common = F.struct(F.array_intersect(a["leaves"], b["leaves"]).alias("one"),
                      F.array_intersect(b["leaves"], a["leaves"]).alias("two"))

    def pairs(leaves: Column) -> Column:
        return F.transform(F.slice(leaves, 2, F.greatest(F.size(leaves), F.lit(1))), lambda x, i: F.xxhash64(F.get(leaves, i), x))

    def share(c: Column) -> Column:
        both = F.size(c["one"])
        either = F.size(a["leaves"]) + F.size(b["leaves"]) - both
        order = (F.size(F.array_intersect(pairs(c["one"]), pairs(c["two"]))) + 1) / both
        return F.when(both == 0, F.lit(0.0)).otherwise(F.least(both / either * order, either / (either + 1)))

    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(F.element_at(F.transform(F.array(common), share), 1))


def differences(a: Column, b: Column) -> Column:
    """array<struct<section, piece>>, both from 0: the leaves that differ, from the root down;
    a section that only one tree has counts with all its pieces, with piece 0 if it has none."""
    def up_to(x: Column, y: Column) -> Column:
        return F.sequence(F.lit(0), F.greatest(F.size(x), F.size(y), F.lit(1)) - 1)

    def pieces(i: Column) -> Column:
        x, y = (F.coalesce(F.get(t["tree"], i), F.array().cast("array<bigint>")) for t in (a, b))
        empty = F.greatest(F.size(x), F.size(y)) == 0
        differ = F.filter(up_to(x, y), lambda j: empty | ~F.get(x, j).eqNullSafe(F.get(y, j)))
        return F.transform(differ, lambda j: F.struct(i.alias("section"), j.alias("piece")))

    sections_ = F.filter(up_to(a["nodes"], b["nodes"]), lambda i: ~F.get(a["nodes"], i).eqNullSafe(F.get(b["nodes"], i)))
    return F.when(a["root"] == b["root"], F.array().cast("array<struct<section:int,piece:int>>")).otherwise(
        F.flatten(F.transform(sections_, pieces)))


def first_difference(a: Column, b: Column) -> Column:
    """Number (from 0) of the first section whose nodes differ; null for equal trees."""
    return F.get(differences(a, b), F.lit(0))["section"]


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, s, next, next_s): each row and the next one in descending order of doc_id
    (nulls last; equal identifiers by text head, then hash), each with the summary of its
    text; after the last comes the first.  `df` is read twice and must give the same rows in
    the same partitions, as a table does."""
    p = partitions(df.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # ascending keys, so the next document is the row before
    rows = df.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select("doc_id", "text", F.struct("doc_id", F.substring("text", 1, 32).alias("head"),
                                                  F.xxhash64("text").alias("h"), "row").alias("key"))
    ranges = (rows.select("key").repartitionByRange(p, "key").groupBy(F.spark_partition_id().alias("b"))
              .agg(F.max("key").alias("top")))
    tops = saved(ranges.select("top"), "merkle-tops")
    # one row: the largest keys of the ranges, one a partition, in order; the highest is followed by the lowest
    cuts = tops.agg(F.array_sort(F.collect_list("top")).alias("cuts"))
    rows = rows.join(broadcast_if_small(cuts)).withColumn("b", bisected(F.col("cuts"), F.col("key")))
    last = F.size("cuts") - 1
    rows = rows.withColumn("above", F.when(F.col("key") == F.get("cuts", F.col("b")), F.when(F.col("b") == last, 0).otherwise(F.col("b") + 1)))
    own = F.struct(F.lit(1).alias("own"), F.col("b").alias("b"))
    ghost = F.struct(F.lit(0).alias("own"), F.col("above").alias("b"))
    dealt = rows.select("doc_id", "text", "key", F.explode(F.array_compact(F.array(
        own, F.when(F.col("above").isNotNull(), ghost)))).alias("at")).select("doc_id", "text", "key", "at.own", "at.b")
    dealt = dealt.repartition("b").withColumn("s", summary(F.col("text")))
    order = Window.partitionBy("b").orderBy("own", "key")
    return (dealt.withColumns({"next": F.lag("text").over(order), "next_s": F.lag("s").over(order)}).filter("own = 1")
            .select("doc_id", "text", "s", "next", "next_s"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, edited_section (the first that differs), edits (the leaves
    that differ, as section:piece, joined by commas).

    The edited text has its last floor(n_chars / 3) code points replaced by the first as
    many (or all) of the next document's, in descending order of doc_id, after the last
    the first.  A null text counts as empty, an empty text has the fingerprint of one
    empty section; two empty texts are alike (1), an empty and another are not (0).  A
    single row is its own next.  Rows that repeat an identifier follow one another in
    descending order of their texts' heads and hashes.  Only the two named columns are read;
    an empty table gives an empty result.
    """
    pairs = with_next(df, id_col, text_col)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next"), F.lit(1), cut))
    trees = pairs.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "s", "next_s").select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "s", "next_s",
        summary(F.col("edited")).alias("e"))
    a, b, c = (F.col(x) for x in ("s", "e", "next_s"))
    found = trees.select("doc_id", "n_chars", "edited_sha256", a["root"].alias("fingerprint"),
                         b["root"].alias("edited_fingerprint"), likeness(a, b).alias("near_edited"),
                         likeness(a, c).alias("near_next"), differences(a, b).alias("d"))
    place = F.concat_ws(",", F.transform("d", lambda x: F.concat_ws(":", x["section"], x["piece"])))
    return found.withColumns({"edited_section": F.get("d", F.lit(0))["section"], "edits": place}).drop("d")
