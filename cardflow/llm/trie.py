"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

Nodes.  Every conversation is a sequence of turns; each distinct sequence of first d turns
is a node.  A turn's term is a hash of its place, role and text; the exclusive or of the
first d terms (twice 64 bits) names the node, so that parts of one long conversation can be
summed apart and joined: two different sequences get one name with odds of 2 ** -128.

Places.  Turns are dealt out by ranges of (conversation, turn, role, text, row); a running
count over the few ranges of a conversation gives each its first place, so a conversation
with a third of all turns is numbered and summed by many tasks.

Totals.  Rounds of joins contract the trie to its root.  Rake: every leaf hands its total
to its parent and goes.  Compress: of the nodes that have one child left, those that throw
heads while their parent is not such a node go, and their child takes their place and keeps
what it has to add on the way up.  So long chains halve like wide nodes do, and the rounds
grow with the logarithm of the nodes.  Raked nodes go with their final totals; compressed
ones get theirs when the rounds are run backwards, from the child that took their place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.llm.common import partitions, saved, seeded

CHUNK = 4096  # member ids in one piece of a node's list of ends
EMPTY = hashlib.sha256(b"").hexdigest()
KEY = ("k1", "k2")


def placed(turns: DataFrame) -> DataFrame:
    """Adds `part`, a range of the rows in the order of (conv, turn, role, text, row), and
    `place`, the 1-based number of the turn in its conversation."""
    p = partitions(turns.sparkSession)
    rows = saved(turns.withColumn("row", F.monotonically_increasing_id()), "trie-turns")
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    dealt = saved(rows.repartitionByRange(p, *order).withColumn("part", F.spark_partition_id()), "trie-ranges")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
             .select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    inside = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order[1:]))
    return (dealt.withColumn("in_part", inside).join(first, ["conv", "part"])
            .select("conv", "part", (F.col("first") + F.col("in_part")).alias("place"), "role", "text"))


def conversation_turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The rows with a conversation, as conv, turn, role, text, null role and text as empty."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    return df.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                     text(role_col).alias("role"), text(text_col).alias("text")).filter("conv IS NOT NULL")


def rebuilt(turns: DataFrame, heads: int = 6, block: int = 100) -> tuple[DataFrame, DataFrame]:
    """(rows of conv, part, place, role, text; conv with its number of turns n) of the
    conversations as rebuilt: the first h turns of conversation c - c % block, then c's own
    after its first h, with h = crc32(c as text) % heads."""
    own = saved(placed(turns), "trie-placed")
    sizes = own.groupBy("conv").agg(F.count(F.lit(1)).alias("own_n"))
    convs = sizes.select("conv", "own_n", F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(heads)).alias("h"),
                         (F.col("conv") - F.col("conv") % block).alias("base"))
    base = sizes.select(F.col("conv").alias("base"), F.col("own_n").alias("base_n"))
    convs = convs.join(base, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = saved(convs.withColumn("n", F.col("lent") + F.greatest(F.lit(0), F.col("own_n") - F.col("h"))), "trie-convs")
    tails = (own.join(convs.select("conv", "h", "lent"), "conv").filter("place > h")
             .select("conv", "part", (F.col("place") - F.col("h") + F.col("lent")).alias("place"), "role", "text"))
    # at most heads - 1 turns of a base, for at most `block` conversations
    lent = (own.filter(F.col("place") < heads).withColumnRenamed("conv", "base")
            .select("base", "place", "role", "text").join(convs.select("conv", "base", "lent"), "base")
            .filter("place <= lent").select("conv", F.lit(-1).alias("part"), "place", "role", "text"))
    return lent.unionByName(tails), convs.select("conv", "n")


def member_rows(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and depth: conv, depth, the names of its node and of the
    node's parent, role and text of the last turn, and whether the conversation ends."""
    terms = saved(turns.join(convs, "conv").select(
        "conv", "part", F.col("place").alias("depth"), "text", (F.col("place") == F.col("n")).alias("ends"),
        *[F.xxhash64(F.lit(seed), "place", "role", F.octet_length("role"), "text").alias(t)
          for seed, t in ((1, "t1"), (2, "t2"))]), "trie-terms")
    up_to = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (terms.groupBy("conv", "part").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
              .select("conv", "part", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(x) for x in ("x1", "x2")]))
    keyed = (terms.withColumns({f"r{i}": F.bit_xor(f"t{i}").over(up_to) for i in (1, 2)}).join(starts, ["conv", "part"])
             .withColumns({f"k{i}": F.col(f"r{i}").bitwiseXOR(F.col(f"x{i}")) for i in (1, 2)})
             .withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"t{i}")) for i in (1, 2)}))
    own = keyed.select("conv", "depth", "k1", "k2", "p1", "p2", "text", "ends")
    none = F.lit(None).cast("long")
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"),
                        F.lit(0).cast("long").alias("k2"), none.alias("p1"), none.alias("p2"),
                        F.lit("").alias("text"), (F.col("n") == 0).alias("ends"))
    return own.withColumn("depth", F.col("depth").cast("long")).unionByName(root)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the conversations that end in a node, ascending and joined by
    commas.  Ranges of (node, conversation) are joined to pieces of at most CHUNK ids by many
    tasks; the pieces of a node then pass through one digest, as SHA-256 has to read them in
    order, batch by batch."""
    p = partitions(ends.sparkSession)
    dealt = saved(ends.repartitionByRange(p, *KEY, "conv").withColumn("part", F.spark_partition_id()), "trie-ends")
    at = F.row_number().over(Window.partitionBy(*KEY, "part").orderBy("conv")) - 1
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = (dealt.withColumn("piece", F.floor(at / CHUNK)).groupBy(*KEY, "part", "piece")
              .agg(F.min("conv").alias("first"), ids.alias("ids")))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, run = None, None
        for batch in batches:
            out: list[tuple] = []
            for k1, k2, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) != now:
                    if run is not None:
                        out.append((*now, run.hexdigest()))
                    now, run = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    run.update(b"," + ids.encode())
            yield _digest_batch(out)
        if run is not None:
            yield _digest_batch([(*now, run.hexdigest())])

    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "ids")
    return ordered.mapInArrow(digests, "k1 long, k2 long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                       pa.array(cols[2], pa.string())], names=["k1", "k2", "ends_sha256"])


def subtree_totals(nodes: DataFrame, seed: int = 1) -> DataFrame:
    """(id, one total per weight) for a tree of (id, parent, one own number per weight), the
    root's parent null, by rake and compress in join rounds.  The number of rounds grows
    with the logarithm of the nodes on wide trees and on long chains alike; an empty tree
    gives an empty result."""
    names = [c for c in nodes.columns if c not in ("id", "parent")]
    extra = [f"{w}_extra" for w in names]  # what a node's chain adds on the way up
    kids = (nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id"))
            .agg(F.count(F.lit(1)).alias("kids")))
    alive = saved(nodes.join(kids, "id", "left").select(
        "id", "parent", *names, *[F.lit(0).cast("long").alias(e) for e in extra], F.coalesce("kids", F.lit(0)).alias("kids")), "tree-alive")
    total = alive.filter("kids = 0").select("id", *names)  # final totals so far
    compressed: list[DataFrame] = []
    while True:
        # rake: leaves hand over what they hold and what their chain holds
        given = (alive.filter("kids = 0 AND parent IS NOT NULL").groupBy(F.col("parent").alias("id"))
                 .agg(F.count(F.lit(1)).alias("gone"), *[F.sum(F.col(w) + F.col(e)).alias(f"{w}_given") for w, e in zip(names, extra)]))
        kept = saved(alive.filter("kids > 0").join(given, "id", "left").select(
            "id", "parent", *[(F.col(w) + F.coalesce(f"{w}_given", F.lit(0))).alias(w) for w in names], *extra,
            (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids")), "tree-raked")
        if kept.isEmpty():
            break
        # compress: heads whose parent is no head; both sides have one row per id
        heads = kept.filter((F.col("kids") == 1) & F.col("parent").isNotNull()
                            & (seeded(seed + len(compressed), "id") % 2 == 1))
        chosen = heads.join(heads.select(F.col("id").alias("parent")), "parent", "left_anti")
        chosen = saved(chosen.select(F.col("id").alias("gone_id"), F.col("parent").alias("above"),
                                     *[F.col(w).alias(f"{w}_held") for w in names],
                                     *[F.col(e).alias(f"{e}_held") for e in extra]), "tree-chosen")
        rest = kept.join(chosen.select(F.col("gone_id").alias("id")), "id", "left_anti")
        # a chosen node has one child left, so this join keeps the number of rows; the child
        # takes its place, so the node above has as many children as before
        lifted = saved(rest.join(chosen, rest["parent"] == chosen["gone_id"], "left"), "tree-lifted")
        compressed.append(lifted.filter("gone_id IS NOT NULL").select(
            F.col("gone_id").alias("id"), F.col("id").alias("child"),
            *[(F.col(e) + F.col(f"{w}_held")).alias(f"{w}_plus") for w, e in zip(names, extra)]))
        alive = lifted.select("id", F.coalesce("above", "parent").alias("parent"), *names,
                              *[(F.col(e) + F.coalesce(F.col(f"{w}_held") + F.col(f"{e}_held"), F.lit(0))).alias(e)
                                for w, e in zip(names, extra)], "kids")
        total = total.unionByName(alive.filter("kids = 0").select("id", *names))
    for links in reversed(compressed):
        below = total.withColumnRenamed("id", "child")
        again = links.join(below, "child").select("id", *[(F.col(w) + F.col(f"{w}_plus")).alias(w) for w in names])
        total = total.unionByName(saved(again, "tree-expanded"))
    return total


def prefix_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", heads: int = 6, block: int = 100) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (see `rebuilt`): conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    Turns are ordered by turn (null first), ties by role, then text; null role or text
    becomes empty; rows that repeat are turns of their own.  Rows without a conversation
    belong to none and are left out.  A conversation without turns is a member of the root
    alone; an empty table has no members and so no node, the root included.  Very long
    texts are hashed whole; other columns are not read, whatever their names.
    """
    turns, convs = rebuilt(conversation_turns(df, conv_col, turn_col, role_col, text_col), heads, block)
    members = saved(member_rows(turns, convs), "trie-members")
    grouped = (members.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.count(F.lit(1)).alias("n_convs"), F.max(F.char_length("text")).cast("long").alias("chars")))

    def name(a: str, b: str) -> Column:
        return F.when(F.col(a).isNotNull(), F.concat_ws(":", F.col(a), F.col(b)))

    nodes = saved(grouped.select(*KEY, name("k1", "k2").alias("id"), name("p1", "p2").alias("parent"), "conv_id", "depth",
                                 "n_convs", "chars"), "trie-nodes")
    children = (nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    nodes = saved(nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-known")
    totals = subtree_totals(nodes.select("id", "parent", (F.col("n_children") == 0).cast("long").alias("leaves"),
                                         ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")))
    ends = ends_digests(members.filter("ends").select(*KEY, "conv"))
    # the conversation of the parent; a parent of very many nodes is a skewed join that Spark can split
    above = nodes.filter("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = saved(nodes.join(totals, "id").join(ends, list(KEY), "left"), "trie-whole")
    return whole.join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
