"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

Signature.  The shingles of a text are 64-bit hashes; a first permutation s maps them
to the cyclic universe 0 .. 2**32 - 1, and one second permutation p, shifted around the
circle by k places, gives coordinate k: min over shingles x of p(s(x) + k).  Two
permutations make all coordinates.

Candidates.  Rows with equal shingle sets form a class, which is a node from here on.  The
signature is cut into bands of 24, of 12, and of as many coordinates as find a pair at the
threshold with odds of 1 - 1e-6 (6 at 0.85, 5 at 0.8).
1. Within each bucket of any band every class is paired with the bucket's smallest and
   largest class only (two stars, so a bucket gives at most twice its size in pairs).
   Pairs are verified on full shingle sets, and connected components are computed.
2. Buckets of the narrowest bands that still hold several components are open.  In rounds,
   each open bucket draws a class at random, which is paired with the bucket's classes of
   other components; verified links join components, until a round joins few of them.
   A class draws from all its buckets, so a family that holds together at all comes
   together in a few rounds, with pairs in proportion to its size.
3. What is open then gives the pairs between different components, in blocks, but for
   those inside a bucket's largest component.  After their verification every candidate
   pair is known to be linked, or inside one component, or not a link, so components are
   those of all candidate pairs.

A candidate pair must also agree in size, in a fair part of 2-bit digests of its
coordinates, and in its odd sketch: the parity of the number of shingles in each of 4096
cells.  Two sets differ in at least as many shingles as their sketches in cells, so this
test loses no link, and for sets of some hundred shingles it tells apart similarities 0.01
apart.  For large sets, whose differences fill the cells, the law of the sketch takes its
place, and above 8192 shingles a sample by hash; these tests and that of the digests lose a
link with odds below 1e-6 each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.bytewords import U, mix, shingle_sets
from cardflow.llm.common import saved
from cardflow.llm.components import connected
from cardflow.operators.joins import broadcast_if_small

K = 192
MISS = 1e-6  # odds that the narrowest bands miss a pair at the threshold
WIDE = 512  # shingles handled at once: 192 * 512 numbers stay in the cache
CELLS = 4096  # cells of the odd sketch
FULL = 8192  # shingles up to which a set is sketched whole
BLOCK = 2000  # rows of a bucket that one task pairs with as many others


def band_rows(threshold: float) -> tuple[int, int, int]:
    """Coordinates per band of the three levels, the narrowest (and complete) one last."""
    fit = [r for r in range(1, 12) if (1 - threshold ** r) ** (K // r) <= MISS]
    return 24, 12, max(fit, default=1)


def agree_at_least(threshold: float, k: int) -> int:
    """Of k 2-bit digests, as many agree in two sets of that similarity: the mean less
    five standard deviations."""
    p = threshold + (1 - threshold) / 4
    return int(np.floor(k * p - 5 * np.sqrt(k * p * (1 - p))))


def signature(shingles: np.ndarray, k: int = K) -> np.ndarray:
    """The first k circulant MinHash coordinates of a non-empty set of 64-bit hashes."""
    x = (shingles ^ (shingles >> U(32))).astype(np.uint32)
    x *= np.uint32(0x9E3779B1)  # first permutation, on the circle of 2**32 places
    x ^= x >> np.uint32(15)
    if k > K:
        return np.concatenate([_coordinates(x, i, min(K, k - i)) for i in range(0, k, K)])
    return _coordinates(x, 0, k)


def _coordinates(x: np.ndarray, first: int, k: int) -> np.ndarray:
    shift = np.arange(first, first + k, dtype=np.uint32)[:, None]
    least = np.full(k, 0xFFFFFFFF, dtype=np.uint32)
    buf = np.empty((k, min(WIDE, len(x))), dtype=np.uint32)
    tmp = np.empty_like(buf)
    for i in range(0, len(x), WIDE):
        part = x[i:i + WIDE]
        y, t = buf[:, :len(part)], tmp[:, :len(part)]
        np.add(part[None, :], shift, out=y)  # the second permutation, shifted k places
        for a, m in ((16, 0x7FEB352D), (15, 0x846CA68B)):
            np.right_shift(y, np.uint32(a), out=t)
            np.bitwise_xor(y, t, out=y)
            np.multiply(y, np.uint32(m), out=y)
        np.right_shift(y, np.uint32(16), out=t)
        np.bitwise_xor(y, t, out=y)
        np.minimum(least, y.min(axis=1), out=least)
    return least


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key per band of `rows` coordinates, the band's number mixed in."""
    cut = sig[:len(sig) // rows * rows].reshape(-1, rows).astype(U)
    key = np.arange(len(cut), dtype=U) + U(rows << 32)
    for i in range(rows):
        key = (key ^ cut[:, i]) * U(0x9FB21C651E98DF25)
        key ^= key >> U(29)
    return key.view(np.int64)


def digest2(sig: np.ndarray) -> np.ndarray:
    """Two bits of every coordinate, packed into longs."""
    two = ((sig * np.uint32(0x85EBCA6B)) >> np.uint32(30)).astype(U).reshape(-1, 32)
    return (two << (np.arange(32, dtype=U) * U(2))[None, :]).sum(axis=1, dtype=U).view(np.int64)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity of the shingles in each cell, packed into longs.  Of a set of more than
    FULL shingles the 1, 1/2, 1/4, ... by hash that is expected to fit is sketched."""
    x = mix(shingles ^ U(0xD1B54A32D192ED03))
    halvings = max(0, int(np.ceil(np.log2(len(x) / FULL)))) if len(x) else 0
    if halvings:
        x = x[x >> U(64 - halvings) == 0]
    odd = np.bincount((x & U(CELLS - 1)).astype(np.int64), minlength=CELLS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


SIGNED = ("doc_id long, text_hash long, n_shingles long, d1 long, d2 long, bits array<bigint>, odd array<bigint>, "
          "ks array<array<bigint>>")


def signer(levels: tuple[int, ...]):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text hash, text) to set size, 128-bit digest of the set, sketches and band keys."""
        longs = pa.list_(pa.int64())
        for batch in batches:
            n, d1, d2, bits, odd, keys = [], [], [], [], [], []
            for s in shingle_sets(batch.column(2)):
                n.append(len(s))
                d1.append((s * U(0xA24BAED4963EE407)).sum(dtype=U).view(np.int64))
                d2.append(np.bitwise_xor.reduce((s ^ (s >> U(31))) * U(0x9FB21C651E98DF25)).view(np.int64)
                          if len(s) else np.int64(0))
                sig = signature(s) if len(s) else np.zeros(0, np.uint32)
                bits.append(digest2(sig))
                odd.append(odd_sketch(s) if len(s) else None)
                keys.append([band_keys(sig, r) for r in levels])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(bits, longs), pa.array(odd, longs), pa.array(keys, pa.list_(longs))],
                names=["doc_id", "text_hash", "n_shingles", "d1", "d2", "bits", "odd", "ks"])
    return signed


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to (node, the sorted shingle hashes as bytes)."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1))], pa.binary())],
            names=["node", "shingles"])


def verifier(percent: int):
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(v.as_buffer(), dtype=U) for v in (x, y))
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                at[at == len(b)] = 0
                both = int((b[at] == a).sum()) if len(b) else 0
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))
    return verified


def _digest(bits: str, name: str, longs: int) -> list[Column]:
    """The longs of a digest as columns: a join compares them in compiled code, where
    as many array accesses make its method too long to be compiled."""
    return [F.get(bits, F.lit(i)).alias(f"{name}_{bits}{i}") for i in range(longs)]


BIT_LONGS, ODD_LONGS = K * 2 // 64, CELLS // 64


def _side(able: DataFrame, name: str) -> DataFrame:
    """The classes with their sketches, columns named after one end of a pair."""
    return able.select(F.col("node").alias(name), F.col("n").alias(f"{name}_n"), *_digest("bits", name, BIT_LONGS),
                       *_digest("odd", name, ODD_LONGS))


def _alike(a: str, b: str, percent: int) -> Column:
    """Sizes, digests and odd sketches of both sides allow the wanted similarity."""
    na, nb = F.col(f"{a}_n"), F.col(f"{b}_n")
    size = F.least(na, nb) * 100 >= F.greatest(na, nb) * percent
    unlike = F.lit(0)
    for i in range(BIT_LONGS):
        x = F.coalesce(f"{a}_bits{i}", F.lit(0)).bitwiseXOR(F.coalesce(f"{b}_bits{i}", F.lit(0)))
        unlike = unlike + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    apart = F.lit(0)
    for i in range(ODD_LONGS):
        apart = apart + F.bit_count(F.coalesce(f"{a}_odd{i}", F.lit(0)).bitwiseXOR(F.coalesce(f"{b}_odd{i}", F.lit(0))))
    # linked sets differ in at most `most` shingles; of a sampled set a part of them
    most = (na + nb) * (100 - percent) / (100 + percent)
    rate_a, rate_b = (F.pow(F.lit(0.5), F.greatest(F.lit(0.0), F.ceil(F.log2(n / FULL)))) for n in (na, nb))
    drawn = F.when(rate_a < 1, most * rate_a + 5 * F.sqrt(most * rate_a)).otherwise(most)
    odds = (1 - F.exp(-2 * drawn / CELLS)) / 2  # of a cell to be odd
    law = CELLS * odds + 5 * F.sqrt(CELLS * odds * (1 - odds))
    return (size & (unlike <= F.lit(K - agree_at_least(percent / 100, K)))
            & ((rate_a != rate_b) | (apart <= F.least(drawn, law))))


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, name: str) -> DataFrame:
    """Of the class pairs (a, b) those whose full shingle sets are alike enough."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = saved(classes.join(nodes, "node").select("node", "doc_id", "text_hash"), f"{name}-nodes")
    texts = docs.join(broadcast_if_small(wanted), ["doc_id", "text_hash"]).select("node", "text")
    sets = saved(texts.mapInArrow(set_rows, "node long, shingles binary").dropDuplicates(["node"]), f"{name}-sets")
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    return saved(both.select("a", "b", "sa", "sb").mapInArrow(verifier(percent), "a long, b long"), f"{name}-links")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) after further links, which join whole components."""
    ends = (links.join(comp.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a")
            .join(comp.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
            .select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    merged = connected(ends).select(F.col("node").alias("component"), F.col("component").alias("outer"))
    return saved(comp.join(merged, "component", "left")
                 .select("node", F.coalesce("outer", "component").alias("component")), "near-components")


def _open(shared: DataFrame, comp: DataFrame) -> DataFrame:
    """(key, node, component, main, others, size) of the bucket rows whose bucket holds several
    components; `main` is its largest one, `others` the classes outside of it."""
    labelled = saved(shared.join(comp, "node"), "near-labelled")
    parts = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("k"))
    buckets = (parts.groupBy("key").agg(F.max(F.struct("k", "component")).alias("top"), F.sum("k").alias("size"))
               .filter(F.col("top.k") < F.col("size"))
               .select("key", F.col("top.component").alias("main"), (F.col("size") - F.col("top.k")).alias("others"), "size"))
    return saved(labelled.join(buckets, "key"), "near-open")


def _cross_pairs(rest: DataFrame, able: DataFrame, percent: int) -> DataFrame:
    """The pairs of open buckets between different components that the sketches allow.

    One side has the classes outside of a bucket's largest component, the other all; both
    are cut into blocks of about BLOCK rows, so no task gets a whole hot bucket."""
    blocks = {"x": F.ceil(F.col("others") / BLOCK), "y": F.ceil(F.col("size") / BLOCK)}

    def side(name: str, other: str, rows: DataFrame) -> DataFrame:
        own = F.pmod(F.xxhash64("node"), blocks[name]).alias(f"block_{name}")
        copies = F.explode(F.sequence(F.lit(0).cast("long"), blocks[other] - 1)).alias(f"block_{other}")
        placed = rows.select("key", own, F.col("node").alias(name), F.col("component").alias(f"{name}_c"),
                             (F.col("component") == F.col("main")).alias(f"{name}_main"), copies)
        return placed.join(_side(able, name), name)

    one = side("x", "y", rest.filter("component != main"))
    two = side("y", "x", rest)
    at = [one[c] == two[c] for c in ("key", "block_x", "block_y")]
    pairs = one.join(two, at[0] & at[1] & at[2] & (one["x_c"] != two["y_c"]) & (two["y_main"] | (one["x"] < two["y"]))
                     & _alike("x", "y", percent))
    return pairs.select(*_ordered("x", "y")).distinct()


def near_groups(df: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two rows are linked if 100 * |A & B| >= percent * |A | B| for their sets of 5-word
    shingles; component_id is the smallest identifier that links reach.  A text without
    words (or a null) has an empty set and is linked with nothing.  Texts with fewer
    than 5 words have their whole sequence as one shingle.  Repeated rows get the same
    result each, and rows that repeat an identifier with another text are rows like any
    other; rows with a null identifier take part in no link and are their own component
    (null).  Only the two named columns are read.
    """
    text = F.col(text_col).cast("string")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    levels = band_rows(percent / 100)
    sig = saved(docs.mapInArrow(signer(levels), SIGNED), "near-signed")
    real = sig.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    digest = ["d1", "d2", "n_shingles"]
    classes = real.groupBy(*digest).agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    # numbered where they are written, so that a number stays with its class
    classes = saved(classes.select(*digest, "first.doc_id", "first.text_hash", F.monotonically_increasing_id().alias("node")),
                    "near-classes")
    members = (real.select("doc_id", *digest)
               .join(classes.select(*digest, "node", F.col("doc_id").alias("rep")), digest).select("doc_id", "n_shingles", "node", "rep"))

    firsts = real.join(classes, ["doc_id", "text_hash", *digest])  # repeated rows repeat here
    keys = firsts.select("node", F.posexplode("ks").alias("level", "keys"))
    keys = keys.select("level", F.explode("keys").alias("key"), "node")
    buckets = (keys.groupBy("level", "key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
               .filter(F.col("lo") < F.col("hi")))
    buckets = saved(buckets, "near-buckets")
    # only classes that share a bucket go on; texts that resemble no other leave here
    shared = saved(keys.join(buckets, ["level", "key"]).distinct(), "near-shared")
    able = saved(firsts.select("node", F.col("n_shingles").alias("n"), "bits", "odd")
                 .join(shared.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "near-able")

    def likely(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs whose sketches allow the wanted similarity."""
        both = pairs.distinct().join(_side(able, "a"), "a").join(_side(able, "b"), "b")
        return saved(both.filter(_alike("a", "b", percent)).select("a", "b"), f"{name}-pairs")

    star = (shared.select("node", F.explode(F.array("lo", "hi")).alias("hub")).filter(F.col("node") != F.col("hub"))
            .select(*_ordered("node", "hub")))
    links = _verified(likely(star, "near-star"), docs, classes, percent, "near-star")
    comp = able.select("node").join(connected(links), "node", "left")
    comp = saved(comp.select("node", F.coalesce("component", "node").alias("component")), "near-components")

    shared = shared.filter(F.col("level") == len(levels) - 1).select("key", "node")
    rest = _open(shared, comp)
    turn = 0
    while not rest.isEmpty():
        turn += 1
        drawn = rest.groupBy("key").agg(F.min_by(F.struct(F.col("node").alias("hub"), F.col("component").alias("hub_c")),
                                                 F.xxhash64(F.lit(turn), "key", "node")).alias("drawn"))
        pairs = (rest.join(drawn.select("key", "drawn.*"), "key").filter(F.col("component") != F.col("hub_c"))
                 .select(*_ordered("node", "hub")))
        links = _verified(likely(pairs, "near-drawn"), docs, classes, percent, "near-drawn")
        found = links.count()
        if found == 0:
            break
        few = 20 * found < rest.select("component").distinct().count()
        comp = _joined(comp, links)
        rest = _open(shared, comp)
        if few:
            break
    if not rest.isEmpty():
        cross = saved(_cross_pairs(rest, able, percent), "near-cross-pairs")
        comp = _joined(comp, _verified(cross, docs, classes, percent, "near-cross"))

    # the smallest identifier of each component of classes
    named = comp.join(classes.select("node", "doc_id"), "node")
    least = saved(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "near-least")
    known = saved(comp.join(least, "component").select("node", "component_id"), "near-known")
    found = (members.join(known, "node", "left")
             .select("doc_id", "n_shingles", F.coalesce("component_id", "rep").alias("component_id")))
    alone = sig.filter((F.col("n_shingles") == 0) | F.col("doc_id").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
