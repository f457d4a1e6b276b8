"""Periodic runs of words, by suffix trees and longest common extensions.

A run is a longest stretch of words with a smallest period q, here of at least `times`
periods and `least` words.  Every run has a period that is a Lyndon word in one of the two
orders of the alphabet, and that word is the longest Lyndon word at its place: it ends
where the next smaller suffix starts.  So the suffixes' ranks in both orders give at most
two candidates a place, and each is extended in both directions as far as it repeats:

* Ukkonen's algorithm builds the suffix trees of the words and of their reversal, in time
  that grows with the words;
* the Euler tour of a tree answers how long two suffixes agree (the string depth of their
  lowest common ancestor: the least depth on the tour between them) in constant time, by
  minima of blocks of the tour and of powers of two of blocks, for all candidates at once;
* the leaves of the first tree in depth-first order, edges in either order of the words,
  are the ranks.

Trees are built where runs can be.  A run of `least` words and `times` >= 2 periods agrees with
itself one period on over at least w = `least` - floor(`least` / `times`) words, and those two parts
cover it; so windows of w words that the text has twice cover every run, and where there
is no such window no tree is built.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.bytewords import covered, repeated_windows, slices, word_hashes, words

BLOCK = 32  # tour places in one block of the minima


class SuffixTree:
    """The suffix tree of a list of numbers >= 1; 0 is put at its end."""

    def __init__(self, symbols: list[int]) -> None:
        s = self.s = [*symbols, 0]
        n, width = len(s), max(s) + 1
        start, stop, link, depth, parent, suffix = [0], [0], [0], [0], [-1], [-1]
        edges: dict[int, int] = {}
        node, edge, length, open_ = 0, 0, 0, 0
        for i, c in enumerate(s):
            open_ += 1
            last = 0
            while open_:
                if length == 0:
                    edge = i
                key = node * width + s[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    over = node
                else:
                    at = start[child]
                    span = stop[child] - at
                    if length >= span:  # walk down
                        node, edge, length = child, edge + span, length - span
                        continue
                    if s[at + length] == c:
                        if last:
                            link[last] = node
                        length += 1
                        break
                    over = edges[key] = len(start)  # split the edge
                    start.append(at)
                    stop.append(at + length)
                    link.append(0)
                    depth.append(depth[node] + length)
                    parent.append(node)
                    suffix.append(-1)
                    at += length
                    start[child] = at
                    parent[child] = over
                    edges[over * width + s[at]] = child
                    edges[over * width + c] = len(start)
                if last:
                    link[last] = over
                last = over if child is not None else 0
                open_ -= 1
                start.append(i)  # the leaf
                stop.append(n)
                link.append(0)
                depth.append(n - (i - open_))
                parent.append(over)
                suffix.append(i - open_)
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - open_ + 1
        self.depth, self.parent, self.suffix = depth, np.array(parent), suffix
        self.first_symbol = np.array(s)[np.array(start)]
        self.first_symbol[0] = 0

    def children(self, rising: bool) -> tuple[list[int], list[int]]:
        """Nodes by parent and first symbol (the end of the text before all others), and
        where the children of each node start among them."""
        by = self.first_symbol if rising else np.where(self.first_symbol == 0, 0, self.first_symbol.max() + 1 - self.first_symbol)
        order = np.lexsort((by, self.parent))[1:]  # without the root
        return order.tolist(), np.searchsorted(self.parent[order], np.arange(len(self.parent) + 1)).tolist()

    def ranks(self, rising: bool) -> list[int]:
        """The rank of each suffix among all (the empty one included)."""
        kids, at = self.children(rising)
        suffix, rank, k, stack = self.suffix, [0] * len(self.s), 0, [0]
        while stack:
            v = stack.pop()
            if suffix[v] >= 0:
                rank[suffix[v]] = k
                k += 1
            else:
                stack += kids[at[v]:at[v + 1]][::-1]
        return rank

    def common(self) -> Common:
        kids, at = self.children(True)
        suffix, depth, tour, first, stack = self.suffix, self.depth, [], [0] * len(self.s), [0]
        while stack:
            v = stack.pop()
            if v < 0:
                tour.append(depth[~v])  # back from a child
            elif suffix[v] >= 0:
                first[suffix[v]] = len(tour)
                tour.append(depth[v])
            else:
                tour.append(depth[v])
                below = kids[at[v]:at[v + 1]]
                for child in below[:0:-1]:
                    stack += (child, ~v)
                stack.append(below[0])
        return Common(np.array(tour, np.int32), np.array(first))


class Common:
    """Longest common extensions of suffixes: minima of the Euler tour's depths."""

    def __init__(self, tour: np.ndarray, first: np.ndarray) -> None:
        self.first = first
        blocks = -(-len(tour) // BLOCK)
        cut = np.full((blocks, BLOCK), np.iinfo(np.int32).max, np.int32)
        cut.ravel()[:len(tour)] = tour
        self.tour = cut.ravel()
        self.left = np.minimum.accumulate(cut, axis=1).ravel()
        self.right = np.minimum.accumulate(cut[:, ::-1], axis=1)[:, ::-1].ravel()
        self.powers = [cut.min(axis=1)]
        while 2 << len(self.powers) - 1 <= blocks:
            half, have = 1 << len(self.powers) - 1, self.powers[-1]
            self.powers.append(np.minimum(have[:-half], have[half:]))

    def of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many places suffixes x[k] and y[k] (different ones) agree."""
        a, b = self.first[x], self.first[y]
        a, b = np.minimum(a, b), np.maximum(a, b)
        p, q = a // BLOCK, b // BLOCK
        found = np.minimum(self.right[a], self.left[b])
        for level in range(len(self.powers)):
            size = 1 << level
            at = np.flatnonzero((q - p - 1 >= size) & (q - p - 1 < 2 * size))
            row = self.powers[level]
            found[at] = np.minimum(found[at], np.minimum(row[p[at] + 1], row[q[at] - size]))
        at = np.flatnonzero(p == q)  # inside one block
        if len(at):
            cells = a[at, None] + np.arange(BLOCK)
            inside = cells <= b[at, None]
            found[at] = np.where(inside, self.tour[np.minimum(cells, len(self.tour) - 1)], np.iinfo(np.int32).max).min(axis=1)
        return found


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one with a smaller rank (their number where there is none)."""
    n = len(rank)
    out, stack = [n] * n, []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def find_runs(symbols: list[int], least: int = 24, times: int = 3) -> np.ndarray:
    """Rows (start, length, period) of the runs of a list of numbers >= 1, by start, then period."""
    n = len(symbols)
    if n < least:
        return np.zeros((0, 3), np.int64)
    tree = SuffixTree(symbols)
    ahead, back = tree.common(), SuffixTree(symbols[::-1]).common()
    found = []
    for rising in (True, False):
        i = np.arange(n)
        p = next_smaller(tree.ranks(rising)[:n]) - i
        some = p * times <= n
        i, p = i[some], p[some]
        right, left = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        on = np.flatnonzero(i + p < n)
        right[on] = ahead.of(i[on], i[on] + p[on])
        on = np.flatnonzero(i > 0)
        left[on] = back.of(n - i[on], n - i[on] - p[on])
        length = left + p + right
        long = length >= np.maximum(least, times * p)
        found.append(np.stack([i - left, length, p], axis=1)[long])
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def stretches(inside: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the true stretches of at least `least` places."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in edges.reshape(-1, 2) if b - a >= least]


def echoed(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place of a text that gets a periodic tail, else None:
    with h = crc32(doc_id as text) and g = h // 10, texts with h % 10 = 0 repeat the p =
    1 + (n - a) // (3 + g % 8) words from word a = g % n on up to their end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return at


def document_runs(ids: list[int | None], column: pa.Array, least: int, times: int,
                  echo: bool) -> Iterator[tuple[np.ndarray, bytes]]:
    """Per row its runs and its words without the repeats, joined by one space."""
    window = least - least // times
    for a, b, data, offsets in slices(column):
        starts, ends, first = words(data, offsets)
        h = word_hashes(data, starts, ends, fold=False)
        moved = {d: at for d in range(b - a) if echo and (at := echoed(ids[a + d], int(first[d + 1] - first[d]))) is not None}
        for d, at in moved.items():
            h[first[d]:first[d + 1]] = h[first[d] + at]
        again = repeated_windows(h, first, window)
        some = np.concatenate([[0], np.cumsum(again)])[first]
        for d in range(b - a):
            own = bytes(data[offsets[d]:offsets[d + 1]]).split()  # at the same bytes
            if d in moved:
                own = [own[i] for i in moved[d]]
            runs = np.zeros((0, 3), np.int64)
            if some[d + 1] > some[d]:
                number: dict[bytes, int] = {}
                symbols = [number.setdefault(w, len(number) + 1) for w in own]
                inside = covered(np.flatnonzero(again[first[d]:first[d + 1]]), window, len(own))
                parts = []
                for x, y in stretches(inside, least):
                    names: dict[int, int] = {}  # the tree's own small alphabet
                    part = find_runs([names.setdefault(c, len(names) + 1) for c in symbols[x:y]], least, times)
                    part[:, 0] += x
                    parts.append(part)
                if parts:
                    runs = np.concatenate(parts)  # stretches rise, so do the starts
                if len(runs):
                    dropped = covered(runs[:, 0] + runs[:, 2], runs[:, 1] - runs[:, 2], len(own))
                    own = [w for w, gone in zip(own, dropped.tolist()) if not gone]
            yield runs, b" ".join(own)


def periodic_runs(df: DataFrame, least: int = 24, times: int = 3, echo: bool = False, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, runs (array of start, length, period by start, then
    period, words numbered from 0) and collapsed, the text without the words that a run
    repeats after its first period, words joined by one space.

    `least` >= 2 * `times` and `times` >= 2 bound the runs.  With `echo` some texts are first given a
    periodic tail (see `echoed`).  A null or empty text, or one without words, has no runs
    and collapses to the empty text.  Very long texts are read whole, in time and memory
    that grow with their words.  Repeated rows give equal results, a null identifier stays
    null (and gets no tail); only the two named columns are read; an empty table gives an
    empty result.
    """
    if times < 2 or least < 2 * times:
        raise ValueError("a run needs at least 2 periods and 2 words a period")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, sizes, texts = [], [0], []
            for found, text in document_runs(batch.column(0).to_pylist(), batch.column(1), least, times, echo):
                runs.append(found)
                sizes.append(sizes[-1] + len(found))
                texts.append(text)
            flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
            rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), rows), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "runs", "collapsed"])

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length / period (ties: smallest start, then
    period; four nulls without a run) and the SHA-256 of the list of runs and of the
    collapsed text."""
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))

    def sha(text: Column) -> Column:
        return F.sha2(F.encode(text, "UTF-8"), 256)

    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha(lines).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
