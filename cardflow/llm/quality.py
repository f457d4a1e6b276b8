"""Quality classifier: ordinal cumulative-link regression on hashed text.

P(grade > k) = logistic(w . x - t_k) with one weight vector w shared by all grades and
ordered thresholds t_0 < t_1 < ...; the sum of these tails is the expected grade, and
the last tail is the probability of the best grade, by which documents are selected.

x is binary over hashed features of the whole text: every distinct word and word start
(a stem shows in words that are rare themselves), and the shape of the text (binned
shares of byte classes and of repeated words).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.bytewords import U, slices, word_hashes, words
from cardflow.llm.common import seeded, unit

BITS = 18
STEMS = (4, 5)  # bytes of a word's start
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Byte classes whose share of the text is a feature: upper case, digits, line ends, blanks, marks.
CLASSES = np.zeros(256, np.int64)
CLASSES[0x41:0x5B] = 1
CLASSES[0x30:0x3A] = 2
CLASSES[0x0A] = 3
CLASSES[0x20] = 4
for _i, _c in enumerate("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    CLASSES[ord(_c)] = 5 + _i
N_CLASSES = int(CLASSES.max()) + 1
EDGES = np.array([0.0, 0.001, 0.003, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4])
SHAPE = (N_CLASSES + 3) * (len(EDGES) + 1)
WIDTH = (1 << BITS) + SHAPE


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Per row the distinct feature numbers of its text."""
    for a, b, data, offsets in slices(column):
        starts, ends, first = words(data, offsets, LETTERS)
        h = word_hashes(data, starts, ends)
        bucket = (h >> U(64 - BITS)).astype(np.int64)
        stems = [(word_hashes(data, starts, np.minimum(ends, starts + k)) + U(k) >> U(64 - BITS)).astype(np.int64)
                 for k in STEMS]
        same = np.zeros(len(h), bool)
        same[1:] = h[1:] == h[:-1]
        kind = CLASSES[data]
        for d in range(b - a):
            lo, hi = first[d], first[d + 1]
            size = max(1, int(offsets[d + 1] - offsets[d]))
            own = np.unique(bucket[lo:hi])
            share = np.bincount(kind[offsets[d]:offsets[d + 1]], minlength=N_CLASSES) / size
            n = max(1, hi - lo)
            more = [same[lo + 1:hi].sum() / n, len(own) / n, min(1.0, n / 2000)]
            bins = np.searchsorted(EDGES, np.concatenate([share, more]), "left")
            own = np.unique(np.concatenate([own, *[x[lo:hi] for x in stems]]))
            yield np.concatenate([own, (1 << BITS) + np.arange(len(bins)) * (len(EDGES) + 1) + bins])


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) per row and k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))


#: Penalties tried, strongest first, in units of the summed log-likelihood.
PENALTIES = (4.0, 2.4, 1.4, 0.8, 0.5, 0.3, 0.2, 0.12)
FOLDS, ONE_FOLD = 5, 2000  # of more rows than ONE_FOLD a single fifth is held out


class Sparse:
    """Rated rows as (row, column) pairs over the features that `min_rows` rows have.
    The penalty of a feature grows with the fourth root of its rows, so that neither
    rare nor common ones win by their number alone."""

    def __init__(self, rows: list[np.ndarray], grades: np.ndarray, levels: int, min_rows: int):
        seen = np.zeros(WIDTH, np.int64)
        for r in rows:  # a row has a feature once
            seen[r] += 1
        self.n, self.grades, self.levels = len(rows), grades, levels
        self.used = np.flatnonzero((seen >= min_rows) & (seen < len(rows)))
        place = np.full(WIDTH, -1, np.int32)
        place[self.used] = np.arange(len(self.used))
        kept = [c[c >= 0] for c in (place[r] for r in rows)]
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), [len(c) for c in kept])
        self.col = np.concatenate(kept)
        seen = seen[self.used]
        self.weight = np.minimum(seen, self.n - seen) ** 0.25

    def slopes(self, score: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Derivatives of the log-likelihood by the score of each row and by each threshold."""
        upper = np.concatenate([np.full(1, -np.inf), cuts, np.full(1, np.inf)])  # grade k lies above upper[k]
        s = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
        above, beyond = s(score - upper[self.grades]), s(score - upper[self.grades + 1])
        p = np.maximum(above - beyond, 1e-12)
        da, db = above * (1 - above) / p, beyond * (1 - beyond) / p
        by_cut = (np.bincount(self.grades + 1, db, self.levels + 1)[:self.levels + 1]
                  - np.bincount(self.grades, da, self.levels + 1))
        return da - db, by_cut[1:-1]

    def start(self) -> tuple[np.ndarray, np.ndarray]:
        """Without weights the thresholds follow from the shares of the grades."""
        below = np.clip(np.cumsum(np.bincount(self.grades, minlength=self.levels))[:-1] / self.n, 1e-3, 1 - 1e-3)
        cuts = np.log(below / (1 - below)) + np.arange(self.levels - 1) * 1e-3
        return np.zeros(len(self.used)), cuts

    def solve(self, penalty: float, w: np.ndarray, cuts: np.ndarray, rounds: int,
              step: float) -> tuple[np.ndarray, np.ndarray]:
        """Weights and thresholds under the L1 penalty from a near solution, by proximal
        gradient steps of adaptive size.  Only features with a weight or a slope above
        the penalty are moved, until no other feature's slope is above it."""
        base, steps = cuts[:1], np.log(np.diff(cuts))  # thresholds: base, then + exp(step) each
        active = np.flatnonzero(w)
        for again in range(8):
            slope = np.bincount(self.col, self.slopes(np.bincount(self.row, w[self.col], self.n), cuts)[0][self.row],
                                len(self.used))
            more = np.union1d(active, np.flatnonzero(np.abs(slope) > penalty * self.weight * (1.001 if again else 1)))
            if again and len(more) == len(active):
                break
            active = more
            place = np.full(len(self.used), -1, np.int32)
            place[active] = np.arange(len(active))
            col = place[self.col]
            row, col = self.row[col >= 0], col[col >= 0]
            params, least = [w[active], base, steps], penalty * self.weight[active] / self.n
            m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
            for t in range(1, rounds + 1):
                g_score, g_cut = self.slopes(np.bincount(row, params[0][col], self.n), cuts)
                grads = [np.bincount(col, g_score[row], len(active)) / self.n, np.array([g_cut.sum()]) / self.n,
                         np.array([g_cut[k:].sum() for k in range(1, self.levels - 1)]) * np.exp(params[2]) / self.n]
                rate = step * min(1.0, 2 * (1 - t / (rounds + 1)))
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.99 * v[i] + 0.01 * g * g
                    size = rate / (np.sqrt(v[i] / (1 - 0.99 ** t)) + 1e-8)
                    params[i] = params[i] + size * m[i] / (1 - 0.9 ** t)
                    if i == 0:
                        params[0] = np.sign(params[0]) * np.maximum(np.abs(params[0]) - size * least, 0)
                cuts = np.concatenate([params[1], params[1] + np.cumsum(np.exp(params[2]))])
            w = np.zeros(len(self.used))
            w[active] = params[0]
            base, steps, active = params[1], params[2], np.flatnonzero(w)
        return w, cuts

    def model(self, w: np.ndarray, cuts: np.ndarray) -> Ordinal:
        weights = np.zeros(WIDTH)
        weights[self.used] = w
        return Ordinal(weights, cuts)


def likelihood(model: Ordinal, rows: list[np.ndarray], grades: np.ndarray) -> float:
    """Sum of the logarithms of the probabilities that the model gives to the grades."""
    tails = model.tails(np.array([model.weights[r].sum() for r in rows]))
    p = np.column_stack([np.ones(len(rows)), tails, np.zeros(len(rows))])
    at = np.arange(len(rows))
    return float(np.log(np.maximum(p[at, grades] - p[at, grades + 1], 1e-12)).sum())


def fit(rows: list[np.ndarray], grades: np.ndarray, levels: int, min_rows: int = 3,
        penalties: tuple[float, ...] = PENALTIES, rounds: int = 100, step: float = 0.1) -> Ordinal:
    """Maximum likelihood with an L1 penalty over all features that `min_rows` rows have.

    The many rare words of a text say nothing alone, but would add up; the penalty keeps
    their weights at 0, and how strong it is, held-out ratings decide: the strength under
    which they are most likely, over the folds, is used for the fit on all rows.  Folds
    follow from the features, so neither the order of the rows nor their repetition
    matters.  With no rows every weight is 0."""
    levels = max(2, levels)
    if len(rows) == 0:
        return Ordinal(np.zeros(WIDTH), np.arange(levels - 1, dtype=float) - (levels - 2) / 2)
    key = np.array([((r.astype(U) + U(1)) * U(0x9FB21C651E98DF25)).sum(dtype=U) for r in rows])
    key = (key ^ (key >> U(29))) * U(0xA24BAED4963EE407)
    order = np.lexsort([grades, key])
    rows, grades, key = [rows[i] for i in order], grades[order], key[order]
    fold = (key >> U(40)) % U(FOLDS)
    found, from_first = np.zeros(len(penalties)), []
    for k in range(1 if len(rows) > ONE_FOLD else FOLDS):
        inside, out = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(inside) == 0 or len(out) == 0:
            continue
        data = Sparse([rows[i] for i in inside], grades[inside], levels, min_rows)
        at, held = data.start(), []
        for penalty in penalties:
            at = data.solve(penalty, *at, rounds, step)
            held.append(likelihood(data.model(*at), [rows[i] for i in out], grades[out]))
            if k == 0:
                from_first.append(data.model(*at))
            if len(rows) > ONE_FOLD and len(held) > 2 and held[-1] < held[-2] < held[-3]:
                break  # weaker penalties only overfit, and cost the most
        found[:len(held)] += held
        found[len(held):] = -np.inf
    best = int(np.argmax(found))
    data = Sparse(rows, grades, levels, min_rows)
    if best < len(from_first):  # near the solution already
        at = from_first[best].weights[data.used], from_first[best].thresholds
    else:
        at = data.start()
    return data.model(*data.solve(penalties[best], *at, rounds, step))


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pa.array([x.astype(np.int32) for x in features(batch.column(2))], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows], names=["grade", "h", "x"])


def grade_of(quality: Column, toxic: Column) -> Column:
    """Graded rating of a label row: 0 poor, 1 fair but toxic, 2 good; null if unrated."""
    return (F.when(quality == 0, F.lit(0)).when((quality == 1) & (toxic == 1), F.lit(1))
            .when((quality == 1) & (F.coalesce(toxic, F.lit(0)) == 0), F.lit(2)))


def train(df: DataFrame, labels: DataFrame, most: int = 8000, seed: int = 11, id_col: str = "doc_id",
          text_col: str = "text") -> Ordinal:
    """Fits on the rated rows, at most `most` of them, drawn by a seeded hash of the id
    (the same rows however the tables are partitioned); the bound holds for the ratings and
    for the texts that have them, also where identifiers repeat.  Rows of `labels` without an
    id or a rating are left out; no rated row at all gives even odds for every text."""
    rated = (labels.select(F.col("doc_id").alias("_id"), grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
             .filter("_id IS NOT NULL AND grade IS NOT NULL"))
    # first a cut by the hash, so that the final sort does not grow with the labels
    h, n = seeded(seed, "_id"), rated.count()
    drawn = rated.filter(unit(h) <= F.lit(3.0 * most / max(1, n))).orderBy(h, "_id", "grade").limit(most)
    texts = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(drawn), "_id").select(F.col("grade").cast("long").alias("grade"), h.alias("h"), "text")
    found = found.mapInArrow(feature_rows, "grade long, h long, x array<int>")
    table = found.orderBy("h", F.xxhash64("x"), "grade").limit(most).select("grade", "x").toArrow()
    rows = [x.values.to_numpy() for chunk in table["x"].chunks for x in chunk]
    return fit(rows, table["grade"].to_numpy().astype(np.int64), 3)


def score(df: DataFrame, model: Ordinal, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, expected_grade, p_fair, p_good, kept.

    p_fair = P(grade > 0), p_good = P(grade > 1), expected_grade their sum; kept is
    p_good >= least.  A null text counts as empty and an empty text is scored by its
    shape alone.  Whole texts are read, however long.  Repeated rows get equal scores;
    only the two named columns are read; an empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # 2 MB at any size of the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            s = np.array([m.weights[x].sum() for x in features(batch.column(1))], dtype=float)
            p = m.tails(s)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(p[:, -1]),
                 pa.array(p[:, -1] >= least)], names=["doc_id", "expected_grade", "p_fair", "p_good", "kept"])

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, expected_grade double, p_fair double, p_good double, kept boolean")


def select(df: DataFrame, model: Ordinal, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `df` that `score` keeps, with all their columns; texts do not move."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            s = np.array([m.weights[x].sum() for x in features(batch.column(at))], dtype=float)
            yield batch.filter(pa.array(m.tails(s)[:, -1] >= least))

    return df.mapInArrow(run, df.schema)
