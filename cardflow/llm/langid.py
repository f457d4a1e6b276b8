"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read a window of bytes forwards and backwards; both states at
a byte give the probabilities of its language, so every position is labelled, and the
document's probabilities are the mean over all its bytes.  Texts are read whole, as
consecutive windows of 64 bytes, many windows at once.  The network is trained in numpy
by backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.llm.bytewords import slices
from cardflow.llm.common import saved, seeded, unit
from cardflow.operators.joins import broadcast_if_small

STEPS = 64  # bytes of a window
HIDDEN = 8
SLOPE = np.float32(0.25)
PAD = 0x20
GATES = ("z", "r", "n")  # update, reset, candidate
UNKNOWN = "und"
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes [STEPS, windows], bytes in use per window, document of each window)."""
    sizes = np.diff(offsets)
    count = -(-sizes // STEPS)
    doc = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[doc] + nth * STEPS
    used = np.minimum(STEPS, offsets[doc + 1] - start)
    at = start[None, :] + np.arange(STEPS)[:, None]
    padded = np.concatenate([data, np.full(STEPS, PAD, np.uint8)])
    cells = padded[at]
    cells[np.arange(STEPS)[:, None] >= used[None, :]] = PAD
    return cells, used, doc


@dataclass
class Gru:
    """Weights by name: x{d}{g} a row per byte, u{d}{g} recurrent, o{d} and bias outputs,
    for direction d (f, b) and gate g."""

    names: list[str]
    w: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, names: list[str], seed: int) -> Gru:
        rng = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            for g in GATES:
                w[f"x{d}{g}"] = rng.normal(0, 0.3, (256, HIDDEN)).astype(np.float32)
                w[f"u{d}{g}"] = rng.normal(0, 0.3, (HIDDEN, HIDDEN)).astype(np.float32)
            w[f"o{d}"] = rng.normal(0, 0.3, (HIDDEN, len(names))).astype(np.float32)
        w["bias"] = np.zeros(len(names), np.float32)
        return cls(names, w)

    def states(self, cells: np.ndarray, d: str, keep: dict | None = None) -> np.ndarray:
        """Hidden states [STEPS, windows, HIDDEN] of one direction; `keep` gets what
        backpropagation needs.  Gates are hard sigmoids, the candidate a softsign."""
        w, n = self.w, cells.shape[1]
        x, u = [w[f"x{d}{g}"] for g in GATES], [w[f"u{d}{g}"] for g in GATES]
        out = np.empty((len(cells), n, HIDDEN), x[0].dtype)
        h, z, r, m, c, got, tmp = (np.zeros((n, HIDDEN), x[0].dtype) for _ in range(7))
        for t in range(len(cells)) if d == "f" else range(len(cells) - 1, -1, -1):
            if keep is not None:
                z, r, m, c = (np.empty_like(h) for _ in range(4))
            at = cells[t].astype(np.intp)
            for gate, xg, ug in ((z, x[0], u[0]), (r, x[1], u[1])):
                np.matmul(h, ug, out=gate)
                gate += xg.take(at, axis=0, out=got, mode="clip")
                gate *= SLOPE
                gate += 0.5
                np.maximum(gate, 0, out=gate)
                np.minimum(gate, 1, out=gate)
            np.matmul(h, u[2], out=m)
            np.multiply(r, m, out=c)
            c += x[2].take(at, axis=0, out=got, mode="clip")
            np.abs(c, out=tmp)
            tmp += 1
            c /= tmp
            if keep is not None:
                keep[t] = (h, z, r, m, c)
            nxt = out[t]
            np.subtract(h, c, out=nxt)
            nxt *= z
            nxt += c
            h = nxt
        return out

    def odds(self, cells: np.ndarray) -> np.ndarray:
        """Probabilities [STEPS, windows, languages] of every position."""
        return _softmax(self.states(cells, "f") @ self.w["of"] + self.states(cells, "b") @ self.w["ob"]
                        + self.w["bias"])

    def gradients(self, cells: np.ndarray, used: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over the positions in use, and its gradient by
        backpropagation through time in both directions."""
        w, keep, hs = self.w, {"f": {}, "b": {}}, {}
        for d in "fb":
            hs[d] = self.states(cells, d, keep[d])
        p = _softmax(hs["f"] @ w["of"] + hs["b"] @ w["ob"] + w["bias"])
        mask = (np.arange(len(cells))[:, None] < used[None, :]).astype(np.float32)
        total = mask.sum()
        at = np.arange(len(label))
        loss = -float((np.log(np.maximum(p[:, at, label], 1e-12)) * mask).sum() / total)
        e = p
        e[:, at, label] -= 1
        e *= (mask / total)[:, :, None]
        flat = e.reshape(-1, e.shape[2])
        grad = {"bias": flat.sum(axis=0)}
        for d in "fb":
            grad[f"o{d}"] = hs[d].reshape(-1, HIDDEN).T @ flat
            grad |= {f"u{d}{g}": np.zeros((HIDDEN, HIDDEN), np.float32) for g in GATES}
            into = e @ w[f"o{d}"].T
            dh = np.zeros_like(into[0])
            delta = {g: np.empty_like(into) for g in GATES}
            for t in range(len(cells) - 1, -1, -1) if d == "f" else range(len(cells)):
                h, z, r, m, c = keep[d][t]
                dh = dh + into[t]
                dz = dh * (h - c) * (SLOPE * ((z > 0) & (z < 1)))
                dc = dh * (1 - z) * (1 - np.abs(c)) ** 2
                dr = dc * m * (SLOPE * ((r > 0) & (r < 1)))
                dm = dc * r
                for g, v in zip(GATES, (dz, dr, dm)):
                    grad[f"u{d}{g}"] += h.T @ v
                delta["z"][t], delta["r"][t], delta["n"][t] = dz, dr, dc
                dh = dh * z + dz @ w[f"u{d}z"].T + dr @ w[f"u{d}r"].T + dm @ w[f"u{d}n"].T
            for g in GATES:
                v = delta[g].reshape(-1, HIDDEN)
                grad[f"x{d}{g}"] = np.stack([np.bincount(cells.ravel(), v[:, k], 256) for k in range(HIDDEN)], 1)
        return loss, grad


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=2, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=2, keepdims=True)
    return x


def fit(texts: list[bytes], langs: list[str], rounds: int = 400, batch: int = 192, rate: float = 0.02,
        seed: int = 5) -> Gru:
    """Trains on fragments with their languages; with none, a network without languages."""
    names = sorted(set(langs))
    net = Gru.fresh(names, seed)
    if not names:
        return net
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    cells, used, doc = windows(np.frombuffer(b"".join(texts), np.uint8), offsets)
    label = np.array([names.index(x) for x in langs])[doc]
    if len(label) == 0:
        return net
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    v = {k: np.zeros_like(x) for k, x in net.w.items()}
    for t in range(1, rounds + 1):
        pick = rng.integers(0, len(label), min(batch, len(label)))
        _, grad = net.gradients(cells[:, pick], used[pick], label[pick])
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        step = rate * min(1.0, 2 * (1 - t / (rounds + 1)))
        for k, g in grad.items():
            g = g.astype(np.float32) * min(1.0, 1.0 / (size + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            net.w[k] = net.w[k] - step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)
    return net


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id's text is a multiple of 5 (or no id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(df: DataFrame, per_language: int = 600, drawn_windows: int = 8192, seed: int = 5, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Gru:
    """Learns from at most `drawn_windows` windows of each language, drawn by a seeded hash
    from all windows of at most `per_language` whole texts, which are drawn by a seeded hash of
    the id.  Rows that are held out or have no language or text are not used."""
    body = F.encode(F.col(text_col).cast("string"), "UTF-8")
    rows = df.filter(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("i"), seeded(seed, id_col).alias("h"), body.alias("body"))
    # first a cut by the hash, so that what reaches a language's task does not grow with the rows
    sizes = saved(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang-sizes")
    rows = rows.join(broadcast_if_small(sizes), "lang").filter(unit(F.col("h")) <= F.lit(3.0 * per_language) / F.col("n"))
    best = Window.partitionBy("lang").orderBy("h", "i", F.xxhash64("body"))
    texts = rows.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= per_language)
    # the windows of a text are cut at once, so its bytes are not repeated for each of them
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.octet_length("body") - 1), F.lit(STEPS)),
                        lambda at: F.struct(at.alias("at"), F.substring(F.col("body"), at + 1, F.lit(STEPS)).alias("part")))
    cut = texts.select("lang", "i", "k", F.explode(parts).alias("w")).select(
        "lang", "w.part", seeded(seed, "k", "w.at", "i").alias("h"))
    least = Window.partitionBy("lang").orderBy("h", "part")
    chosen = cut.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= drawn_windows)
    got = sorted((r["lang"], r["h"], bytes(r["part"])) for r in chosen.select("lang", "h", "part").collect())
    return fit([r[2] for r in got], [r[0] for r in got], seed=seed)


def predict(df: DataFrame, net: Gru, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, positions (bytes labelled
    with the predicted language).

    Only the text is an input of the prediction.  A null text or one without a letter is
    `und` with score 0, as is every text if no language was learned.  Whole texts are
    read, however long; repeated rows get equal results; only the two named columns are
    read; an empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(net)  # about 50 KB at any size of the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            langs, scores, places = [], [], []
            text = batch.column(1)
            for a, b, data, offsets in slices(text, 1 << 19):
                mean = np.zeros((b - a, len(net.names)))
                marks = np.zeros((b - a, len(net.names)), np.int64)
                if len(data) and net.names:
                    _pool(net, data, offsets, mean, marks)
                letters = np.concatenate([[0], np.cumsum(ASCII_LETTER[data])])[offsets]
                for i in range(b - a):
                    known = net.names and (letters[i + 1] > letters[i] or any(
                        c.isalpha() for c in bytes(data[offsets[i]:offsets[i + 1]]).decode("utf-8", "replace")))
                    k = int(mean[i].argmax()) if known else 0
                    langs.append(net.names[k] if known else UNKNOWN)
                    scores.append(float(mean[i, k]) if known else 0.0)
                    places.append(int(marks[i, k]) if known else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(places, pa.int64())], names=["doc_id", "held_out", "lang_pred", "score", "positions"])

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       held_out(F.col(id_col)).alias("held_out"))
    return source.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, positions long")


def _pool(net: Gru, data: np.ndarray, offsets: np.ndarray, mean: np.ndarray, marks: np.ndarray, most: int = 2048) -> None:
    """Adds up position probabilities and position labels per document, `most` windows at once."""
    cells, used, doc = windows(data, offsets)
    size = np.maximum(1, np.diff(offsets))
    for i in range(0, len(doc), most):
        part = cells[:, i:i + most]
        p = net.odds(part)
        off = np.arange(STEPS)[:, None] >= used[None, i:i + most]
        p[off] = 0
        label = p.argmax(axis=2)
        label[off] = -1
        own = doc[i:i + most]
        for k in range(len(net.names)):
            mean[:, k] += np.bincount(own, p[:, :, k].sum(axis=0), len(mean))
            marks[:, k] += np.bincount(own, (label == k).sum(axis=0), len(mean)).astype(np.int64)
    mean /= size[:, None]
