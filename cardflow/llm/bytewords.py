"""Word and shingle hashes of Arrow text batches, vectorised over the raw UTF-8 bytes.

A word's hash is a polynomial over a random 64-bit value per byte, taken as the
difference of two running sums, so a batch costs a few passes over its bytes however
many words it has.  Hashes depend on the bytes alone and agree between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
VALUES = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        seq = np.full(size, U(base & (2**64 - 1)), dtype=U)
        seq[0] = U(1)
        have = np.cumprod(seq, dtype=U)
        if size <= 1 << 22:  # keep no table of an unusually long text
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (in place)."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows with at most `most`
    bytes together, or of one longer row.  A null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each document and the total) of the maximal runs of
    word bytes; a run ends where its document ends."""
    inside = is_word[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False  # a document starts outside of any word
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.ones(len(data) + 1, bool)
    after[:-1] = ~inside
    after[offsets] = True
    ends = np.flatnonzero(inside & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, with A-Z folded to a-z where `fold` is set."""
    values = VALUES.copy()
    if fold:
        values[0x41:0x5B] = VALUES[0x61:0x7B]
    run = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(values[data] * powers(BASE, len(data)), out=run[1:], dtype=U)
    h = run[ends] - run[starts]
    h *= powers(INVERSE, len(data) + 1)[starts]
    return mix(h)


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles.  Fewer than k words:
    the whole sequence as one; no words: an empty set."""
    step = U(0xD6E8FEB86659FD93)
    for a, b, data, offsets in slices(column):
        starts, ends, first = words(data, offsets)
        h = word_hashes(data, starts, ends)
        s = np.zeros(max(0, len(h) - k + 1), dtype=U)
        for i in range(k):
            s *= step
            s += h[i:i + len(s)]
        s = mix(s)
        for d in range(b - a):
            lo, hi = first[d], first[d + 1]
            if hi - lo >= k:
                yield np.unique(s[lo:hi - k + 1])
            elif hi > lo:
                one = np.zeros(1, dtype=U)
                for x in h[lo:hi]:
                    one = one * step + x
                yield mix(one + U(hi - lo))
            else:
                yield np.zeros(0, dtype=U)


def repeated_windows(h: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Per word hash in `h` (document d has h[first[d]:first[d + 1]]): whether the k-word
    window that starts there lies in one document and occurs there more than once."""
    found = np.zeros(len(h), bool)
    n = len(h) - k + 1
    if n < 2:
        return found
    step = U(0xD6E8FEB86659FD93)
    s = np.zeros(n, dtype=U)
    for i in range(k):
        s *= step
        s += h[i:i + n]
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = np.flatnonzero(doc[:n] == doc[k - 1:])  # windows that end in the document they start in
    s = mix(s[whole] ^ mix(doc[whole].astype(U) + U(1)))
    order = np.argsort(s)
    same = s[order[1:]] == s[order[:-1]]
    found[whole[order[1:][same]]] = True
    found[whole[order[:-1][same]]] = True
    return found


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of the places 0 .. n - 1 lie in one of the stretches [start, start + length)."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0
