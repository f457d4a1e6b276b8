"""Near-duplicate groups: families of texts around the threshold, repeated identifiers."""

import random

import numpy as np
import pytest

from cardflow.llm import near_dedup
from cardflow.llm.bytewords import U
from odd import table
from test_operators import components

WORDS = [f"w{i}" for i in range(5000)]


def family(n, edits, size=300, seed=1):
    """Texts that change `edits` words each of one text."""
    rnd = random.Random(seed)
    stem = rnd.choices(WORDS, k=size)
    out = []
    for _ in range(n):
        own = list(stem)
        for at in rnd.sample(range(size), rnd.choice(edits)):
            own[at] = rnd.choice(WORDS)
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("edits", [(4, 5), (3, 4), (2,)], ids=["below", "at", "above"])
def test_pairs_of_a_family_do_not_grow_with_its_square(spark, monkeypatch, edits):
    whole, pairs = near_dedup.saved, {}
    for n in (400, 800):
        pairs[n] = 0

        def counted(df, name):
            out = whole(df, name)
            if name.endswith("-pairs"):
                pairs[n] += out.count()
            return out

        monkeypatch.setattr(near_dedup, "saved", counted)
        rows = [(i, t, "en", "a") for i, t in enumerate(family(n, edits))]
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_groups(table(spark, rows)).collect()}
        assert got == components(rows, 80)
    assert pairs[800] < 3 * pairs[400]  # most of them links; a square would be four times


def test_blocks_and_rounds_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    texts = family(60, (3, 4)) + family(60, (4, 5), seed=2) + family(40, (4,), size=100, seed=3) + ["a b c"] * 5
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    for percent in (80, 85):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
               for r in near_dedup.near_groups(table(spark, rows), percent).collect()}
        assert got == components(rows, percent)


def test_one_identifier_on_several_texts(spark):
    a, b = family(1, (0,), 60)[0], family(1, (0,), 60, seed=9)[0]
    rows = [(5, a, None, None), (5, b, None, None), (9, b + " end", None, None), (7, a + " end", None, None), (5, a, None, None)]
    for k in (1, 3, 7):
        got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_groups(table(spark, rows).repartition(k)).collect())
        assert got == [(5, 5, True)] * 3 + [(7, 5, False), (9, 5, False)]


def test_odd_sketch_is_a_lower_bound():
    rnd = np.random.default_rng(3)
    for n, d in ((50, 5), (300, 70), (3000, 700)):
        x = rnd.integers(1, 1 << 63, n, dtype=U)
        y = np.concatenate([x[d:], rnd.integers(1, 1 << 63, d, dtype=U)])
        apart = int(np.bitwise_count((near_dedup.odd_sketch(x) ^ near_dedup.odd_sketch(y)).view(U)).sum())
        assert apart <= 2 * d and apart >= 2 * d - 2 * (2 * d) ** 2 / near_dedup.CELLS
    big = rnd.integers(1, 1 << 63, 40_000, dtype=U)
    assert np.bitwise_count(near_dedup.odd_sketch(big).view(U)).sum() < near_dedup.CELLS // 2 + 200
