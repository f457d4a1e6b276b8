"""One identifier, or none, on a third of all rows: no task gets them all, results as ever."""

import pytest
from pyspark.sql import functions as F

from cardflow.llm import common, exact_dedup, packing, shards
from odd import table

ROWS = ([(7, f"text {i % 9} of several words", "en", "a") for i in range(700)] + [(None, "one text", "en", "b")] * 700
        + [(1000 + i, "word " * (i % 50), "en", "a" if i % 2 else "b") for i in range(700)])


@pytest.fixture
def parts(monkeypatch):
    """Rows per range of each ranking."""
    sizes, whole = [], common.saved

    def kept(df, name):
        out = whole(df, name)
        if name == "rank-ranges":
            sizes.append([r["count"] for r in out.groupBy("_rk_part").count().collect()])
        return out

    monkeypatch.setattr(common, "saved", kept)
    return sizes


def test_ranks_of_a_hot_key_are_made_in_ranges(spark, parts):
    df = common.saved(table(spark, ROWS).select("doc_id", F.lit("g").alias("group")), "t-hot")
    got = common.ranked(df, "group", [F.col("doc_id").asc_nulls_first()], "r", "n").collect()
    assert sorted(r["r"] for r in got) == list(range(len(ROWS))) and {r["n"] for r in got} == {len(ROWS)}
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["r"])]
    assert ids == sorted((r[0] for r in ROWS), key=lambda i: (i is not None, i or 0))
    assert max(parts[0]) < 3 * len(ROWS) / len(parts[0]) and len(parts[0]) >= 6


def test_packing_and_shards_of_a_hot_identifier(spark, parts):
    packed = packing.pack(table(spark, ROWS), budget=256).collect()
    places = [(r["bucket"], r["batch"], r["slot"]) for r in packed]
    assert len(set(places)) == len(ROWS) == len(packed)
    put = shards.interleaved_shards(table(spark, ROWS), shards=6).collect()
    counts = [sum(r["shard"] == s for r in put) for s in range(6)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(r["slot"] for r in put if r["shard"] == s) == list(range(counts[s])) for s in range(6))
    assert len(parts) == 3 and all(max(p) < 3 * len(ROWS) / 8 for p in parts)


def test_exact_dedup_salts_repeated_rows(spark, monkeypatch):
    seen = []
    whole = exact_dedup.saved

    def kept(df, name):
        out = whole(df, name)
        if name == "dedup-parts":
            seen.extend(r["part_size"] for r in out.select("part_size").distinct().collect())
        return out

    monkeypatch.setattr(exact_dedup, "saved", kept)
    got = exact_dedup.exact_dedup(table(spark, ROWS)).collect()
    assert sum(r["kept"] for r in got) == len({t for _, t, _, _ in ROWS})
    assert max(seen) < 350  # of 700 equal rows
    assert {r["group_size"] for r in got if r["doc_id"] is None} == {700}
