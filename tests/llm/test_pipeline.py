"""Each stage of the pipeline on its own input, against a brute-force version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
import corpus_pipeline as pipeline
from cardflow.llm import packing, pii, quality
from cardflow.llm.common import documents, saved
from odd import TEXTS, table
from test_operators import components, sha
from test_plain import plain_spans


def test_stages(spark):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "exact dedup", "near dedup", "personal data", "packing"]
    inputs, docs = [], documents(spark, SF0001)
    columns = docs.columns
    for _, stage in pipeline.STAGES:
        inputs.append(docs)
        docs = saved(stage(spark, docs, SF0001), "t-stage")
    rows = [[(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()] for df in inputs]
    assert all(df.columns == columns for df in inputs)

    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    good = {r["doc_id"] for r in quality.score(inputs[0], quality.train(inputs[0], labels)).filter("kept").collect()}
    assert {r[0] for r in rows[1]} == good and 0 < len(good) <= len(rows[0])

    first = {}
    for i, t, _, _ in sorted(rows[1]):
        first.setdefault(t, i)
    assert sorted(r[0] for r in rows[2]) == sorted(first.values())

    kept = {i for i, (_, c) in components(rows[2], 80).items() if i == c}
    assert {r[0] for r in rows[3]} == kept

    before = dict((i, t) for i, t, _, _ in rows[3])
    for r in inputs[4].collect():
        text = before[r["doc_id"]]
        if not plain_spans(text) and r["text"] != text:
            assert "[" in r["text"]          # a span that the classifier added
        assert not plain_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if plain_spans(text):
            assert any(f"[{k.upper()}]" in r["text"] for k in pii.KINDS)

    tokens = {i: len(t.encode().split()) for i, t, _, _ in rows[4]}
    packed = docs.collect()
    assert {r["doc_id"]: r["n_tokens"] for r in packed} == tokens
    lengths, counts = np.unique(list(tokens.values()), return_counts=True)
    assert {r["bucket_len"] for r in packed} == set(packing.best_edges(lengths, counts, 12))


def test_stages_on_repeated_and_null_ids(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    near = [(200, long + " " + long[::-1], "en", "a"), (201, long + " " + long[::-1] + " end", "en", "a"),
            (None, long + " " + long[::-1] + " End of it", "en", "a"), (None, "mail " * 3 + long[::-1] + long, "en", "b"),
            (None, "mail " * 3 + long[::-1] + long + " x", "en", "b")]
    rows = [*TEXTS, *TEXTS, (100, "A", "en", "a"), (101, "B", "en", "a"), (101, "A", "en", "a"), (101, "B", "en", "b"),
            (None, "A", "fr", "c"), (None, "N", "en", "a"), (None, "N", "en", "a"), *near, near[1], near[4]]
    docs = saved(table(spark, rows), "t-odd")
    stages = dict(pipeline.STAGES)
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    good = stages["quality"](spark, docs, SF0001)
    assert good.count() == quality.score(docs, quality.train(docs, labels)).filter("kept").count()

    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    once = saved(stages["exact dedup"](spark, docs, SF0001), "t-odd-exact")
    first = {}
    for r in sorted(docs.collect(), key=key):
        first.setdefault(r["text"] or "", r["doc_id"])
    got = once.collect()
    assert once.columns == docs.columns and len(got) == len(first)       # one row of each text
    assert {r["text"] or "": r["doc_id"] for r in got} == first
    assert [r["source"] for r in got if r["text"] == "B"] == ["a"]

    apart = saved(stages["near dedup"](spark, once, SF0001), "t-odd-near")
    ordered = [(k, r["text"]) for k, r in enumerate(sorted(got, key=lambda r: (*key(r), sha(r["text"] or ""))))]
    kept = {k for k, (_, c) in components([(k, t, None, None) for k, t in ordered], 80).items() if k == c}
    assert apart.columns == docs.columns
    assert sorted(r["text"] or "" for r in apart.collect()) == sorted(ordered[k][1] or "" for k in kept)
    assert not {201} & {r["doc_id"] for r in apart.collect()} and len(kept) < len(got)

    masked = saved(stages["personal data"](spark, apart, SF0001), "t-odd-masked")
    assert masked.count() == len(kept)
    assert stages["packing"](spark, masked, SF0001).count() == len(kept)


def test_near_dedup_tells_rows_of_one_identifier_apart(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, None, None), (5, "quite another text with seven words", None, None), (9, text + " z", None, None),
            (None, text + " y", None, None), (5, text + " x", None, None)]
    got = pipeline.drop_near_copies(spark, table(spark, rows), SF0001).collect()
    assert sorted(r["doc_id"] for r in got) == [5, 5]
    assert len([r for r in got if r["text"].startswith("w0")]) == 1


def test_stages_on_empty_tables_and_other_columns(spark):
    """Columns of any type and name stay; an empty table stays empty."""
    docs = saved(table(spark, TEXTS + TEXTS[:3]).withColumns(
        {"tags": F.create_map(F.lit("k"), F.col("lang")), "_row": F.lit(7), "_text_sha": F.lit("mine"), "rank": F.col("doc_id")}), "t-more")
    for name, stage in pipeline.STAGES:
        got = stage(spark, docs, SF0001)
        if name != "packing":
            assert got.columns == docs.columns
            rows = got.collect()
            assert rows and all(r["_row"] == 7 and r["_text_sha"] == "mine" and r["tags"] == {"k": r["lang"]} for r in rows)
        assert stage(spark, docs.limit(0), SF0001).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_exact_copies_of_a_frequent_text(spark, hot):
    rows = [(i if i % 7 else None, "hot text" if hot and i % 3 else f"text {i % 50}", "en", f"s{i % 4}") for i in range(700)]
    rows += rows[:40] + [(i, None, None, None) for i in range(3)] + [(i, "", None, None) for i in range(3, 6)]
    got = pipeline.drop_exact_copies(spark, table(spark, rows), SF0001).collect()
    best = {}
    for i, t, _, s in rows:
        best[t or ""] = min(best.get(t or "", (True, 0, "z")), (i is None, i or 0, s or ""))
    assert len(got) == len(best)
    assert {r["text"] or "": (r["doc_id"] is None, r["doc_id"] or 0, r["source"] or "") for r in got} == best
