"""The registered query of each operator, over the whole `documents` table with
production parameters, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardflow.llm import (bpe, exact_dedup, fertility, langid, licenses, merkle, near_dedup, packing, pii, quality, runs,
                          shards, trie)
from cardflow.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_packing(spark, d):
    return packing.pack(documents(spark, d))


@query
def op2_pii(spark, d):
    return pii.digest(pii.span_table(documents(spark, d)))


@query
def op3_exact_dedup(spark, d):
    return exact_dedup.exact_dedup(documents(spark, d), keep="max")


@query
def op5_sharding(spark, d):
    return shards.interleaved_shards(documents(spark, d))


@query
def op7_minhash(spark, d):
    return near_dedup.near_groups(documents(spark, d), percent=85)


@query
def op8_langid(spark, d):
    docs = documents(spark, d)
    return langid.predict(docs, langid.train(docs))


@query
def op9_quality(spark, d):
    docs, labels = documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")
    return quality.score(docs, quality.train(docs, labels))


@query
def op10_bpe(spark, d):
    return bpe.bpe_round_trip(documents(spark, d), vocabulary("byte_bpe_50k.json"), with_ids=False)


@query
def op6_licenses(spark, d):
    return licenses.license_scan(documents(spark, d))


@query
def op4_merkle(spark, d):
    return merkle.fingerprints(documents(spark, d))


@query
def op11_fertility(spark, d):
    import public_tokenizers
    return fertility.quality_rules(documents(spark, d), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                   vocabulary("piece_bpe_32k.model"))


@query
def op12_prefix_trie(spark, d):
    return trie.prefix_trie(spark.read.parquet(f"{d}/conversations.parquet"))


@query
def op13_periodic_runs(spark, d):
    return runs.digest(runs.periodic_runs(documents(spark, d), echo=True))
