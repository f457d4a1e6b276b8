"""A small table with the awkward cases: nulls in every column, empty and very long
texts, ties, repeated rows, and extra columns whose names clash with the operators'."""

from pyspark.sql import types as T

LONG = ("one two three four five six seven eight nine ten " * 4000).strip()
WORDLESS = "  \t\n \r "
UNBROKEN = "x" * 150_000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (3, "the QUICK brown fox jumps over the lazy dog near the river bank today.", None, None),
    (4, None, None, None),
    (5, "", "en", "b"),
    (6, WORDLESS, "fr", "b"),
    (7, "two words", "en", "b"),
    (8, "Two Words", "en", "c"),
    (9, LONG, "en", "c"),
    (10, LONG + " eleven", "en", "c"),
    (11, UNBROKEN, "en", "c"),
    (12, "mail a.b@c.example.org or call +1 (234) 555-0199, ip 10.0.0.1, card 4111 1111 1111 1111.", "en", "a"),
    (13, "Licensed under the Apache License, Version 2.0.\nAll rights reserved. CC BY CC-BY!", "en", "a"),
    (14, "naïve café — ça va? ßÜ 日本語 \U0001f600 <|endoftext|> 's 'll  \x00 end", "fr", "a"),
    (14, "naïve café — ça va? ßÜ 日本語 \U0001f600 <|endoftext|> 's 'll  \x00 end", "fr", "a"),
    (None, "a row without an identifier but with some words", "en", "a"),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("kept", "h", "body", "salt", "bucket", "r", "rows", "id", "key", "spans",
                                                 "component_id", "score", "n_tokens", "b", "top", "at", "grade")]])


def table(spark, texts=TEXTS):
    rows = [(i, t, lang, source, None if t is None else len(t), *["x"] * 17) for i, t, lang, source in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
