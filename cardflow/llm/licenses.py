"""License scan: an exact set-similarity join of text blocks with license templates.

A template is a row (label, text), of a few words or a whole license; its words are folded
and cut like those of a text.  Blocks for a template of at most W / 2 words, W the next such
power of two and 64 at least, are the lines of a text (a line of more than W words gives
windows of W words, each half a window after the one before) and the windows over the words
of the whole text, its lines joined, so that a template broken over line ends is found.  A
template matches a block if the block holds at least THRESHOLD of its distinct words, which
is a = ceil(THRESHOLD * size) words.

Candidates are texts that hold enough of a template in all, by a set-similarity join.  The
words of all templates are ordered by the number of texts that hold them, the rarest first;
then, with the template words of a text in this order,

* prefix filter: of the size - a + 1 rarest words of a matching template, and of the
  len - a + 1 rarest template words of the text, some word is common to both;
* length filter: the text has at least a template words;
* positional filter: after a common word at place i of the one and j of the other, no
  more than the remaining words can still agree.

What passes is verified on the whole sets, then block by block, so the join is exact: no
block holds more of a template than its text.  Templates, their words and their prefixes are
tables, which are broadcast behind a check of their bytes and joined as usual beyond it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardflow.llm.common import saved
from cardflow.operators.joins import broadcast_if_small

# The base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Templates of this library: label and text, in lower case without marks.
TEMPLATES = (
    ("agpl", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc0", "this work is dedicated to the public domain"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.9
WINDOW = 64  # words of the smallest window; every template fits into half of its window
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def needed(template: str) -> int:
    return math.ceil(THRESHOLD * len(set(template.split())) - 1e-9)


def template_table(spark: SparkSession) -> DataFrame:
    """The templates of this library as a table."""
    return spark.createDataFrame(TEMPLATES, "label string, text string")


def folded(text: Column) -> Column:
    """A-Z in lower case.  `lower` does that faster; only two other characters have a
    lower-case form that begins with one of a-z."""
    odd = text.contains("\u0130") | text.contains("\u212A")
    return F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def words_of(text: Column) -> Column:
    """The folded words of a text without line ends."""
    clean = F.trim(F.regexp_replace(folded(text), NO_WORD, " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def known_templates(templates: DataFrame) -> DataFrame:
    """(template, label, words, size, needed, window) of the templates with words; rows that
    repeat are one, a null label or text counts as empty."""
    own = templates.select(F.coalesce(F.col("label").cast("string"), F.lit("")).alias("label"),
                           words_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("all")).distinct()
    size = F.size("words")
    return (own.withColumn("words", F.array_distinct("all")).filter(size > 0)
            .withColumn("template", F.row_number().over(Window.orderBy("label", F.concat_ws(" ", "all"))))
            .select("template", "label", "words", size.alias("size"), F.ceil(size * F.lit(THRESHOLD) - 1e-9).cast("int").alias("needed"),
                    F.greatest(F.lit(WINDOW), F.pow(F.lit(2.0), F.ceil(F.log2(F.size("all"))) + 1).cast("int")).alias("window")))


def lines_of(text: Column) -> Column:
    """The non-empty lines of a text as its folded words with one space between them."""
    return F.filter(F.transform(F.split(folded(text), "\n"), lambda s: F.trim(F.regexp_replace(s, NO_WORD, " "))),
                    lambda s: s != "")


def row_key(id_col: str, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), text))


def scan_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts: per row doc_id, a digest of (id, text) as its key, word
    count, base matches, and its distinct words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    body = df.select(F.col(id_col).alias("doc_id"), row_key(id_col, text).alias("key"), lines_of(text).alias("lines"))
    body = body.withColumn("body", F.concat(F.lit(" "), F.concat_ws(" ", "lines"), F.lit(" ")))
    words = F.when(F.size("lines") == 0, F.lit(0)).otherwise(_spaces(F.col("body")) - 1).cast("long")

    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES:
        padded, n = f" {phrase} ", len(phrase.split())
        hit = F.col("body").contains(padded)
        mirror = F.reverse("body")
        counts.append(F.when(hit, F.regexp_count("body", F.lit(f"(?<= ){phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(hit, _spaces(F.substring_index("body", padded, 1))))
        lasts.append(F.when(hit, F.col("n_words") - n - _spaces(F.substring_index(mirror, padded[::-1], 1))))
        labels.append(F.when(hit, F.lit(label)))

    return body.withColumn("n_words", words).select(
        "doc_id", "key", "n_words", sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"), F.array_distinct(F.split(F.trim("body"), " ")).alias("words"))


def candidate_texts(scan: DataFrame, known: DataFrame) -> DataFrame:
    """(key, template) of the texts that hold enough of a template, by prefix, length and
    positional filters and a comparison of the whole sets."""
    vocabulary = known.select(F.explode("words").alias("word")).distinct()
    held = saved(scan.select("key", F.explode("words").alias("word")).join(broadcast_if_small(vocabulary), "word")
                 .distinct(), "license-held")
    # the global order: rarest first, over one row per word of the templates
    counted = held.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    ranks = vocabulary.join(counted, "word", "left").select(
        "word", F.row_number().over(Window.orderBy(F.coalesce("n", F.lit(0)), "word")).alias("rank"))
    ranks = saved(ranks, "license-ranks")
    ordered = (known.select("template", "size", "needed", F.explode("words").alias("word")).join(ranks, "word")
               .groupBy("template", "size", "needed").agg(F.array_sort(F.collect_list("rank")).alias("ranks")))
    index = saved(ordered.select("template", "size", "needed", "ranks", F.posexplode(
        F.slice("ranks", 1, F.col("size") - F.col("needed") + 1)).alias("i", "rank")), "license-index")
    # a text holds at most the words of the templates
    mine = (held.join(broadcast_if_small(ranks), "word").groupBy("key")
            .agg(F.array_sort(F.collect_list("rank")).alias("mine")))
    placed = mine.select("key", "mine", F.size("mine").alias("len"), F.posexplode("mine").alias("j", "rank"))
    near = placed.join(broadcast_if_small(index), "rank").filter(
        (F.col("len") >= F.col("needed")) & (F.col("j") <= F.col("len") - F.col("needed"))
        & (F.least(F.col("size") - F.col("i"), F.col("len") - F.col("j")) + F.least("i", "j") >= F.col("needed")))
    return near.filter(F.size(F.array_intersect("mine", "ranks")) >= F.col("needed")).select("key", "template").distinct()


def blocks_of(lines: Column, window: Column) -> Column:
    """The word lists that templates of a window's size are compared with."""
    def windows(all_words: Column) -> Column:
        n = F.size(all_words)
        return F.when(n <= window, F.array(all_words)).otherwise(F.transform(
            F.sequence(F.lit(0), n - 1, (window / 2).cast("int")), lambda i: F.slice(all_words, i + 1, window)))

    single = F.flatten(F.transform(lines, lambda s: windows(F.split(s, " "))))
    joined = F.when(F.size(lines) > 1, windows(F.split(F.concat_ws(" ", lines), " ")))
    return F.concat(single, F.coalesce(joined, F.array().cast("array<array<string>>")))


def license_scan(df: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    `templates` is a table of (label, text), this library's own by default; it may be empty,
    and rows without words match nothing.  `score` is the largest share of a template's
    words that one block holds, over the templates that match (1 for a base phrase, 0
    without any match).  A null text counts as empty: no words, no labels, null positions.
    Whole texts are scanned.  Rows that repeat an identifier keep their own results, equal
    rows get equal ones; only the two named columns are read; an empty table gives an empty
    result.
    """
    known = saved(known_templates(template_table(df.sparkSession) if templates is None else templates), "license-templates")
    scan = saved(scan_table(df, id_col, text_col), "license-scan")
    pairs = saved(candidate_texts(scan, known), "license-candidates")

    # the candidate texts again, for their blocks; equal rows are one here
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = (df.select(row_key(id_col, text).alias("key"), text.alias("text"))
             .join(broadcast_if_small(pairs.select("key").distinct()), "key", "left_semi").dropDuplicates(["key"]))
    cut = pairs.join(broadcast_if_small(known), "template").groupBy("key", "window").agg(
        F.collect_list(F.struct("label", "words", "size", "needed")).alias("wanted"))
    blocks = texts.select("key", lines_of(F.col("text")).alias("lines")).join(cut, "key")
    best = F.transform("wanted", lambda t: F.struct(t["label"].alias("label"), t["size"].alias("size"), t["needed"].alias("needed"),
                                                    F.array_max(F.transform("blocks", lambda b: F.size(F.array_intersect(t["words"], b)))).alias("held")))
    matched = (blocks.select("key", "wanted", blocks_of(F.col("lines"), F.col("window")).alias("blocks"))
               .select("key", F.explode(best).alias("m")).filter(F.col("m.held") >= F.col("m.needed")))
    found = matched.groupBy("key").agg(F.collect_set("m.label").alias("own"), F.max(F.col("m.held") / F.col("m.size")).alias("part"))

    own = F.coalesce("own", F.array().cast("array<string>"))
    return scan.drop("words").join(found, "key", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.concat_ws(",", F.array_sort(F.array_distinct("base"))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base", own))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("part", F.lit(0.0))).alias("score"))
