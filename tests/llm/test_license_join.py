"""The license join with templates from a table, against brute force and SQL."""

import math
import random
import re

import duckdb
import pyarrow as pa

from cardflow.llm import licenses
from cardflow.llm.oracle import ORACLE
from odd import TEXTS, by_id, table

NO_WORD = re.compile(licenses.NO_WORD)
FOLD = str.maketrans(licenses.UPPER, licenses.LOWER)


def cut(text):
    return [w for w in NO_WORD.split((text or "").translate(FOLD)) if w]


def windows(words, size):
    return [words] if len(words) <= size else [words[i:i + size] for i in range(0, len(words), size // 2)]


def plain_scan(text, templates):
    """(labels, score) of the method alone."""
    labels, score = set(), 0.0
    lines = [w for line in (text or "").split("\n") if (w := cut(line))]
    for label, body in templates:
        words = cut(body)
        if not words:
            continue
        size, least = max(64, 2 ** (math.ceil(math.log2(len(words))) + 1)), math.ceil(0.9 * len(set(words)) - 1e-9)
        blocks = [b for line in lines for b in windows(line, size)] + windows([w for line in lines for w in line], size)
        held = max((len(set(b) & set(words)) for b in blocks), default=0)
        if held >= least:
            labels.add(label)
            score = max(score, held / len(set(words)))
    return ",".join(sorted(labels)), score


def test_hundreds_of_templates_with_whole_bodies(spark):
    rnd = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    body = lambda n: " ".join(rnd.choices(vocabulary, weights, k=n))
    templates = [(f"l{i % 120}", body(rnd.choice([1, 2, 5, 9, 30, 33, 64, 200, 700]))) for i in range(300)]
    templates += templates[:5] + [("none", ""), ("none", " ... "), ("Case", "W1, w2\nW3!")]
    rows = []
    for i in range(120):
        parts = [body(rnd.randrange(1, 80))]
        for _, t in rnd.sample(templates, 2):
            words = cut(t)
            for _ in range(rnd.randrange(1 + len(words) // 8)):
                words[rnd.randrange(len(words))] = "other"
            if rnd.random() < 0.3:
                rnd.shuffle(words)
            parts += ["".join(w + rnd.choice(["\n", " ", ", ", " "]) for w in words), body(rnd.randrange(1, 200))]
        rows.append((1000 + i, rnd.choice(["\n", " "]).join(parts), "en", "a"))
    rows += [r for r in TEXTS if r[0] not in (9, 10, 14)]
    df = spark.createDataFrame([(*t, "x") for t in templates], "label string, text string, key string")
    got = licenses.license_scan(table(spark, rows), df).collect()
    want = sorted(((i, *plain_scan(t, templates)) for i, t, _, _ in rows), key=repr)
    base = {r["doc_id"]: r["base_labels"] for r in got}
    mine = sorted(((r["doc_id"], ",".join(x for x in r["labels"].split(",") if x and x not in base[r["doc_id"]].split(",")),
                    r["score"]) for r in got if not base[r["doc_id"]]), key=repr)
    assert mine == [w for w in want if not base[w[0]]]
    assert sum(bool(w[1]) for w in want) > 60
    # the templates are rows of tables, not parts of the plan
    known = licenses.known_templates(df)
    assert known.count() == len({(label, tuple(cut(t))) for label, t in templates if cut(t)})


def test_no_templates(spark):
    empty = spark.createDataFrame([], "label string, text string")
    got = by_id(licenses.license_scan(table(spark, TEXTS), empty))
    assert got[13]["labels"] == "cc-by,reserved" and got[12]["labels"] == "" and got[12]["score"] == 0


def test_wrapped_texts_equal_the_sql(spark):
    fill = "some words of a line that say nothing "
    rows = [(1, "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and so on"),
            (2, "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided"),
            (3, fill * 30 + "\nreleased under\nthe MIT license\n" + fill * 30), (4, "released " + fill * 40 + "under the mit license"),
            (5, "\n".join("this is free and unencumbered software released into the public domain".split())), (6, None), (7, ""),
            (8, "CC BY\nAll rights\nreserved, GNU General Public License"), (9, fill * 7 + "gnu lesser general public license " + fill * 9)]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [i for i, _ in rows], "text": pa.array([t for _, t in rows], pa.string())}))
    res = con.execute(ORACLE["op6_licenses"])
    names = [c[0] for c in res.description]
    want = sorted(res.fetchall())
    got = licenses.license_scan(table(spark, [(i, t, None, None) for i, t in rows]))
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == want
    labels = {r[names.index("doc_id")]: r[names.index("labels")] for r in want}
    assert (labels[1], labels[2], labels[3], labels[4], labels[5]) == ("mit", "bsd", "mit", "", "unlicense")
