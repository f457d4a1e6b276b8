"""The operators on awkward tables, against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cardflow.llm import bpe, exact_dedup, langid, licenses, merkle, near_dedup, packing, pii, quality, shards
from cardflow.llm.components import connected
from odd import LONG, SCHEMA, TEXTS, by_id, table
from test_plain import plain_set

PATH = public_tokenizers.path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_dedup_with_a_hot_text(spark, keep):
    rows = TEXTS + [(100 + i, "hot text" if i % 3 else f"text {i % 50}", None, None) for i in range(900)]
    df = table(spark, rows)
    got = exact_dedup.exact_dedup(df, keep=keep).collect()
    groups = {}
    for i, t, _, _ in rows:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(rows)
    want = {}
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        want[sha(t)] = ((min if keep == "min" else max)(known) if known else None, len(ids))
    for r in got:
        assert (r["keep_id"], r["group_size"]) == want[r["text_sha256"]]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in got) == len(groups)       # exactly one row of each group


def test_shards_against_a_plain_sort(spark):
    rows = TEXTS[:-1] + [(1000 + i, f"t{i}", None, "big" if i % 3 else f"s{i % 7}") for i in range(700)]
    got = shards.interleaved_shards(table(spark, rows), shards=5, seed=3).collect()
    h = lambda i: int(hashlib.md5(f"3:{'' if i is None else i}".encode()).hexdigest()[:15], 16)
    size = lambda t: len((t or "").encode()) + 8
    crc = lambda t: zlib.crc32((t or "").encode())
    strata = {}
    for i, t, _, s in rows:
        strata.setdefault(shards.MISSING if s is None else s, []).append((h(i), i, crc(t), size(t)))
    order = sorted(((r + 0.5) / len(v), s, *x) for s, v in strata.items() for r, x in enumerate(sorted(v)))
    n = len(order)
    want = sorted((x[3], x[5], x[4], p * 5 // n, p - -(-(p * 5 // n) * n // 5)) for p, x in enumerate(order))
    assert sorted((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got) == want
    counts = np.bincount([r["shard"] for r in got], minlength=5)
    assert counts.max() - counts.min() <= 1
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in got)
    mix = [sum(r["shard"] == s and r["source"] == "big" for r in got) / counts[s] for s in range(5)]
    assert max(mix) - min(mix) < 0.03


def test_packing_batches(spark):
    rows = TEXTS[:-1] + [(1000 + i, "w " * (i % 37), None, None) for i in range(800)]
    got = packing.pack(table(spark, rows), buckets=4, budget=200).collect()
    assert len(got) == len(rows)
    tokens = {i: len((t or "").encode().split()) for i, t, _, _ in rows}
    seen = {}
    for r in got:
        assert r["n_tokens"] == tokens[r["doc_id"]] <= r["bucket_len"] and r["padding"] == r["bucket_len"] - r["n_tokens"]
        seen.setdefault((r["bucket"], r["bucket_len"], r["batch"]), []).append(r["slot"])
    for (_, length, _), slots in seen.items():
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) == 1 or len(slots) * length <= 200
    def cell(n):
        wide = 2 ** (n.bit_length() - 1 - 12)
        return n if n <= packing.FINE else -(-n // wide) * wide

    lengths, counts = np.unique([cell(tokens[i]) for i, *_ in rows], return_counts=True)
    edges = packing.best_edges(lengths, counts, 4)
    assert {r["bucket_len"] for r in got} == set(edges)


def components(rows, percent):
    sets = {i: plain_set(t or "") for i, t, _, _ in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_groups_with_a_family_of_copies(spark, percent):
    rnd = random.Random(percent)
    base = ["w%d" % rnd.randint(0, 9999) for _ in range(150)]
    family = [base]
    for _ in range(220):  # copies of copies, each with one word changed: chains and near misses
        w = list(rnd.choice(family))
        w[rnd.randrange(150)] = "z%d" % rnd.randint(0, 9999)
        family.append(w)
    rows = TEXTS + [(100 + i, " ".join(w), None, None) for i, w in enumerate(family)]
    rows += [(5000 + i, " ".join(rnd.choices(base, k=30)), None, None) for i in range(60)]
    got = near_dedup.near_groups(table(spark, rows), percent=percent).collect()
    assert len(got) == len(rows)
    want = components(rows, percent)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_components_of_chains_and_repeats(spark):
    links = [(i, i + 1) for i in range(300)] + [(900, 901), (901, 900), (905, 901), (7, 7), (950, 951), (950, 951)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 900: 900, 901: 900, 905: 900, 950: 950, 951: 950}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_merkle_neighbours_and_likeness(spark):
    rows = TEXTS[:-1]
    got = merkle.fingerprints(table(spark, rows)).collect()
    order = sorted(((i, t or "") for i, t, _, _ in rows), key=lambda x: (-x[0], x[1]))
    want = []
    for k, (i, t) in enumerate(order):
        nxt, cut = order[(k + 1) % len(order)][1], len(t) // 3
        want.append((i, len(t), sha(t[:len(t) - cut] + nxt[:cut])))
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    prints = {}
    for r in got:
        prints.setdefault(r["fingerprint"], set()).add(dict((i, t or "") for i, t, _, _ in rows)[r["doc_id"]])
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    assert all(len(v) == 1 for v in prints.values()) and len(prints) == len({t or "" for _, t, _, _ in rows})
    long = {r["doc_id"]: r for r in got}[9]
    assert long["near_edited"] > 0.5


def test_merkle_single_row_and_null_id(spark):
    one = table(spark, [(3, "abcdef", None, None)])
    r = merkle.fingerprints(one).first()
    assert r["edited_sha256"] == sha("abcdab")
    two = by_id(merkle.fingerprints(table(spark, [(None, "xyz", None, None), (3, "abcdef", None, None)])))
    assert two[3]["edited_sha256"] == sha("abcdxy") and two[None]["edited_sha256"] == sha("xya")


def test_merkle_locates_the_edit(spark):
    df = spark.createDataFrame([("a.\nb.\nc.", "a.\nb.\nC."), ("same", "same"), ("x", "x\ny")], "p string, q string")
    s = df.select(merkle.summary(F.col("p")).alias("a"), merkle.summary(F.col("q")).alias("b"))
    got = s.select(merkle.first_difference(F.col("a"), F.col("b")), merkle.likeness(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(2, 0.5), (None, 1.0), (1, 0.5)]


def plain_tree(text):
    leaves = [[hashlib.sha256(p.encode()).hexdigest() for p in re.findall(merkle.PIECE, s)] for s in text.split("\n")]
    nodes = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in leaves]
    flat = [x for s in leaves for x in s]
    return leaves, nodes, hashlib.sha256(";".join(nodes).encode()).hexdigest(), [(x, flat[:i].count(x)) for i, x in enumerate(flat)]


def plain_compare(p, q):
    (pl, pn, pr, pf), (ql, qn, qr, qf) = plain_tree(p), plain_tree(q)
    if pr == qr:
        return 1.0, []
    one, two = [x for x in pf if x in qf], [x for x in qf if x in pf]
    either, same = len(set(pf) | set(qf)), set(zip(one, one[1:])) & set(zip(two, two[1:]))
    near = min(len(one) / either * (len(same) + 1) / len(one), either / (either + 1)) if one else 0.0
    at = lambda x, i, none=None: x[i] if i < len(x) else none
    places = [(i, j) for i in range(max(len(pn), len(qn))) if at(pn, i) != at(qn, i)
              for x, y in [(at(pl, i, []), at(ql, i, []))] for j in range(max(len(x), len(y), 1))
              if at(x, j) != at(y, j) or not x and not y]
    return near, places


def test_merkle_likeness_and_edits_against_brute_force(spark):
    rnd = random.Random(6)
    piece = lambda: rnd.choice(["a.", "b.", "c!", "long words without an end ", "\n", "\n", "?", "x" * 70])
    pairs = [("a.\nb.", "b.\na."), ("a.b.", "a.\nb."), ("a.\n" * 10, "a.\n" * 1000), ("", ""), ("", "a"), ("", "\n"), ("a", "a\n\n")]
    for _ in range(120):
        p = [piece() for _ in range(rnd.randrange(14))]
        q = list(p)
        for _ in range(rnd.randrange(4)):
            q[rnd.randrange(len(q) + 1):][:0] = [piece()]
            if q:
                q[rnd.randrange(len(q))] = piece()
        pairs.append(("".join(p), "".join(q)))
    df = spark.createDataFrame([(i, p, q) for i, (p, q) in enumerate(pairs)], "i int, p string, q string")
    s = df.select("i", merkle.summary(F.col("p")).alias("a"), merkle.summary(F.col("q")).alias("b"))
    got = {r["i"]: r for r in s.select("i", (F.col("a.root") == F.col("b.root")).alias("same"), merkle.likeness(F.col("a"), F.col("b")).alias("near"),
                                       merkle.differences(F.col("a"), F.col("b")).alias("d")).collect()}
    for i, (p, q) in enumerate(pairs):
        near, places = plain_compare(p, q)
        assert got[i]["near"] == pytest.approx(near, abs=1e-12) and [tuple(x) for x in got[i]["d"]] == places
        assert got[i]["same"] == (p == q) == (got[i]["near"] == 1.0) == (not places)


def test_merkle_neighbours_of_one_hot_identifier(spark):
    """Rows that share an identifier, or have none, are cut into ranges; each text follows one other."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"text {i % 200} " * 3, None, None) for i in range(600)]
    pairs = merkle.with_next(table(spark, rows), "doc_id", "text").select("doc_id", "text", "next").collect()
    assert sorted(r["text"] for r in pairs) == sorted(r["next"] for r in pairs) == sorted(t for _, t, _, _ in rows)
    plan = merkle.fingerprints(table(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 60_000


def test_licenses(spark):
    got = by_id(licenses.license_scan(table(spark, TEXTS)))
    r = got[13]
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (15, 3, 8, 13)
    assert r["base_labels"] == "cc-by,reserved" and r["labels"] == "apache-2.0,cc-by,reserved" and r["score"] == 1.0
    for i in (4, 5, 6, 11):
        assert got[i]["n_base"] == 0 and got[i]["first_word"] is None and got[i]["labels"] == "" and got[i]["score"] == 0
    assert got[9]["n_words"] == 40_000 and got[4]["n_words"] == 0 and got[11]["n_words"] == 1
    lines = [(1, " ".join(["filler"] * 500) + " released under the mit license " + " ".join(["more"] * 500), None, None),
             (2, "license mit the under released", None, None), (3, "released under the license", None, None)]
    got = by_id(licenses.license_scan(table(spark, lines)))
    assert [got[i]["labels"] for i in (1, 2, 3)] == ["mit", "mit", ""]


def test_licenses_broken_over_line_ends(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and so on"
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided"
    mpl = ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy\n"
           " * of it was not distributed */")
    far = "permission is hereby granted free of charge\n" + "filler\n" * 100 + "to any person obtaining a copy of this software"
    fill = "\n".join(["some words of a line that say nothing"] * 700)
    rows = [(1, mit, None, None), (2, bsd, None, None), (3, mpl, None, None), (4, f"{fill}\n{mit}\n{bsd}\n\n{mpl}\n{fill}", None, None),
            (5, far, None, None), (6, "\n".join("released under the mit license".split()), None, None)]
    got = by_id(licenses.license_scan(table(spark, rows)))
    assert [got[i]["labels"] for i in range(1, 7)] == ["mit", "bsd", "mpl-2.0", "bsd,mit,mpl-2.0", "", "mit"]
    assert [got[i]["score"] for i in range(1, 7)] == [1.0, 1.0, 1.0, 1.0, 0.0, 1.0]


def test_pii_digest(spark):
    got = by_id(pii.digest(pii.span_table(table(spark, TEXTS))))
    r = got[12]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
    text = TEXTS[11][1]
    want = [f"{k}:{text.index(v)}:{text.index(v) + len(v)}" for k, v in (
        ("email", "a.b@c.example.org"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (234) 555-0199"))]
    assert r["spans"] == ",".join(want) and r["base_sha256"] == sha(",".join(want))
    assert got[4]["base_sha256"] == sha("") and got[4]["spans"] == ""
    masked = by_id(pii.masked(table(spark, TEXTS)))
    assert masked[12]["text"] == "mail [EMAIL] or call [PHONE], ip [IP], card [CARD]."
    assert masked[12]["n_chars"] == len(masked[12]["text"]) and masked[12]["kept"] == "x"
    assert masked[4]["text"] is None and masked[9]["text"] == LONG


def test_bpe_rows(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    for r in bpe.bpe_round_trip(table(spark, TEXTS), PATH).collect():
        text = dict((i, t or "") for i, t, _, _ in TEXTS)[r["doc_id"]]
        ids = library.encode(text, add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == text
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == sha(text)


def test_language_rows(spark):
    vocab = {"en": "the and of with which that from", "fr": "les des une dans avec pour être", "de": "der die und nicht mit ein für"}
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choices(vocab[lang].split(), k=40)), lang, None)
            for i in range(600) for lang in [rnd.choice(sorted(vocab))]]
    rows += [(9001, None, "en", None), (9002, "123 456 !!", "en", None), (9003, "", None, None),
             (9004, ("les des une dans avec " * 9000), None, None), (None, "the and of which", "en", None)]
    df = table(spark, rows)
    net = langid.train(df)
    assert net.names == ["de", "en", "fr"]
    got = langid.predict(df, net).collect()
    assert len(got) == len(rows)
    lang = {i: x for i, _, x, _ in rows}
    for r in got:
        i = r["doc_id"]
        assert r["held_out"] == (i is None or zlib.crc32(str(i).encode()) % 5 == 0)
        if i in (9001, 9002, 9003):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif i == 9004:
            assert r["lang_pred"] == "fr" and r["positions"] > 0.9 * len("les des une dans avec ") * 9000
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 9000]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    unlearned = langid.predict(df, langid.train(df.filter("false")))
    assert {r["lang_pred"] for r in unlearned.collect()} == {"und"}


def test_quality_rows(spark):
    rnd = random.Random(3)
    rows, rated = [], []
    for i in range(900):
        good, toxic = rnd.random() < 0.7, rnd.random() < 0.3
        w = ["w%d" % rnd.randint(0, 400) for _ in range(60)]
        w = [x.upper() + "!!" for x in w] if not good else w
        w += [rnd.choice(["idiot", "moron"])] if toxic else []
        rows.append((i, " ".join(w), None, None))
        rated.append((i, int(good), int(toxic)))
    rated += [(None, 1, 0), (5000, 1, 0), (1, None, None)]
    labels = spark.createDataFrame(rated, "doc_id long, quality int, toxic int")
    df = table(spark, rows + TEXTS[3:6])
    model = quality.train(df.filter("doc_id < 600 OR doc_id IS NULL"), labels)
    got = [r for r in quality.score(df, model).collect()]
    assert len(got) == len(rows) + 3
    want = {i: q == 1 and t == 0 for i, q, t in rated[:900]}
    test = [r for r in got if 600 <= r["doc_id"] < 900]
    assert np.mean([r["kept"] == want[r["doc_id"]] for r in test]) > 0.95
    assert all(abs(r["expected_grade"] - r["p_fair"] - r["p_good"]) < 1e-9 and r["p_fair"] >= r["p_good"] for r in got)
    kept = quality.select(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in got)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    net, model = langid.train(empty), quality.train(empty, labels)
    for out in (exact_dedup.exact_dedup(empty), shards.interleaved_shards(empty), packing.pack(empty),
                near_dedup.near_groups(empty), merkle.fingerprints(empty), licenses.license_scan(empty),
                pii.digest(pii.span_table(empty)), pii.masked(empty), bpe.bpe_round_trip(empty, PATH),
                langid.predict(empty, net), quality.score(empty, model), quality.select(empty, model)):
        assert out.count() == 0
