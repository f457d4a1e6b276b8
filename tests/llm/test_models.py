"""The trained models against plain computations, and on awkward rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardflow.llm import langid, quality
from odd import LONG, TEXTS, UNBROKEN, table


def plain_positions(net, text):
    """Probabilities of every byte, in double precision, one step after another."""
    w = {k: v.astype(float) for k, v in net.w.items()}
    data, out = text.encode(), []
    gate = lambda v: np.clip(0.25 * v + 0.5, 0, 1)
    for a in range(0, len(data), langid.STEPS):
        window = list(data[a:a + langid.STEPS])
        cells = window + [langid.PAD] * (langid.STEPS - len(window))
        total = [net_bias.copy() for net_bias in [w["bias"]] * langid.STEPS]
        for d, order in (("f", range(langid.STEPS)), ("b", range(langid.STEPS - 1, -1, -1))):
            h = np.zeros(langid.HIDDEN)
            for t in order:
                x = {g: w[f"x{d}{g}"][cells[t]] for g in langid.GATES}
                z, r = gate(x["z"] + h @ w[f"u{d}z"]), gate(x["r"] + h @ w[f"u{d}r"])
                c = x["n"] + r * (h @ w[f"u{d}n"])
                c = c / (1 + abs(c))
                h = z * h + (1 - z) * c
                total[t] = total[t] + h @ w[f"o{d}"]
        for t in range(len(window)):
            e = np.exp(total[t] - total[t].max())
            out.append(e / e.sum())
    return np.array(out).reshape(-1, len(net.names))


def test_prediction_equals_a_plain_forward_pass(spark):
    net = langid.Gru.fresh(["de", "en", "fr"], 3)
    rnd = random.Random(2)
    texts = ["a", "12 34", "\u65e5\u672c\u8a9e", "", None, "x" * 64, "y" * 65, "na\u00efve caf\u00e9 " * 20]
    texts += ["".join(rnd.choices("abcdef \u00e9\n", k=rnd.randrange(1, 300))) for _ in range(25)]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(3000, texts[7], None, None)] * 2
    got = langid.predict(table(spark, rows), net).collect()
    assert len(got) == len(rows)
    for r in got:
        text = dict((i, t) for i, t, _, _ in rows)[r["doc_id"]] or ""
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        if not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"], r["positions"]) == ("und", 0.0, 0)
            continue
        p = plain_positions(net, text)
        mean = np.sort(p.mean(axis=0))
        assert r["score"] == pytest.approx(mean[-1], abs=1e-4)
        if mean[-1] - mean[-2] > 1e-4:
            best = int(p.mean(axis=0).argmax())
            assert r["lang_pred"] == net.names[best]
            assert abs(r["positions"] - (p.argmax(axis=1) == best).sum()) <= 1 + len(p) // 100


def test_language_training_reads_whole_texts_and_awkward_rows(spark):
    """A language that shows only at the end of long texts is learned from there; repeated rows,
    one unbroken text, a very long one and rows without language do no harm."""
    rnd = random.Random(1)
    lead = "0 1 2 3 4 5 6 7 8 9 " * 40
    words = {"aa": ["kara", "kiri", "koro"], "bb": ["beso", "buso", "boso"]}
    rows = [(i, lead + " ".join(rnd.choices(words[lang], k=120)), lang, None) for i in range(160) for lang in ["aa" if i % 2 else "bb"]]
    rows += [(5, rows[5][1], "aa", None)] * 30 + [(1001, UNBROKEN, "aa", None), (1002, LONG, "bb", None), (1003, "kara", None, None),
                                                  (1004, None, "aa", None), (None, "kiri", "bb", None), (1006, "", "bb", None)]
    df = table(spark, rows)
    net = langid.train(df, drawn_windows=400)
    assert net.names == ["aa", "bb"]
    same = langid.train(df.repartition(7), drawn_windows=400)
    assert all((net.w[k] == same.w[k]).all() for k in net.w)
    probe = [(i, " ".join(rnd.choices(words["aa" if i % 2 else "bb"], k=20)), None, None) for i in range(2000, 2040)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(table(spark, probe), net).collect()}
    assert all(got[i] == ("aa" if i % 2 else "bb") for i, *_ in probe)


def plain_solution(data, penalty, rounds=60_000):
    """Penalised maximum likelihood by plain proximal gradient steps of a small fixed size."""
    x = np.zeros((data.n, len(data.used)))
    x[data.row, data.col] = 1
    w, cuts = data.start()
    base, gaps = cuts[0], np.log(np.diff(cuts))
    size = 0.5 / max(1.0, np.linalg.norm(x, 2) ** 2 / data.n + data.levels)
    for _ in range(rounds):
        cuts = base + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        g, by_cut = data.slopes(x @ w, cuts)
        w = w + size * x.T @ g / data.n
        w = np.sign(w) * np.maximum(np.abs(w) - size * penalty * data.weight / data.n, 0)
        base += size * by_cut.sum() / data.n
        gaps = gaps + size * np.array([by_cut[k:].sum() for k in range(1, data.levels - 1)]) * np.exp(gaps) / data.n
    return w, base + np.concatenate([[0], np.cumsum(np.exp(gaps))])


def objective(data, penalty, w, cuts):
    model = data.model(w, cuts)
    rows = [np.array([], int)] * data.n
    order = np.argsort(data.row, kind="stable")
    ends = np.searchsorted(data.row[order], np.arange(data.n + 1))
    rows = [data.used[data.col[order[ends[i]:ends[i + 1]]]] for i in range(data.n)]
    return (quality.likelihood(model, rows, data.grades) - penalty * (data.weight * np.abs(w)).sum()) / data.n


@pytest.mark.parametrize("penalty", [0.3, 1.5])
def test_ordinal_fit_reaches_the_plain_solution(penalty):
    rng = np.random.default_rng(7)
    rows = [np.unique(rng.integers(0, 12, rng.integers(1, 6))) for _ in range(150)]
    grades = np.array([min(2, max(0, int(1 + (0 in r) + (1 in r) - (2 in r) - (3 in r) + rng.normal(0, 0.7)))) for r in rows])
    data = quality.Sparse(rows, grades, 3, 1)
    own = data.solve(penalty, *data.start(), rounds=600, step=0.05)
    plain = plain_solution(data, penalty)
    assert objective(data, penalty, *own) == pytest.approx(objective(data, penalty, *plain), abs=2e-3)
    assert np.abs(own[0] - plain[0]).max() < 0.15 and np.abs(own[1] - plain[1]).max() < 0.15


def test_training_rows_are_bounded_where_identifiers_repeat(spark, monkeypatch):
    seen = []
    whole = quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, grades, levels: seen.append(len(rows)) or whole(rows, grades, levels))
    rows = [(i % 3, f"text {i} of many words", None, None) for i in range(300)] + [(7, LONG, None, None), (7, LONG, None, None)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in (0, 1, 2, 7)], "doc_id long, quality long, toxic long")
    df = table(spark, rows)
    first = quality.train(df, labels, most=50)
    again = quality.train(df.repartition(9), labels, most=50)
    assert seen == [50, 50] and (first.weights == again.weights).all()


def test_quality_scores_of_long_repeated_and_tied_texts(spark):
    rows = [*TEXTS, (20, LONG, None, None), (21, LONG, None, None), (22, "one " * 50_000, None, None), (20, LONG, None, None)]
    labels = spark.createDataFrame([(i, i % 2, int(i % 4 == 1)) for i in range(1, 23)], "doc_id long, quality long, toxic long")
    df = table(spark, rows)
    model = quality.train(df, labels)
    got = quality.score(df, model).collect()
    assert len(got) == len(rows)
    by_text = {}
    texts = {i: t or "" for i, t, _, _ in rows}
    for r in got:
        assert 0 <= r["p_good"] <= r["p_fair"] <= 1 and r["expected_grade"] == pytest.approx(r["p_fair"] + r["p_good"])
        by_text.setdefault(texts[r["doc_id"]], set()).add((r["expected_grade"], r["kept"]))
    assert all(len(v) == 1 for v in by_text.values())
    plain = {i: model.tails(np.array([model.weights[next(iter(quality.features(pa_text(t)))).astype(int)].sum()]))[0] for i, t in texts.items()}
    assert all(r["p_good"] == pytest.approx(plain[r["doc_id"]][-1]) for r in got)
    kept = quality.select(df, model).select(F.coalesce("text", F.lit("")).alias("t")).collect()
    assert len(kept) == sum(r["kept"] for r in got)


def pa_text(text):
    import pyarrow as pa
    return pa.array([text], pa.string())
