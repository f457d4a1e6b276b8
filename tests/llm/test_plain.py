"""Parts without Spark, against brute force."""

import itertools
import json
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardflow.llm import langid, near_dedup, packing, pii, quality
from cardflow.llm.bpe import Bpe
from cardflow.llm.bytewords import shingle_sets, words, word_hashes, slices

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    with open(PATH, "rb") as f:
        return Bpe(f.read()), Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"abcdehinorstuABZ  .,'!0129\n\t-_éßñ日本\x1c\x85\xa0\U0001f600", "the", " and", "'s",
                                 "<|endoftext|>"]), max_size=60))
def test_bpe_equals_the_library(both, parts):
    own, library = both
    text = "".join(parts)
    ids = library.encode(text, add_special_tokens=False).ids
    got = own.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids
    assert own.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_bpe_long_texts(both):
    own, library = both
    for text in ("x" * 50_000, "ab " * 20_000, "=" * 3000 + "\n" * 3000, "日" * 9000):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode(own.encode(text)) == text


def test_bpe_refuses_files_that_ask_for_more():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f, pytest.raises(ValueError, match="end_of_word_suffix"):
        Bpe(f.read())
    with open(PATH, "rb") as f:
        whole = json.loads(f.read())
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"post_processor": {"type": "ByteLevel"}},
                   {"added_tokens": [whole["added_tokens"][0] | {"lstrip": True}]}, {"model": whole["model"] | {"ignore_merges": True}}):
        with pytest.raises(ValueError):
            Bpe(json.dumps(whole | change).encode())


def test_bpe_added_tokens_longest_first():
    with open(PATH, "rb") as f:
        whole = json.loads(f.read())
    one = whole["added_tokens"][0]
    whole["added_tokens"] = [one, one | {"content": "<|end", "id": 50257}, one | {"content": "<|endof", "id": 50258}]
    file = json.dumps(whole)
    own, library = Bpe(file.encode()), Tokenizer.from_str(file)
    for text in ("a<|endoftext|>b", "<|endof<|end|>", "<|end<|endoftext|><|endo"):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids


def test_bpe_memory_is_bounded(both, monkeypatch):
    import cardflow.llm.bpe as module
    monkeypatch.setattr(module, "MEMO", 50)
    own, library = both
    rnd = random.Random(1)
    for _ in range(40):
        text = " ".join("".join(rnd.choices("abcdefgh", k=5)) for _ in range(30))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(len(own.pieces.new), len(own.words.new), len(own.pairs.new)) <= 200_000


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 5))
def test_bucket_edges_are_optimal(hist, buckets):
    lengths, counts = np.array(sorted(hist)), np.array([hist[x] for x in sorted(hist)])

    def padding(edges):
        return sum(int(c) * (min(e for e in edges if e >= x) - int(x)) for x, c in zip(lengths, counts))

    edges = packing.best_edges(lengths, counts, buckets)
    assert edges == sorted(set(edges)) and len(edges) <= buckets and edges[-1] == lengths[-1]
    best = min(padding([*inner, int(lengths[-1])]) for k in range(min(buckets, len(lengths)))
               for inner in itertools.combinations([int(x) for x in lengths[:-1]], k))
    assert padding(edges) == best


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and sum(
                    int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*"aB9.@+- ()0124é", "4111 1111 1111 1111", "a@b.co", "1.2.3.4", "+1 (555) 555-0199"]), max_size=25))
def test_base_spans_equal_the_patterns(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == plain_spans(text)


def test_spans_of_very_long_runs():
    assert pii.base_spans("a" * 200_000 + "9" * 200_000 + "@" * 1000) == []
    assert pii.base_spans("a" * 100_000 + "@b.c") == [(0, 0, 100_004)]
    text = "9" * 100_000 + ".1.1.1"
    assert pii.base_spans(text) == []


def test_wider_spans_and_mask():
    text = "7536784127813050 4845168114407329 and joe [at] host [dot] org, call 212-555-0187."
    failed = []
    base = pii.base_spans(text, failed)
    assert base == []
    more = pii.wider_spans(text, base, failed)
    assert [pii.KINDS[k] for k, _, _ in more] == ["card", "card", "email", "phone"]
    assert pii.mask(text, more) == "[CARD] [CARD] and [EMAIL], call [PHONE]."
    assert pii.mask("abc", []) == "abc"


def test_em_finds_reliable_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.4
    quality_of = np.array([0.95, 0.8, 0.6, 0.9])
    right = rng.random((20_000, 4)) < quality_of
    vote = np.where(right == truth[:, None], 1, -1) * (rng.random((20_000, 4)) < 0.8)
    patterns, counts = np.unique(vote, axis=0, return_counts=True)
    posterior, found = pii.reliabilities(patterns, counts.astype(float))
    assert np.abs(found - quality_of).max() < 0.05
    index = {tuple(p): i for i, p in enumerate(patterns)}
    said = posterior[[index[tuple(v)] for v in vote]] > 0.5
    assert (said == truth).mean() > 0.9


def plain_set(text):
    w = text.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_shingle_sets_have_the_right_sizes_and_overlaps():
    rnd = random.Random(4)
    texts = [" ".join(rnd.choices(["a", "B", "b", "cc", "é", "d\x0b"], k=rnd.randint(0, 40))) for _ in range(120)] + [None, "", " \t"]
    sets = list(shingle_sets(pa.array(texts, pa.string())))
    plain = [plain_set(t or "") for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_words_stop_at_documents_and_hash_alike_anywhere():
    column = pa.array(["ab cd", "cd", None, "  ef", "AB"], pa.string())
    (_, _, data, offsets), = slices(column)
    starts, ends, first = words(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends)] == ["ab", "cd", "cd", "ef", "AB"]
    assert first.tolist() == [0, 2, 3, 3, 4, 5]
    h = word_hashes(data, starts, ends)
    assert h[1] == h[2] and h[0] == h[4] and len(set(h.tolist())) == 3
    alone = [np.concatenate([word_hashes(d, *words(d, o)[:2]) for _, _, d, o in slices(column.slice(i, 1), 1)] or [h[:0]])
             for i in range(5)]
    assert np.concatenate(alone).tolist() == h.tolist()


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    for share in (0.5, 0.85, 0.95):
        n = int(1000 * 2 * share / (1 + share))
        other = np.concatenate([base[:n], rng.integers(0, 2**63, 1000 - n).astype(np.uint64)])
        real = n / (2000 - n)
        got = (near_dedup.signature(base, 2048) == near_dedup.signature(other, 2048)).mean()
        assert abs(got - real) < 0.05
    assert (near_dedup.signature(base, 2048)[:192] == near_dedup.signature(base)).all()
    assert near_dedup.band_rows(0.85) == (24, 12, 6) and near_dedup.band_rows(0.8)[-1] == 5


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = langid.Gru.fresh(["a", "b", "c"], 1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    cells, used, label = rng.integers(0, 256, (64, 5)).astype(np.uint8), np.array([64, 64, 30, 2, 64]), np.array([0, 1, 2, 1, 0])
    _, grad = net.gradients(cells, used, label)
    for k, at in (("ufz", (1, 2)), ("ubr", (3, 0)), ("ufn", (1, 2)), ("ubn", (0, 7)), ("of", (2, 1)), ("bias", (1,)),
                  ("xfn", (int(cells[3, 0]), 2)), ("xbz", (int(cells[5, 1]), 4))):
        old, e = net.w[k][at], 1e-4
        net.w[k][at] = old + e
        up = net.gradients(cells, used, label)[0]
        net.w[k][at] = old - e
        down = net.gradients(cells, used, label)[0]
        net.w[k][at] = old
        assert abs((up - down) / (2 * e) - grad[k][at]) < 1e-5


def test_windows_cover_whole_texts():
    data = np.frombuffer(b"a" * 130 + b"" + b"b" * 64 + b"c", np.uint8)
    cells, used, doc = langid.windows(data, np.array([0, 130, 130, 194, 195]))
    assert used.tolist() == [64, 64, 2, 64, 1] and doc.tolist() == [0, 0, 0, 2, 3]
    assert used.sum() == len(data) and (cells[1:, 4] == langid.PAD).all()


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 1500)
    rows = [np.unique(np.concatenate([rng.integers(100, 400, 20), [g] if rng.random() < 0.95 else [50]])) for g in grades]
    model = quality.fit(rows, grades, 3)
    assert model.thresholds[0] < model.thresholds[1]
    tails = model.tails(np.array([model.weights[r].sum() for r in rows]))
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert np.mean((tails > 0.5).sum(axis=1) == grades) > 0.9
    empty = quality.fit([], np.zeros(0, int), 3)
    assert (empty.weights == 0).all()


def test_toxic_words_of_each_language_are_learned_from_few_ratings():
    rnd = random.Random(5)
    vocab = {x: ["".join(rnd.choices("abdeilmnorstu", k=rnd.randint(3, 8))) for _ in range(500)] for x in ("en", "fr", "de", "es")}
    toxic = {"en": "idiot", "fr": "crétin", "de": "trottel", "es": "imbécil"}
    langs, grades, texts = [], [], []
    for _ in range(800):
        lang, bad = rnd.choice(sorted(vocab)), rnd.random() < 0.2
        w = rnd.choices(vocab[lang], k=100) + [toxic[lang]] * bad
        rnd.shuffle(w)
        langs.append(lang)
        grades.append(1 if bad else 2)
        texts.append(" ".join(w) if rnd.random() < 0.9 else " ".join(w).upper() + "!!!")
        grades[-1] = 0 if texts[-1].isupper() else grades[-1]
    rows, grades, langs = list(quality.features(pa.array(texts))), np.array(grades), np.array(langs)
    model = quality.fit(rows[:400], grades[:400], 3)
    kept = model.tails(np.array([model.weights[r].sum() for r in rows]))[:, -1] >= 0.5
    for lang in toxic:
        here = (langs == lang) & (np.arange(800) >= 400)
        assert np.mean(kept[here & (grades == 2)]) > 0.95
        assert np.mean(~kept[here & (grades == 1)]) > 0.8
