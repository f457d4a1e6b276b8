"""Personal data by weak supervision.

1. Candidates.  Base spans follow fixed patterns and always count.  Wider patterns find
   further places that may hold an address or a number, written in another way.
2. Labelers.  Regex, gazetteer and context labelers vote for (+1) or against (-1) each
   candidate of their kind, or abstain (0).
3. Expectation-maximisation.  Votes are counted over the whole corpus by (kind, vote
   pattern); that table has a bounded number of rows at any input size.  A model with a
   hidden truth per candidate and a reliability per labeler is fitted to it.
4. Span classifier.  A logistic regression is trained on the posterior of each pattern
   over the votes and the span's shape; spans it accepts are added to the base ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardflow.llm.bpe import texts
from cardflow.llm.common import saved

KINDS = ("email", "ip", "card", "phone")

# The base patterns' parts.
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Wider forms: an address spelled out or in brackets, numbers without the leading plus.
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[({](?:at|AT|@)[\])}] ?[A-Za-z0-9-]{1,63}"
                     r"(?:(?:\.| ?[\[({](?:dot|DOT|\.)[\])}] ?)[A-Za-z0-9-]{1,63}){1,4}")
LOOSE_PHONE = re.compile(r"(?<![0-9+().-])(?<![0-9)] )(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-.][0-9]{4}(?![0-9-]|\.[0-9])")
GROUPED = re.compile(r"(?<![0-9])[0-9]{4}(?:[./ ]{1,2}[0-9]{4}){3}(?![0-9./])")
SOLID = re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")
FULL_PHONE = re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])")
SPACED_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?\[?\.\]? ?[0-9]{1,3}){3}(?![0-9.])")

#: Gazetteers: ends of mail domains, first digits of card networks, private address blocks.
ENDINGS = frozenset("com org net edu gov info io de fr es it nl uk eu ch at be pl se example test invalid".split())
NETWORKS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "62", "35", "22", "23", "24", "25", "26", "27")
PRIVATE = ("10.", "127.", "192.168.", "169.254.", "0.", "255.")
#: Words that speak for (or, as versions and sections, against) a kind close before a span.
CONTEXT = {
    "email": (frozenset("email mail e-mail contact write address kontakt correo courriel".split()), frozenset()),
    "ip": (frozenset("ip host server address from login node".split()),
           frozenset("version release v section chapter figure table".split())),
    "card": (frozenset("card visa mastercard amex credit payment karte tarjeta carte".split()),
             frozenset("isbn order serial tracking invoice id".split())),
    "phone": (frozenset("phone call tel telephone mobile cell fax reach telefon llame appelez".split()),
              frozenset("isbn order serial tracking invoice id".split())),
}
NEAR = 32  # characters before a span that a context labeler reads
LABELERS = 4
WORD = re.compile(r"[A-Za-z-]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def small(part: str) -> bool:
    """A decimal of at most 255, however many zeros lead it."""
    return len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str, failed: list[tuple[int, int, int]] | None = None) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base spans, by kind and start.  Linear in the text.
    `failed` gets the runs of digits that were too long or not valid as a whole."""
    found = []
    failed = [] if failed is None else failed
    at, free = text.find("@"), 0
    while at >= 0:  # the leftmost match at an @ begins at the first of the local characters before it
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((0, start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(map(small, m.groups()))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            good = 16 <= len(d := digits_of(m.group())) <= 19 and luhn(d)
            (found if good else failed).append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        (found if 8 <= len(digits_of(m.group())) <= 15 else failed).append((3, m.start(), m.end()))
    return found


def wider_spans(text: str, base: list[tuple[int, int, int]], failed: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates that do not overlap a base span or one another."""
    more = []
    for kind, a, b in failed:  # several numbers in a row
        more += [(kind, m.start(), m.end()) for m in (SOLID if kind == 2 else FULL_PHONE).finditer(text, a, b)
                 if kind == 3 or luhn(m.group())]
    if "(" in text or "[" in text or "{" in text:
        more += [(0, m.start(), m.end()) for m in SPELLED.finditer(text)]
    more += [(2, m.start(), m.end()) for m in GROUPED.finditer(text) if luhn(digits_of(m.group()))]
    more += [(3, m.start(), m.end()) for m in LOOSE_PHONE.finditer(text)]
    more += [(1, m.start(), m.end()) for m in SPACED_IP.finditer(text)]
    taken = sorted((s, e) for _, s, e in base)
    out, starts = [], np.array([s for s, _ in taken], dtype=np.int64)
    last = -1
    for kind, s, e in sorted(more, key=lambda x: (x[1], -x[2], x[0])):
        i = int(np.searchsorted(starts, e, "left")) - 1  # the last base span that starts before e
        if s >= last and (i < 0 or max(b for _, b in taken[max(0, i - 3):i + 1]) <= s):
            out.append((kind, s, e))
            last = e
    return out


def votes(text: str, kind: int, start: int, end: int) -> tuple[int, ...]:
    """Votes of the labelers: pattern, check of the content, gazetteer, context."""
    span, name = text[start:end], KINDS[kind]
    digits = digits_of(span)
    if kind == 0:
        domain = re.split(r"@|[\[({](?:at|AT|@)[\])}]", span)[-1]
        ending = re.split(r"[^A-Za-z0-9-]+", domain.strip("[](){} "))[-1].lower()
        pattern = 1 if "@" in span and not set(span) & set("[]{}() ") else 0
        content = 1 if 2 <= len(ending) <= 24 and ending.isalpha() else -1
        gazetteer = 1 if ending in ENDINGS else 0
    elif kind == 1:
        parts = re.findall(r"[0-9]+", span)
        pattern = 1 if IP.fullmatch(span) else 0
        content = 1 if len(parts) == 4 and all(map(small, parts)) else -1
        gazetteer = -1 if span.startswith(PRIVATE) else 0
    elif kind == 2:
        pattern = 1 if CARD.fullmatch(span) else 0
        content = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        gazetteer = 1 if digits.startswith(NETWORKS) else -1
    else:
        pattern = 1 if PHONE.fullmatch(span) else 0
        content = 1 if 8 <= len(digits) <= 15 else (0 if len(digits) == 7 else -1)
        local = digits[-10:]
        gazetteer = 0 if len(local) < 10 else (1 if local[0] in "23456789" else -1)
    before = [w.lower() for w in WORD.findall(text[max(0, start - NEAR):start])]
    good, bad = CONTEXT[name]
    context = 1 if good & set(before) else (-1 if bad & set(before) else 0)
    return pattern, content, gazetteer, context


def shape(text: str, start: int, end: int) -> int:
    """The span's shape as a number below 16: brackets, blanks, dashes, length."""
    span = text[start:end]
    return ((any(c in "()[]{}" for c in span)) + 2 * (" " in span) + 4 * ("-" in span) + 8 * (end - start > 18))


def encoded(vote: tuple[int, ...], form: int) -> int:
    """Votes and shape as one number below 3**4 * 16."""
    n = 0
    for v in vote:
        n = n * 3 + v + 1
    return n * 16 + form


def decoded(pattern: int) -> tuple[list[int], int]:
    form, n, out = pattern % 16, pattern // 16, []
    for _ in range(LABELERS):
        out.append(n % 3 - 1)
        n //= 3
    return out[::-1], form


CANDIDATES = "array<struct<kind:int,start:int,end:int,base:boolean,pattern:int>>"


CANDIDATE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
                                ("pattern", pa.int32())]))


def candidate_spans(column: pa.Array) -> pa.Array:
    """The candidates of each text: base spans and wider ones, with votes and shape."""
    rows = []
    for text in texts(column):
        failed: list = []
        base = base_spans(text, failed)
        both = [(s, True) for s in base] + [(s, False) for s in wider_spans(text, base, failed)]
        rows.append([{"kind": k, "start": a, "end": b, "base": is_base,
                      "pattern": encoded(votes(text, k, a, b), shape(text, a, b))}
                     for (k, a, b), is_base in both])
    return pa.array(rows, CANDIDATE)


def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), candidate_spans(batch.column(1))], names=["doc_id", "spans"])


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over distinct vote patterns (rows of -1, 0, 1) with their
    counts: (P(true) per pattern, P(vote is right | not abstained) per labeler).  Starts
    from the majority of the votes; one pseudo-count per cell keeps odds finite."""
    if len(patterns) == 0:
        return np.zeros(0), np.full(patterns.shape[1] if patterns.ndim == 2 else 0, 0.5)
    truth = 1 / (1 + np.exp(-1.5 * patterns.sum(axis=1)))
    right = np.full(patterns.shape[1], 0.5)
    for _ in range(rounds):
        prior = (counts @ truth + 1) / (counts.sum() + 2)
        log = np.full(len(patterns), np.log(prior / (1 - prior)))
        for j in range(patterns.shape[1]):
            yes, no = patterns[:, j] == 1, patterns[:, j] == -1
            agree = (counts * (truth * yes + (1 - truth) * no)).sum()
            right[j] = np.clip((agree + 7) / ((counts * (yes | no)).sum() + 10), 0.5, 0.99)
            log += np.log(right[j] / (1 - right[j])) * patterns[:, j]
        nxt = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        if np.abs(nxt - truth).max() < 1e-9:
            break
        truth = nxt
    return truth, right


def inputs(patterns: list[int]) -> np.ndarray:
    """Classifier features: each vote for and against, each part of the shape, 1."""
    rows = []
    for p in patterns:
        vote, form = decoded(p)
        rows.append([v == 1 for v in vote] + [v == -1 for v in vote] + [form >> i & 1 for i in range(4)] + [1])
    return np.array(rows, dtype=float).reshape(len(patterns), 2 * LABELERS + 5)


def classifier(x: np.ndarray, truth: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic regression on the posteriors, by Newton steps with an L2 penalty."""
    w = np.zeros(x.shape[1])
    share = counts / max(1.0, counts.sum()) * min(1e4, counts.sum())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (share * (truth - p)) - 0.1 * w
        step = np.linalg.solve((x.T * (share * p * (1 - p) + 1e-9)) @ x + 0.1 * np.eye(len(w)), g)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


def find_candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, candidate spans) of every row, written to the shared folder."""
    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return saved(source.mapInArrow(candidates, f"doc_id long, spans {CANDIDATES}"), "pii-candidates")


def span_odds(found: DataFrame) -> dict[int, float]:
    """P(personal data) by kind * 4096 + pattern, learned from all candidates: their
    counts by kind and pattern have at most 4 * 3**4 * 16 rows, at any size of the table."""
    seen = (found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.pattern")
            .agg(F.count(F.lit(1)).alias("n")).collect())
    odds = {}
    for k in range(len(KINDS)):
        own = sorted((r["pattern"], r["n"]) for r in seen if r["kind"] == k)
        if own:
            patterns, n = [p for p, _ in own], np.array([c for _, c in own], dtype=float)
            truth, _ = reliabilities(np.array([decoded(p)[0] for p in patterns]), n)
            x = inputs(patterns)
            p = 1 / (1 + np.exp(-x @ classifier(x, truth, n)))
            odds |= {k * 4096 + a: float(b) for a, b in zip(patterns, p)}
    return odds


def span_table(df: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, spans array<struct<kind, start, end, base, p>> by
    kind and start, base spans and those that the classifier accepts (p >= least).

    Positions are code points, end exclusive.  A null or empty text has no spans; with
    no candidate in the whole table no row has.  Repeated rows get equal results; only
    the two named columns are read; an empty table gives an empty result.
    """
    found = find_candidates(df, id_col, text_col)
    odds = span_odds(found)
    lookup = (F.create_map(*[F.lit(v) for kv in sorted(odds.items()) for v in kv]) if odds
              else F.lit(None).cast("map<int,double>"))
    scored = F.transform("spans", lambda s: F.struct(
        F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"), s["start"].alias("start"),
        s["end"].alias("end"), s["base"].alias("base"),
        F.coalesce(lookup[s["kind"] * 4096 + s["pattern"]], F.lit(0.0)).alias("p"), s["kind"].alias("k")))
    order = lambda a, b: (
        F.when(a["k"] != b["k"], a["k"] - b["k"]).when(a["start"] != b["start"], a["start"] - b["start"])
        .otherwise(a["end"] - b["end"]))
    kept = F.array_sort(F.filter(scored, lambda s: s["base"] | (s["p"] >= least)), order)
    return found.select("doc_id", F.transform(kept, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"),
        s["p"].alias("p"))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["base"])
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS),
                        F.sha2(F.concat_ws(",", F.transform(base, line)).cast("binary"), 256).alias("base_sha256"),
                        F.concat_ws(",", F.transform("spans", line)).alias("spans"))


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlaps merge into the first."""
    out, last = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            out += [text[last:start], f"[{KINDS[kind].upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def masked(df: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
           size_col: str = "n_chars") -> DataFrame:
    """`df` with its personal data masked and `size_col`, where it has one, recounted.
    Spans are those of `span_table`.  The texts are searched once: the candidates are written
    beside the rows, and masked once the classifier is learned, so no text is shuffled and
    identifiers may repeat."""
    names = [f.name for f in df.schema.fields]
    at = names.index(text_col)
    size = names.index(size_col) if size_col in names else None
    spans = "spans"
    while spans in names:
        spans += "_"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, candidate_spans(batch.column(at))], names=[*names, spans])

    schema = T.StructType([*df.schema.fields, T.StructField(spans, T.StructType.fromDDL(f"c {CANDIDATES}")["c"].dataType)])
    found = saved(df.mapInArrow(search, schema), "pii-found")
    odds = span_odds(found.select(F.col(spans).alias("spans")))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, new, own = list(batch.columns[:-1]), batch.column(at).to_pylist(), batch.columns[-1].to_pylist()
            sizes = batch.column(size).to_pylist() if size is not None else [None] * len(new)
            for i, text in enumerate(new):
                kept = [(s["kind"], s["start"], s["end"]) for s in own[i]
                        if s["base"] or odds.get(s["kind"] * 4096 + s["pattern"], 0.0) >= least]
                if kept:
                    new[i] = mask(text, kept)
                    sizes[i] = len(new[i])
            cols[at] = pa.array(new, batch.column(at).type)
            if size is not None:
                cols[size] = pa.array(sizes, cols[size].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return found.mapInArrow(replace, df.schema)
