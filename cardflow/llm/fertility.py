"""Quality rules by tokeniser fertility, beside plain counts of words, marks and repeats.

Two public vocabularies measure every whole text: characters per token and the entropy of
the token counts by a byte-level vocabulary, and the share of byte-fallback tokens by a
vocabulary of pieces.  The measures of ordinary text lie close together within a language
and a length class (powers of two of the token count), so the rejection bands are learned
from the corpus itself: the median of each cell, and as its spread the distance of the
quartiles, over all documents.  A text with a measure farther than `width` spreads from the
median is rejected.  Cells with few documents take the band of the language, languages
with few documents that of all texts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.bytewords import NOT_SPACE, covered, repeated_windows, slices, word_hashes, words
from cardflow.llm.common import saved
from cardflow.operators.joins import broadcast_if_small

WINDOW = 8  # words of a repeated window
MARKS = np.zeros(256, bool)
MARKS[list(b"#*$%&|<>")] = True
BLANK = " \t\n\v\f\r"
PART = 1 << 16  # characters that are tokenised at once
MEASURES = ("chars_per_token", "fallback", "entropy")
#: The least spread of each measure, as a share of the median and as a number.
LEAST = {"chars_per_token": (0.01, 0.0), "fallback": (0.0, 0.002), "entropy": (0.01, 0.0)}
#: Letters of a script by the first letter of their Unicode block, for texts without a language.
SCRIPTS = (("latin", 0x41), ("greek", 0x370), ("cyrillic", 0x400), ("hebrew", 0x590), ("arabic", 0x600),
           ("indic", 0x900), ("thai", 0xE00), ("other", 0x1000), ("latin", 0x1E00), ("other", 0x2000),
           ("kana", 0x3040), ("other", 0x3130), ("han", 0x3400), ("hangul", 0xAC00), ("other", 0xD7B0), ("han", 0x20000))


class Vocabularies:
    """The byte-level ranks and the piece model, from the bytes of their files."""

    def __init__(self, ranks: bytes, pattern: str, pieces: bytes) -> None:
        table = {base64.b64decode(t): int(r) for t, r in (line.split() for line in ranks.splitlines() if line)}
        self.bytes = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())], bool)

    def measure(self, text: str) -> tuple[int, float, float, float]:
        """(tokens, characters per token, byte-fallback share, entropy in bits) of a text;
        zeros without tokens."""
        ids, back, pieces = [], 0, 0
        for part in parts(text):
            ids.append(self.bytes.encode_to_numpy(part))
            own = self.pieces.encode(part)
            back += int(self.fallback[own].sum())
            pieces += len(own)
        n = sum(map(len, ids))
        if n == 0:
            return 0, 0.0, 0.0, 0.0
        share = np.unique(np.concatenate(ids), return_counts=True)[1] / n
        return n, len(text) / n, back / max(1, pieces), abs(float((share * np.log2(share)).sum()))


def parts(text: str) -> Iterator[str]:
    """Consecutive parts of at most PART characters, cut before a space where there is one."""
    a = 0
    while len(text) - a > PART:
        b = text.rfind(" ", a + 1, a + PART)
        b = b if b > a else a + PART
        yield text[a:b]
        a = b
    if a < len(text):
        yield text[a:]


def script(text: str) -> str:
    """The script of most letters (ties: the first by name); "none" without letters."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    code = code[code >= 0x41]
    code = code[(code > 0x7A) | ((code - 0x41) % 32 < 26)]
    if len(code) == 0:
        return "none"
    n = np.bincount(np.searchsorted([c for _, c in SCRIPTS], code, "right") - 1, minlength=len(SCRIPTS))
    names = sorted({name for name, _ in SCRIPTS})
    return max(names, key=lambda name: sum(int(k) for k, (s, _) in zip(n, SCRIPTS) if s == name))


def plain_counts(column: pa.Array) -> Iterator[tuple[int, int, int, int]]:
    """Per row its words, the code points in them, its marks, and the words in windows of
    WINDOW words that the text has twice or more."""
    for a, b, data, offsets in slices(column):
        starts, ends, first = words(data, offsets)
        again = repeated_windows(word_hashes(data, starts, ends, fold=False), first, WINDOW)
        inside = covered(np.flatnonzero(again), WINDOW, len(starts)) if len(starts) else np.zeros(0, bool)
        head = NOT_SPACE[data] & ((data & 0xC0) != 0x80)  # first bytes of the words' characters
        points, marks, repeats = (np.concatenate([[0], np.cumsum(x)]) for x in (head, MARKS[data], inside))
        for d in range(b - a):
            lo, hi, at, end = first[d], first[d + 1], offsets[d], offsets[d + 1]
            yield int(hi - lo), int(points[end] - points[at]), int(marks[end] - marks[at]), int(repeats[hi] - repeats[lo])


def repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    return len(lines) - len(set(lines))


COUNTS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_built: dict[str, Vocabularies] = {}


def measured(df: DataFrame, ranks_path: str, pattern: str, pieces_path: str, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """One row per input row: the plain counts, lang (or the script, in brackets, where it is
    null or `lang_col` is None), n_tokens and the three measures.  The two files are read by
    the driver and sent to the workers; their size does not depend on the data."""
    with open(ranks_path, "rb") as f, open(pieces_path, "rb") as g:
        files = f.read(), pattern, g.read()
    key = hashlib.sha256(files[0] + pattern.encode() + files[2]).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _built:  # once per worker process
            _built.clear()
            _built[key] = Vocabularies(*shared.value)
        vocabularies = _built[key]
        for batch in batches:
            rows = []
            langs = batch.column(2).to_pylist()
            for lang, t, counts in zip(langs, batch.column(1), plain_counts(batch.column(1))):
                text = t.as_py() or ""
                rows.append((counts[0], counts[1], counts[2], repeated_lines(text), counts[3],
                             f"[{script(text)}]" if lang is None else lang, *vocabularies.measure(text)))
            cols = list(zip(*rows)) or [()] * 10
            kinds = [pa.int64()] * 5 + [pa.string(), pa.int64()] + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                             names=[*COUNTS.replace(" long", "").split(", "), "lang", "n_tokens", *MEASURES])

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       (F.lit(None) if lang_col is None else F.col(lang_col)).cast("string").alias("lang"))
    return source.mapInArrow(run, f"{COUNTS}, lang string, n_tokens long, chars_per_token double, fallback double, entropy double")


def length_class() -> Column:
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int")


def bands(rows: DataFrame, width: float = 8.0, min_rows: int = 30) -> DataFrame:
    """(lang, class, and a lower and upper bound of each measure) per cell, language (class
    null) and all texts (both null) with at least `min_rows` documents with tokens.

    The quartiles are exact over values rounded to 1/256, so what a task holds for a cell
    is bounded by the values that the measures can take, not by the documents.
    """
    step = 256.0
    values = rows.filter("n_tokens > 0").select(
        "lang", length_class().alias("class"), *[(F.round(F.col(m) * step) / step).alias(m) for m in MEASURES])
    quartiles = [F.expr(f"percentile({m}, array(0.25, 0.5, 0.75))").alias(m) for m in MEASURES]
    found = (values.groupingSets([[F.col("lang"), F.col("class")], [F.col("lang")], []], "lang", "class")
             .agg(F.count(F.lit(1)).alias("n"), *quartiles).filter(F.col("n") >= min_rows))

    def bounds(m: str) -> list[Column]:
        q = [F.col(m)[i] for i in range(3)]
        share, least = LEAST[m]
        spread = F.greatest((q[2] - q[0]) / 1.349, q[1] * share, F.lit(least))  # a normal law's deviation
        return [(q[1] - width * spread).alias(f"{m}_low"), (q[1] + width * spread).alias(f"{m}_high")]

    return found.select("lang", "class", *[b for m in MEASURES for b in bounds(m)])


def quality_rules(df: DataFrame, ranks_path: str, pattern: str, pieces_path: str, width: float = 8.0, min_rows: int = 30,
                  id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, lang (or the script in brackets), n_tokens,
    chars_per_token, fallback, entropy, rejected_by (the measures outside their band).

    A null text counts as empty; an empty text has zeros everywhere and fails the base
    rules.  A text without tokens is in no band and no measure rejects it; so is every text
    where fewer than `min_rows` texts have tokens.  Very long texts are read whole, their
    tokens counted in parts of 65,536 characters.  Repeated rows are judged each, alike; a
    null identifier is kept as null; other columns are not read; an empty table gives an
    empty result.
    """
    rows = saved(measured(df, ranks_path, pattern, pieces_path, id_col, text_col, lang_col), "fertility-rows")
    found = saved(bands(rows, width, min_rows), "fertility-bands")
    limits = [c for c in found.columns if c not in ("lang", "class")]

    def named(kind: str) -> list[Column]:
        return [F.col(c).alias(f"{kind}_{c}") for c in limits]

    cell = found.filter("lang IS NOT NULL AND class IS NOT NULL").select("lang", "class", *named("cell"))
    lang = found.filter("lang IS NOT NULL AND class IS NULL").select("lang", *named("lang"))
    whole = found.filter("lang IS NULL AND class IS NULL").select(*named("all"))
    banded = (rows.withColumn("class", length_class())
              .join(broadcast_if_small(cell), ["lang", "class"], "left").join(broadcast_if_small(lang), "lang", "left")
              .join(F.broadcast(whole), how="left"))  # one row at most

    def outside(m: str) -> Column:
        low, high = (F.coalesce(*[f"{kind}_{m}_{end}" for kind in ("cell", "lang", "all")]) for end in ("low", "high"))
        return F.when((F.col("n_tokens") > 0) & ((F.col(m) < low) | (F.col(m) > high)), F.lit(m))

    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = banded.withColumn("base_failed", failed).withColumn("rejected_by", F.concat_ws(",", *map(outside, MEASURES)))
    return judged.select(*COUNTS.replace(" long", "").split(", "), "base_failed",
                         (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"),
                         "lang", "n_tokens", *MEASURES, "rejected_by")
