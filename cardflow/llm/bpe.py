"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pretoken exactly one vocabulary token can be the last one of its
encoding.  An automaton over the vocabulary lists the tokens that end at each place; the
one that is compatible with the last token of the prefix before it is stored, and the
ids are read off the back-pointers.  Two adjacent tokens are compatible if BPE over
their joined bytes gives back the two, which only depends on the symbols that met at
their border while they were built.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# White space of the pretokenizer's \s (the Unicode property), and its pattern.
WS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+"
            rf"|[{WS}]+(?![^{WS}])|[{WS}]+")
#: Entries of one generation of a worker's memory; a full one becomes the old one.
MEMO = 250_000


class Memo:
    """A bounded memory of two generations: what is used again outlives a turn."""

    def __init__(self) -> None:
        self.new: dict = {}
        self.old: dict = {}

    def get(self, key):
        """Value of a key that is not in `new`, or None."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= MEMO:
            self.old, self.new = self.new, {}
        self.new[key] = value


def byte_symbols() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for
    the code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def supported(file: dict) -> None:
    """A ValueError for a tokenizer file that asks for more than this encoder does."""
    model, pre, out = file["model"], file.get("pre_tokenizer") or {}, file.get("decoder") or {}
    odd = [name for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk",
                             "byte_fallback", "ignore_merges") if model.get(name)]
    if model.get("type", "BPE") != "BPE" or odd:
        raise ValueError(f"model {model.get('type')} with {', '.join(odd) or 'no settings'} is not supported")
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("only the byte-level pre-tokenizer without a prefix space is supported")
    if file.get("normalizer") or file.get("post_processor") or out.get("type") != "ByteLevel":
        raise ValueError("normalizers, post-processors and decoders but the byte-level one are not supported")
    for t in file.get("added_tokens", []):
        if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {t['content']!r} is matched in a way that is not supported")


class Bpe:
    """Encoder and decoder of one byte-level BPE file of the `tokenizers` library."""

    def __init__(self, file: bytes):
        model = json.loads(file)
        supported(model)
        alphabet = byte_symbols()
        vocab = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.bytes = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for s, i in vocab.items():
            self.bytes[i] = bytes(alphabet[c] for c in s) if all(c in alphabet for c in s) else s.encode()
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.merge: dict[tuple[int, int], int] = {}  # pair to the time of its merge
        self.parts: dict[int, tuple[int, int, int]] = {}  # token to left, right, time
        for time, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.merge[left, right] = time
            self.parts.setdefault(made, (left, right, time))
        self.find = ahocorasick.Automaton()
        for s, i in vocab.items():
            if i in self.parts or len(self.bytes[i]) == 1:
                self.find.add_word(self.bytes[i].decode("latin-1"), (len(self.bytes[i]), i))
        self.find.make_automaton()
        self.coarse = re.compile(rf" ?[^{WS}]+|[{WS}]+(?![^{WS}])|[{WS}]+").findall
        self.fine = regex.compile(PRETOKEN).findall
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.pieces, self.words, self.pairs = Memo(), Memo(), Memo()
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.bytes))]

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE keeps the two apart.  Walks back in time over the symbols that
        met at the border; they are merged if their pair's time comes before either of
        them is merged away (on equal times the leftmost pair goes first)."""
        never = len(self.merge)
        end_left = end_right = never
        while True:
            time = self.merge.get((left, right), never)
            if time < end_left and time <= end_right and time != never:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[2] > b[2]):
                left, end_left = a[1], a[2]
            else:
                right, end_right = b[0], b[2]

    def pretoken(self, word: str) -> bytes:
        """Ids of one pretoken by the table of last tokens."""
        ids = self.words.new.get(word) or self.words.get(word)
        if ids is not None:
            return ids
        raw = word.encode()
        last, before, done = [0] * (len(raw) + 1), [-1] * (len(raw) + 1), 0  # by prefix length
        pairs = self.pairs.new
        for end, (size, token) in self.find.iter(raw.decode("latin-1")):  # per end, the longest first
            end += 1
            if end == done:
                continue
            start = end - size
            if start:
                if before[start] < 0:
                    continue
                key = last[start] << 20 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = self.pairs.get(key)
                    if fits is None:
                        fits = self.compatible(last[start], token)
                        self.pairs.put(key, fits)
                    pairs = self.pairs.new
                if not fits:
                    continue
            last[end] = token
            before[end] = start
            done = end
        end, ids = len(raw), []
        while end > 0:
            if before[end] < 0:
                raise ValueError("the vocabulary cannot spell the text")
            ids.append(self.packed[last[end]])
            end = before[end]
        ids.reverse()
        out = b"".join(ids)
        if len(raw) <= 64:
            self.words.put(word, out)
        return out

    def piece(self, text: str) -> bytes:
        if text.isalpha() or text[0] == " " and text[1:].isalpha():
            return self.pretoken(text)
        return b"".join([self.pretoken(w) for w in self.fine(text)])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        out: list[bytes] = []
        for part in self.split(text) if self.split else [text]:
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            known = self.pieces.new
            for chunk in self.coarse(part):
                ids = known.get(chunk)
                if ids is None:
                    ids = self.pieces.get(chunk)
                    if ids is None:
                        ids = self.piece(chunk)
                        if len(chunk) <= 64:
                            self.pieces.put(chunk, ids)
                    known = self.pieces.new
                out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        table = self.bytes
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_built: dict[str, Bpe] = {}


def built(key: str, file) -> Bpe:
    """One encoder per worker process."""
    if key not in _built:
        _built.clear()
        _built[key] = Bpe(file())
    return _built[key]


def texts(column: pa.Array) -> Iterator[str]:
    for v in column.cast(pa.large_binary()):
        yield "" if not v.is_valid else v.as_py().decode("utf-8", "replace")


def bpe_round_trip(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256 and, with
    `with_ids`, the ids (array<int>) and the decoded text.

    The file at `tokenizer_path` is read by the driver and sent to the workers (its size
    does not depend on the data).  A null or empty text has no ids.  Strings of added
    tokens in a text become their ids, as the tokenizer's own default.  Very long texts
    are encoded whole, in time that grows with their length.  Repeated rows give equal
    results; only the two named columns are read.  An empty table gives an empty result.
    """
    with open(tokenizer_path, "rb") as f:
        file = f.read()
    key, shared = hashlib.sha256(file).hexdigest(), df.sparkSession.sparkContext.broadcast(file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = built(key, lambda: shared.value)
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for text in texts(batch.column(1)):
                ids = bpe.encode(text)
                back = bpe.decode(ids)
                row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
                if with_ids:
                    row += (np.frombuffer(ids, "<i4"), back)
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string())
            names = ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")
            used = 5 if with_ids else 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols[:used], kinds)]], names=["doc_id", *names[:used]])

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(run, schema + (", ids array<int>, decoded string" if with_ids else ""))
