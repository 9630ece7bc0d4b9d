"""Token counts of a word-ending byte-pair vocabulary by rank-synchronous array merging."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from mercato.llm.merging import PairTable, merge_all
from mercato.llm.ragged import Powers, Rolling, blocks

# The classes of the split pattern, and the endings that split off a word.
LETTER, DIGIT, OTHER, BLANK = 1, 2, 3, 0
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


class Vocabulary:
    """What counting needs of a tokenizer file: byte symbols, merges, special strings."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"]
        shown = _shown_bytes()
        self.inner = np.array([ids[c] for c in shown], dtype=np.int32)
        self.final = np.array([ids[c + suffix] for c in shown], dtype=np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.keys = np.array([ids[a] * 65536 + ids[b] for a, b in pairs], dtype=np.uint32)
        self.joined = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
        self.classes = _classes()
        self.special = [t["content"] for t in spec["added_tokens"]]


def _shown_bytes() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b], extra = chr(extra), extra + 1
    return [out[b] for b in range(256)]


def _classes() -> np.ndarray:
    """Class of every code point: letter, digit, other or blank, by the library's own tables."""
    from tokenizers import Regex, pre_tokenizers

    out = np.full(0x110000, OTHER, dtype=np.uint8)
    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000])
    text = "".join(map(chr, points))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (BLANK, r"\s+")):
        for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(text):
            out[points[a:b]] = kind
    return out


def normal(text: str) -> str:
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ")  # the vocabulary's tables know no final sigma
    return text.lower()


def split_words(points: np.ndarray, owner_edge: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each pre-token in code points; ``owner_edge`` marks where texts begin."""
    n = len(points)
    kind = classes[points]
    cut = np.ones(n + 1, dtype=bool)
    cut[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT) | owner_edge[1:n]
    quote = np.flatnonzero((points == 39) & cut[:n] & cut[1:])
    quote = quote[quote + 1 < n]
    quote = quote[~owner_edge[quote + 1] & (kind[quote + 1] == LETTER)]
    taken = np.zeros(n + 1, dtype=bool)
    for ending in ENDINGS:
        k = len(ending)
        at = quote[quote + k < n]
        ok = np.ones(len(at), dtype=bool)
        for j, c in enumerate(ending):
            ok &= points[at + 1 + j] == ord(c)
            if j:
                ok &= ~owner_edge[at + 1 + j]
        at = at[ok & ~taken[at]]
        taken[at] = True
        cut[at + 1] = False
        cut[at + 1 + k] = True
    starts = np.flatnonzero(cut[:n])
    ends = np.append(starts[1:], n) if len(starts) else starts
    solid = kind[starts] != BLANK if len(starts) else np.zeros(0, bool)
    return starts[solid], ends[solid]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, text: str = "text", special: bool = True) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every whole text.

    Null and empty texts have 0 tokens. With ``special`` a special string inside a text is one
    token, as the library does by default. Rows are independent: repeated rows and ties get
    equal counts, other columns pass through (columns of the three names are replaced).
    """
    words = Vocabulary(vocabulary)
    names = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    slim = docs.select(*names, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kept = [c for c in names if c != text]
    slim = slim.select(*kept, "_text")
    schema = slim.drop("_text").schema.add("n_bytes", "long", False).add("n_tokens", "long", False).add("over_limit", "boolean", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PairTable(words.keys, np.arange(len(words.keys), dtype=np.int32), words.joined)
        powers = Powers()
        marks = regex.compile("|".join(map(regex.escape, words.special))) if special and words.special else None
        for batch in blocks(batches, 1 << 20, "_text"):
            texts = batch.column("_text").to_pylist()
            tokens = counts_of(texts, words, table, powers, marks)
            size = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            added = [pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *added], names=[*kept, "n_bytes", "n_tokens", "over_limit"])

    return slim.mapInArrow(run, schema)


def counts_of(texts: list[str], words: Vocabulary, table: PairTable, powers: Powers, marks) -> np.ndarray:
    extra = np.zeros(len(texts), dtype=np.int64)
    parts, owner = [], []
    for i, t in enumerate(texts):
        if marks is not None and marks.search(t):
            bits = marks.split(t)
            extra[i] = len(bits) - 1
        else:
            bits = (t,)
        for bit in bits:
            if bit:
                parts.append(normal(bit))
                owner.append(i)
    if not parts:
        return extra
    whole = "".join(parts)
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    begin = np.cumsum([0, *map(len, parts)])
    edge = np.zeros(len(points) + 1, dtype=bool)
    edge[begin[:-1]] = True
    starts, ends = split_words(points, edge, words.classes)
    if not len(starts):
        return extra
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    at = np.concatenate([[0], np.cumsum(width)])
    data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    first, last = at[starts], at[ends]
    # Equal pre-tokens of a block are merged once.
    _, one, back = np.unique(Rolling(data, powers).of(first, last), return_index=True, return_inverse=True)
    first, last = first[one], last[one]
    size = last - first
    place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    symbols = words.inner[data[place]]
    tail = np.cumsum(size) - 1
    symbols[tail] = words.final[data[place[tail]]]
    _, _, made = merge_all(symbols, size, table)
    doc = np.asarray(owner)[np.searchsorted(begin, starts, "right") - 1]
    return extra + np.bincount(doc, weights=made[back], minlength=len(texts)).astype(np.int64)
