"""Fill-in-middle: a text is cut at two unit borders and its middle is told last.

The borders are found on a wavelet matrix over classes of the bytes of a block of texts: a rank
query per class counts what lies before a place, the ranks of a unit's classes are added up to
boundary counts, and the k-th border of a text is found by bisection on these counts, for all
cuts of a block at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm.ragged import SPACE, blocks, flat

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# Classes of a byte: inside a word or a blank, line feed, first byte of a word, continuation of a code point.
INNER, FEED, OPENS, CONTINUES = range(4)
CLASS_BITS = 2


@dataclass(frozen=True)
class Unit:
    """What a text is cut into: units that end with, or begin with, a byte of certain classes."""

    classes: tuple[int, ...]
    closing: bool


UNITS = {
    "line": Unit((FEED,), True),
    "word": Unit((OPENS,), False),
    "char": Unit((INNER, FEED, OPENS), False),
}


def byte_classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    solid = ~SPACE[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[first] = solid[first]
    out = np.where(opens, np.uint8(OPENS), np.uint8(INNER))
    out[data == 10] = FEED
    out[(data & 0xC0) == 0x80] = CONTINUES
    return out


class WaveletMatrix:
    """Rank of any class before any place, from one plane of packed bits per bit of the class."""

    def __init__(self, classes: np.ndarray, bits: int = CLASS_BITS) -> None:
        self.planes: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.bits = bits
        for b in reversed(range(bits)):
            plane = (classes >> b) & 1
            packed = np.packbits(plane, bitorder="little")
            words = np.zeros(len(plane) // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.zeros(len(words), dtype=np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=ones[1:])
            self.planes.append((words, ones, len(plane) - int(plane.sum())))
            classes = np.concatenate([classes[plane == 0], classes[plane == 1]])

    @staticmethod
    def _ones(words: np.ndarray, ones: np.ndarray, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return ones[word] + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def rank(self, kind: int, at: np.ndarray) -> np.ndarray:
        """How many bytes of class ``kind`` lie before each place."""
        low, high = np.zeros(1, dtype=np.int64), np.asarray(at, dtype=np.int64)
        for b, (words, ones, zeros) in zip(reversed(range(self.bits)), self.planes, strict=True):
            before, upto = self._ones(words, ones, low), self._ones(words, ones, high)
            low, high = (zeros + before, zeros + upto) if kind >> b & 1 else (low - before, high - upto)
        return high - low

    def bounds(self, kinds: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """Boundary counts: the ranks of all classes that make a border."""
        return sum(self.rank(kind, at) for kind in kinds)

    def locate(self, kinds: tuple[int, ...], start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Least place in [start, end] with at least ``k`` borders between start and it, by bisection.

        ``end`` where there are fewer.
        """
        base, low, high = self.bounds(kinds, start) + k, start.copy(), end.copy()
        while (open_ := low < high).any():
            half = (low + high) >> 1
            enough = self.bounds(kinds, half) >= base
            high = np.where(open_ & enough, half, high)
            low = np.where(open_ & ~enough, half + 1, low)
        return low


def unit_counts(matrix: WaveletMatrix, unit: Unit, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = np.diff(matrix.bounds(unit.classes, offsets))
    if unit.closing:  # what follows the last border is a unit too
        full = np.flatnonzero(offsets[:-1] < offsets[1:])
        last = matrix.bounds(unit.classes, offsets[full + 1]) - matrix.bounds(unit.classes, offsets[full + 1] - 1)
        n[full] += last == 0
    return n


def cut_places(matrix: WaveletMatrix, unit: Unit, start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Where each text's first ``k`` units end."""
    if unit.closing:
        return matrix.locate(unit.classes, start, end, k)
    found = matrix.locate(unit.classes, start, end, k + 1)
    reached = matrix.bounds(unit.classes, found) - matrix.bounds(unit.classes, start) > k
    return np.where(k == 0, start, np.where(reached, found - 1, end))


def draws(key: str, seed: int) -> list[Column]:
    """Four numbers of 32 bits per row, from the hash of the seed and the key (null: no digits)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"_h{i + 1}") for i in range(4)]


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "line", rate: int = 100, spm: int = 50, seed: int = 7
) -> DataFrame:
    """One row per row: key, n, form, prefix_chars, middle_chars, output.

    The whole text has n units. Its prefix ends after the smaller and its middle after the larger
    of two numbers drawn from 0 to n by the hash of seed and key. ``rate`` percent of the texts are
    turned, ``spm`` percent of those with the suffix first. Form is ``plain`` (output is the
    text, no lengths) for the others, for empty and null texts, and where a sentinel is part of the
    text, because the output could not be read back. Rows with equal keys are cut by the same
    draws; a null key draws like an empty one. Other columns are not read.
    """
    kind = UNITS[unit]
    slim = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *draws(key, seed))
    key_type = docs.schema[key].dataType.simpleString()
    sentinels = [s.encode() for s in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = sentinels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            data, offsets = flat(batch.column("text"))
            h1, h2, h3, h4 = (batch.column(f"_h{i}").to_numpy() for i in range(1, 5))
            matrix = WaveletMatrix(byte_classes(data, offsets))
            n = unit_counts(matrix, kind, data, offsets)
            a, b = h1 % (n + 1), h2 % (n + 1)
            start, end = offsets[:-1], offsets[1:]
            first = cut_places(matrix, kind, start, end, np.minimum(a, b))
            second = cut_places(matrix, kind, start, end, np.maximum(a, b))
            chars = lambda x, y: y - x - matrix.rank(CONTINUES, y) + matrix.rank(CONTINUES, x)
            raw = data.tobytes()
            forms, out = [], []
            turned = (h3 % 100 < rate) & (start < end)
            for i, (x, c, d, y) in enumerate(zip(start.tolist(), first.tolist(), second.tolist(), end.tolist(), strict=True)):
                whole = raw[x:y]
                if not turned[i] or any(t in whole for t in sentinels):
                    forms.append("plain")
                    out.append(whole)
                elif h4[i] % 100 < spm:
                    forms.append("spm")
                    out.append(b"".join((s, raw[d:y], p, raw[x:c], m, raw[c:d])))
                else:
                    forms.append("psm")
                    out.append(b"".join((p, raw[x:c], s, raw[d:y], m, raw[c:d])))
            plain = np.array([f == "plain" for f in forms], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"),
                    pa.array(n, pa.int64()),
                    pa.array(forms, pa.string()),
                    pa.array(chars(start, first), pa.int64(), mask=plain),
                    pa.array(chars(first, second), pa.int64(), mask=plain),
                    pa.array(out, pa.binary()).view(pa.string()),
                ],
                names=["_key", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    made = slim.mapInArrow(run, f"_key {key_type}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("_key", key)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of."""
    told = F.col(output)
    psm = F.split(F.expr(f"substr({output}, {len(PREFIX) + 1})"), f"{SUFFIX}|{MIDDLE}", 3)
    spm = F.split(F.expr(f"substr({output}, {len(SUFFIX) + 1})"), f"{PREFIX}|{MIDDLE}", 3)
    return (
        F.when(F.col(form) == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(F.col(form) == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(told)
    )
