"""Texts of an Arrow batch as one array of bytes with offsets, and hashes over it.

Everything is done for a whole block of texts at once: a block holds at most ``BLOCK`` bytes,
or one text if that is longer, so the arrays stay bounded whatever a batch holds.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``size`` bytes of text; small batches are put together."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + max(1, size - total), "right")) - 1
            last = min(max(last, first + (not held)), batch.num_rows)
            if last > first:
                held.append(batch.slice(first, last - first))
                total += int(offsets[last] - offsets[first])
                first = last
            if first < batch.num_rows or total >= size:
                yield joined(held)
                held, total = [], 0
    if held:
        yield joined(held)
    give_back()


def give_back() -> None:
    """Return what the task's arrays have freed to the system, because workers live on."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it likes
        pass


def lean(function: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same grouped function; what its arrays took goes back to the system after every group."""

    def run(table: pa.Table) -> pa.Table:
        out = function(table)
        del table
        give_back()
        return out

    return run


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values one after the other, and where each begins; null is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null("" if "string" in str(column.type) else b"")
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, dtype=kind, count=column.offset + n + 1)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse, made once for a task and grown when needed."""

    def __init__(self) -> None:
        self.up = self.back = np.ones(1, dtype=np.uint64)

    def take(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK + 1)
            up, back = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
            up[0] = back[0] = 1
            self.up, self.back = np.multiply.accumulate(up), np.multiply.accumulate(back)
        return self.up[:n], self.back[:n]


class Rolling:
    """Hash of any byte range of a block in constant time."""

    def __init__(self, data: np.ndarray, powers: Powers) -> None:
        n = len(data)
        up, self.back = powers.take(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        value = data.astype(np.uint64)
        value += np.uint64(1)
        value *= up[:n]
        np.cumsum(value, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and how many words each text has."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:n]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of every word with A-Z lower-cased, words per text, starts and ends."""
    starts, ends, counts = word_spans(data, offsets)
    return Rolling(LOWER[data], powers).of(starts, ends), counts, starts, ends


def shingles(words: np.ndarray, counts: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-word hashes of each text, and how many each has.

    A text of fewer words has one hash for the whole sequence, a text without words none.
    """
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    made = np.maximum(counts - n + 1, 0)
    owner = np.repeat(np.arange(len(counts)), made)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) + np.repeat(first, made)
    value = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        value = (value + words[at + k]) * BASE if len(at) else value
    value = mix(value)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for k in range(n - 1):
            more = counts[short] > k
            whole[more] = (whole[more] + words[first[short[more]] + k]) * INVERSE
        whole = mix(whole + counts[short].astype(np.uint64))
        owner, value = np.concatenate([owner, short]), np.concatenate([value, whole])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(owner[new], minlength=len(counts)).astype(np.int64)


def pieces_of(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum(counts)[:-1]) if len(counts) else []


def binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes() for x in parts], pa.binary())
