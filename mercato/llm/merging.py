"""Byte-pair merging of many short symbol sequences at once, on flat arrays."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np

NEVER = np.int32(2**31 - 1)
# Longer sequences go through a heap: one merge a round would cost their length squared.
LONG = 400
GONE = -2

Skip = Callable[[np.ndarray, np.ndarray], np.ndarray]


class PairTable:
    """Which two symbols may be joined: (left, right) -> rank and joined symbol.

    An open-addressing table in arrays; ``keys`` are left * 65536 + right.
    """

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, joined: np.ndarray) -> None:
        bits = max(10, int(np.ceil(np.log2(max(1, len(keys)) * 8))))
        self.shift = np.uint32(32 - bits)
        self.mask = np.uint32((1 << bits) - 1)
        self.keys = np.full(1 << bits, 0xFFFFFFFF, dtype=np.uint32)
        self.rank = np.full(1 << bits, NEVER, dtype=np.int32)
        self.join = np.zeros(1 << bits, dtype=np.int32)
        keys = keys.astype(np.uint32)
        left = np.arange(len(keys))
        at = self._slot(keys)
        self.probes = 0
        while len(left):
            self.probes += 1
            free = self.keys[at[left]] == 0xFFFFFFFF
            slots, first = np.unique(at[left][free], return_index=True)
            put = left[free][first]
            self.keys[slots], self.rank[slots], self.join[slots] = keys[put], ranks[put], joined[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + np.uint32(1)) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(0x9E3779B1)) >> self.shift

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NEVER`` if the two can't be joined) and joined symbol of each pair."""
        keys = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        at = self._slot(keys)
        hit = self.keys[at] == keys
        rank, join = np.where(hit, self.rank[at], NEVER), self.join[at]
        open_ = np.flatnonzero(~hit & (self.keys[at] != 0xFFFFFFFF))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + np.uint32(1)) & self.mask
            got = self.keys[at[open_]] == keys[open_]
            found = open_[got]
            rank[found], join[found] = self.rank[at[found]], self.join[at[found]]
            open_ = open_[~got & (self.keys[at[open_]] != 0xFFFFFFFF)]
        return rank, join


def merge_all(
    symbols: np.ndarray, counts: np.ndarray, table: PairTable, spots: np.ndarray | None = None, skip: Skip | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge every sequence to its end; returns symbols, their spots and symbols per sequence.

    Each round takes the lowest-ranked pair of every live sequence (the leftmost of equals, and
    without ``skip`` all its non-overlapping repeats) and joins them all in one array step.
    Sequences without a pair left are put aside. ``spots`` names the place of each symbol
    (default: its index); ``skip(spot of the right symbol, joined symbol)`` says which pairs
    are never joined. Empty sequences are allowed.
    """
    spots = np.arange(len(symbols), dtype=np.int64) if spots is None else spots
    done_s, done_p, done_w = [], [], []
    out = np.zeros(len(counts), dtype=np.int64)

    def found(at: np.ndarray, nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, join = table.find(sym[at], sym[nxt])
        if skip is not None:
            hit = np.flatnonzero(rank != NEVER)
            if len(hit):
                drop = skip(spot[nxt[hit]], join[hit])
                rank[hit[drop]] = NEVER
        return rank, join

    ids = np.flatnonzero(counts)
    sym, spot, size = symbols.astype(np.int32), spots, counts[ids].astype(np.int64)
    if skip is not None and len(ids) and size.max() > LONG:
        ends = np.cumsum(size)
        long_ = np.flatnonzero(size > LONG)
        keep = np.ones(len(sym), dtype=bool)
        for w in long_:
            a, b = int(ends[w] - size[w]), int(ends[w])
            s, p = _by_heap(sym[a:b], spot[a:b], table, skip)
            done_s.append(s), done_p.append(p), done_w.append(np.full(len(s), ids[w]))
            out[ids[w]] = len(s)
            keep[a:b] = False
        sym, spot = sym[keep], spot[keep]
        ids, size = np.delete(ids, long_), np.delete(size, long_)
    rank = np.full(len(sym), NEVER, dtype=np.int32)
    join = np.zeros(len(sym), dtype=np.int32)
    if len(sym):
        last = np.cumsum(size) - 1
        inner = np.ones(len(sym), dtype=bool)
        inner[last] = False
        at = np.flatnonzero(inner)
        rank[at], join[at] = found(at, at + 1)
    word = np.repeat(np.arange(len(ids), dtype=np.int32), size)
    while len(ids):
        begin = np.cumsum(size) - size
        best = np.minimum.reduceat(rank, begin)
        live = best != NEVER
        if not live.all():
            of = live[word]
            rest = ~of
            done_s.append(sym[rest]), done_p.append(spot[rest]), done_w.append(np.repeat(ids[~live], size[~live]))
            out[ids[~live]] = size[~live]
            sym, spot, rank, join = sym[of], spot[of], rank[of], join[of]
            ids, size, best = ids[live], size[live], best[live]
            if not len(ids):
                break
            word = (np.cumsum(live, dtype=np.int32) - np.int32(1))[word[of]]
        at = np.flatnonzero(rank == best[word])
        own = word[at]
        new = np.ones(len(at), dtype=bool)
        if skip is None:  # every second of a run of overlapping repeats
            new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)
            run = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        else:
            new[1:] = own[1:] != own[:-1]
            at = at[new]
        sym[at] = join[at]
        keep = np.ones(len(sym), dtype=bool)
        keep[at + 1] = False
        size = size - (1 if skip is not None else np.bincount(word[at], minlength=len(ids)))
        at = at - np.arange(len(at))  # as many were taken out before it
        sym, spot, rank, join, word = sym[keep], spot[keep], rank[keep], join[keep], word[keep]
        ends = np.append(word, np.int32(-1))
        last = ends[at + 1] != word[at]
        rank[at[last]] = NEVER
        before = at[(at > 0) & (ends[at - 1] == word[at])] - 1
        again = np.concatenate([at[~last], before])
        if skip is None and len(again) > 1:  # repeats that follow each other share a neighbour
            again = np.unique(again)
        if len(again):
            rank[again], join[again] = found(again, again + 1)
    if not done_w:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), out
    words = np.concatenate(done_w)
    order = np.argsort(words, kind="stable")
    return np.concatenate(done_s)[order], np.concatenate(done_p)[order], out


def _by_heap(sym: np.ndarray, spot: np.ndarray, table: PairTable, skip: Skip) -> tuple[np.ndarray, np.ndarray]:
    """The same for one long sequence: an agenda of (rank, place) in a heap."""
    n = len(sym)
    value, prev, nxt = sym.tolist(), list(range(-1, n - 1)), list(range(1, n + 1))
    nxt[-1] = -1
    rank, join = table.find(sym[:-1], sym[1:])
    hit = np.flatnonzero(rank != NEVER)
    hit = hit[~skip(spot[hit + 1], join[hit])]
    agenda = [(int(rank[i]), int(i), value[i], value[i + 1], int(join[i])) for i in hit]
    heapq.heapify(agenda)
    known: dict[tuple[int, int], tuple[int, int]] = {}
    while agenda:
        _, i, a, b, c = heapq.heappop(agenda)
        j = nxt[i]
        if value[i] != a or j < 0 or value[j] != b:
            continue
        value[i], value[j], nxt[i] = c, GONE, nxt[j]
        if nxt[j] >= 0:
            prev[nxt[j]] = i
        for x, y in ((prev[i], i), (i, nxt[i])):
            if x >= 0 and y >= 0:
                pair = (value[x], value[y])
                if pair not in known:
                    r, m = table.find(np.array([pair[0]]), np.array([pair[1]]))
                    known[pair] = (int(r[0]), int(m[0]))
                r, m = known[pair]
                if r != NEVER and not skip(spot[y : y + 1], np.array([m], np.int32))[0]:
                    heapq.heappush(agenda, (r, x, *pair, m))
    left = [i for i in range(n) if value[i] != GONE]
    return np.array([value[i] for i in left], np.int32), spot[left]
