"""Benchmark passages inside documents by latent semantic retrieval.

Passages of the benchmark are rows of a TF-IDF matrix whose document frequencies come from all
units (16 words) of the corpus. A randomised singular value decomposition of groups of passages,
each group in a task of its own, gives a latent space per group. Every window of every document is
projected into it; windows near a passage by cosine are candidates, and the longest common
subsequence of words with the passage and with its answer decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from mercato.llm.ragged import Powers, blocks, flat, word_hashes
from mercato.llm.tables import attach, stage
from mercato.operators.ordered import row_numbers

UNIT = 16  # words
LONGEST = 64  # words of one passage
GROUP = 256  # passages of one latent space
RANK = 192
OVERSAMPLE = 16
POWER_STEPS = 2
BATCH = 2048  # passages searched for in one pass over the corpus
NEAR = 0.35  # cosine of a candidate
WEIGHT = 0.35  # of a passage's own length that a candidate reaches in its direction
SAME = 0.75  # of a passage's words in order: found
PARAPHRASE = 0.5  # found if the answer is there too
ANSWER = 0.6


def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items cut into passages of at most ``LONGEST`` words of even length."""
    powers = Powers()
    for batch in batches:
        words, counts, _, _ = word_hashes(*flat(batch.column("text")), powers)
        rows, lists = [], []
        for i, one in enumerate(np.split(words, np.cumsum(counts)[:-1])):
            for part in np.array_split(one, -(-len(one) // LONGEST)) if len(one) else []:
                rows.append(i)
                lists.append(part.view(np.int64).tolist())
        yield pa.RecordBatch.from_arrays([batch.column("_item").take(pa.array(rows, pa.int64())), pa.array(lists, pa.list_(pa.int64()))], names=["_item", "words"])


def weighted(lists: list[np.ndarray], words: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows over ``words`` (sorted); the others count nothing."""
    out = np.zeros((len(lists), len(words)), dtype=np.float64)
    for i, w in enumerate(lists):
        at = np.searchsorted(words, w).clip(0, max(0, len(words) - 1))
        ok = words[at] == w
        np.add.at(out[i], at[ok], idf[at[ok]])
    return out


def latent(a: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Leading right singular vectors (columns) by random projection and power steps."""
    size = min(rank + OVERSAMPLE, *a.shape)
    q = np.linalg.qr(a.T @ (a @ np.random.default_rng(seed).standard_normal((a.shape[1], size))))[0]
    for _ in range(POWER_STEPS):
        q = np.linalg.qr(a.T @ (a @ q))[0]
    _, _, v = np.linalg.svd(a @ q, full_matrices=False)
    return (q @ v.T)[:, : min(rank, size)]


def units_of(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts, words per text, unit of each word, and text of each unit."""
    words, counts, _, _ = word_hashes(data, offsets, powers)
    made = -(-counts // UNIT)
    base = np.cumsum(made) - made
    step = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    return words, counts, np.repeat(base, counts) + step // UNIT, np.repeat(np.arange(len(counts)), made)


def common_words(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of ``a``."""
    masks: dict[int, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


class Searcher:
    """Passages of one batch with their latent spaces."""

    def __init__(self, lists: list[np.ndarray], groups: np.ndarray, words: np.ndarray, idf: np.ndarray, spaces: list[np.ndarray]) -> None:
        self.lists, self.words = [w.tolist() for w in lists], words
        self.span = np.array([-(-len(w) // UNIT) + 1 for w in lists])
        # How often each passage has each of its words, by the number of both.
        of = np.repeat(np.arange(len(lists)), [len(w) for w in lists])
        self.pairs, self.times = np.unique(of * len(words) + np.searchsorted(words, np.concatenate(lists)), return_counts=True)
        self.projected, self.rows, self.own, self.size, self.most = [], [], [], [], []
        for g, v in enumerate(spaces):
            mine = np.flatnonzero(groups == g)
            own = weighted([lists[i] for i in mine], words, idf) @ v
            self.projected.append((idf[:, None] * v).astype(np.float32))
            self.rows.append(mine)
            size = np.maximum(np.linalg.norm(own, axis=1), 1e-9)
            self.size.append((WEIGHT * size).astype(np.float32))
            self.own.append((own / size[:, None]).astype(np.float32))
            self.most.append({span: self._most(g, np.flatnonzero(self.span[mine] == span)) for span in sorted(set(self.span[mine].tolist()))})

    def _most(self, g: int, mine: np.ndarray) -> np.ndarray:
        """Per word, the largest part of its least length that it adds to any of these passages.

        Summed over a window it bounds what the window reaches, so a window with less than 1 is near none.
        """
        toward = (self.own[g][mine] / self.size[g][mine, None]).T
        blocks = [(self.projected[g][a : a + 8192] @ toward).max(1, initial=0) for a in range(0, len(self.words), 8192)]
        return np.concatenate(blocks) if blocks else np.zeros(0, np.float32)

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The number of each word among the batch's, -1 for others."""
        at = np.searchsorted(self.words, words).clip(0, len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def candidates(self, words: np.ndarray, unit: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(first unit of the window, passage, cosine) of near windows."""
        return self._near(self.numbers(words), unit, owner)

    def _near(self, at: np.ndarray, unit: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, float]]:
        hit = np.flatnonzero(at >= 0)
        if not len(hit):
            return
        at, where = at[hit], unit[hit]
        after = np.searchsorted(owner, owner, "right") - np.arange(len(owner))  # units from here to the text's end
        for projected, rows, own, least, most in zip(self.projected, self.rows, self.own, self.size, self.most, strict=True):
            if not projected.shape[1]:
                continue
            starts, need = {}, np.zeros(len(owner) + 1, dtype=np.int64)
            for span, of_word in most.items():
                reach = np.concatenate([[0.0], np.cumsum(np.bincount(where, weights=of_word[at], minlength=len(owner)))])
                end = np.arange(len(owner)) + np.minimum(span, after)
                begin = np.flatnonzero(reach[end] - reach[:-1] >= 0.999)
                starts[span] = begin
                np.add.at(need, begin, 1)
                np.add.at(need, end[begin], -1)
            units = np.flatnonzero(np.cumsum(need)[:-1] > 0)
            if not len(units):
                continue
            row = np.full(len(owner), -1)
            row[units] = np.arange(len(units))
            some = np.flatnonzero(row[where] >= 0)
            full, first = np.unique(where[some], return_index=True)
            sums = np.zeros((len(units), projected.shape[1]), dtype=np.float32)
            word, full = at[some], row[full]
            for a in range(0, len(full), 64):  # some units at a time, so that their rows stay in cache
                lo, hi = first[a], first[a + 64] if a + 64 < len(first) else len(word)
                sums[full[a : a + 64]] = np.add.reduceat(projected[word[lo:hi]], first[a : a + 64] - lo, axis=0)
            for span, begin in starts.items():
                if not len(begin):
                    continue
                window = sums[row[begin]]
                for k in range(1, span):
                    ok = np.flatnonzero(after[begin] > k)
                    window[ok] += sums[row[begin[ok] + k]]
                mine = np.flatnonzero(self.span[rows] == span)
                size = np.linalg.norm(window, axis=1)
                cosine = window @ own[mine].T
                for u, j in zip(*np.nonzero((cosine >= least[mine]) & (cosine >= NEAR * np.maximum(size, 1e-6)[:, None])), strict=True):
                    yield int(begin[u]), int(rows[mine[j]]), float(cosine[u, j] / size[u])

    def held(self, passage: np.ndarray, word: np.ndarray) -> np.ndarray:
        key = passage * len(self.words) + word
        at = np.searchsorted(self.pairs, key).clip(0, len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.times[at], 0)

    def possible(self, numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray, ps: np.ndarray) -> list[int]:
        """Which candidates can have enough words in common, whatever their order.

        The words that a window and a passage both hold, as often as both do, bound their longest
        common subsequence from above. Windows are taken some at a time, by their words.
        """
        out: list[int] = []
        sizes = np.array([len(w) for w in self.lists])
        for part in np.array_split(np.arange(len(ps)), -(-int((ends - starts).sum()) // (1 << 18)) or 1):
            n = (ends - starts)[part]
            of = np.repeat(np.arange(len(part)), n)
            at = numbers[np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[part], n)]
            of, at = of[at >= 0], at[at >= 0]
            held = self.held(ps[part][of], at)
            enough = np.bincount(of[held > 0], minlength=len(part)) >= PARAPHRASE * sizes[ps[part]]
            some = np.flatnonzero((held > 0) & enough[of])
            pair, times = np.unique(of[some] * len(self.words) + at[some], return_counts=True)
            of, at = pair // len(self.words), pair % len(self.words)
            both = np.bincount(of, weights=np.minimum(times, self.held(ps[part][of], at)), minlength=len(part))
            out.extend(part[both >= PARAPHRASE * sizes[ps[part]]].tolist())
        return out

    def judged(self, words: np.ndarray, counts: np.ndarray, unit: np.ndarray, owner: np.ndarray) -> dict[tuple[int, int], tuple[float, float]]:
        """(text, passage) -> cosine and share of its words in order, for the ones found."""
        out: dict[tuple[int, int], tuple[float, float]] = {}
        numbers = self.numbers(words)
        found = list(self._near(numbers, unit, owner))
        if not found:
            return out
        begin = np.searchsorted(unit, np.arange(len(owner) + 1))
        base = np.concatenate([[0], np.cumsum(counts)])
        us, ps, cosines = (np.array(x) for x in zip(*found, strict=True))
        texts, last = owner[us], np.minimum(us + self.span[ps], len(owner))
        starts = np.maximum(begin[us] - UNIT // 2, base[texts])
        ends = np.minimum(begin[last] + UNIT // 2, base[texts + 1])
        for i in self.possible(numbers, starts, ends, ps):
            text, p, cosine = int(texts[i]), int(ps[i]), float(cosines[i])
            own = self.lists[p]
            if out.get((text, p), (0, 0))[1] == 1:
                continue
            near = words[starts[i] : ends[i]].tolist()
            share = common_words(own, near) / len(own)
            if share < SAME:
                answer = own[-max(3, len(own) // 4) :]
                if share < PARAPHRASE or common_words(answer, near) < ANSWER * len(answer):
                    continue
            if share > out.get((text, p), (0, -1))[1]:
                out[text, p] = (cosine, share)
        return out


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(key, item, similarity, common) for every document that holds an item's passage.

    A passage (an item, or a part of at most ``LONGEST`` words) is found if a window has a latent
    cosine of at least ``NEAR`` (and enough weight for it to matter) and at least ``SAME`` of its words in order, or ``PARAPHRASE`` of them and
    ``ANSWER`` of its answer, the last quarter. The benchmark is searched for in batches of
    ``BATCH`` passages, one pass over whole texts each. Null and empty texts and items match
    nothing; repeated rows of a key give one row per item, the best; ties don't matter.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).alias("_item"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text")).where(F.col(item).isNotNull())
    cut = items.mapInArrow(passages, items.select("_item").schema.add("words", T.ArrayType(T.LongType())))
    cut = stage(row_numbers(stage(cut, "passages"), [F.col("_item"), F.col("words")], "at"), "passages-numbered")
    total = cut.count()
    slim = docs.select(F.col(key).alias("_id"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    schema = slim.select("_id").schema.add(items.schema["_item"]).add("similarity", "double").add("common", "double")
    found = spark.createDataFrame([], schema)
    for low in range(0, total, BATCH):
        rows = cut.where((F.col("at") > low) & (F.col("at") <= low + BATCH)).orderBy("at").collect()
        found = found.unionByName(_search(slim, rows, schema))
    best = F.max(F.struct("common", "similarity")).alias("b")
    found = found.groupBy("_id", "_item").agg(best)
    return found.select(F.col("_id").alias(key), F.col("_item").alias(item), F.col("b.similarity").alias("similarity"), F.col("b.common").alias("common"))


def _search(slim: DataFrame, rows: list, schema) -> DataFrame:
    spark = slim.sparkSession
    lists = [np.array(r["words"], dtype=np.int64).view(np.uint64) for r in rows]
    words = np.unique(np.concatenate(lists))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """In how many units each word of the batch occurs; the number of units under the last."""
        powers, total = Powers(), np.zeros(len(words) + 1, dtype=np.int64)
        for batch in blocks(batches):
            w, _, unit, owner = units_of(*flat(batch.column("text")), powers)
            at = np.searchsorted(words, w).clip(0, len(words) - 1)
            hit = np.flatnonzero(words[at] == w)
            pair = np.unique(unit[hit] * len(words) + at[hit])
            total[:-1] += np.bincount(pair % len(words), minlength=len(words))
            total[-1] += len(owner)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["word", "n"])

    got = slim.select("text").mapInArrow(frequencies, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(words) + 1)
    df[got.column("word").to_numpy()] = got.column("n").to_numpy()
    units = max(1.0, df[-1])
    # Never 0: a leak that fills much of the table makes its own words common.
    idf = np.log((units + 1) / (df[:-1] + 1)) + 1
    groups = np.arange(len(lists)) // GROUP

    def spaces(table: pa.Table) -> pa.Table:
        mine = int(table.column("g")[0].as_py())
        v = latent(weighted([lists[i] for i in np.flatnonzero(groups == mine)], words, idf), RANK, mine)
        return pa.table({"g": pa.array([mine], pa.int32()), "v": pa.array([v.tobytes()], pa.binary())})

    made = spark.createDataFrame([(int(g),) for g in range(groups[-1] + 1)], "g int").groupBy("g").applyInArrow(spaces, "g int, v binary").orderBy("g").collect()
    searcher = Searcher(lists, groups, words, idf, [np.frombuffer(r["v"]).reshape(len(words), -1) for r in made])
    ids = [r["_item"] for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in blocks(batches):
            hits = searcher.judged(*units_of(*flat(batch.column("text")), powers))
            at = pa.array([t for t, _ in hits], pa.int64())
            made = [pa.array([ids[p] for _, p in hits], pa.int64() if not ids or isinstance(ids[0], int) else None), pa.array([c for c, _ in hits.values()], pa.float64()), pa.array([s for _, s in hits.values()], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("_id").take(at), *made], names=schema.names)

    return slim.mapInArrow(run, schema)


def mark(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """``docs`` with contaminated (boolean), item_ids (array) and the best similarity and common.

    Rows of one key are judged together. A null key is never contaminated.
    """
    added = ("contaminated", "item_ids", "similarity", "common")
    found = find(docs.where(F.col(key).isNotNull()), benchmark, key, text, item)
    hits = found.groupBy(key).agg(F.sort_array(F.collect_set(item)).alias("item_ids"), F.max("similarity").alias("similarity"), F.max("common").alias("common"))
    out = attach(docs.drop(*added), stage(hits, "contaminated"), [key])
    return out.withColumn("contaminated", F.col("item_ids").isNotNull())
