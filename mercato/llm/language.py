"""Language of a text by error-correcting output codes over byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm.ragged import LOWER, blocks, flat

PAIRS, TRIPLES = 1 << 16, 1 << 15
FEATURES = PAIRS + TRIPLES
MAX_LANGUAGES = 1024
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature of every byte pair and triple inside a text, their text, and the number per text."""
    low = LOWER[data].astype(np.uint32)
    of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    n = len(low)
    two = (low[:-1] << np.uint32(8)) | low[1:] if n > 1 else low[:0]
    ok2 = of[:-1] == of[1:] if n > 1 else np.zeros(0, bool)
    three = (((two[:-1] << np.uint32(8)) | low[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(17) if n > 2 else low[:0]
    ok3 = of[:-2] == of[2:] if n > 2 else np.zeros(0, bool)
    index = np.concatenate([two[ok2], three[ok3] + np.uint32(PAIRS)]).astype(np.int32)
    owner = np.concatenate([of[:-1][ok2], of[:-2][ok3]]) if n > 2 else of[:-1][ok2] if n > 1 else of[:0]
    return index, owner, np.bincount(owner, minlength=len(offsets) - 1)


def codewords(classes: int, seed: int = 11) -> np.ndarray:
    """A row of -1/+1 per class. Up to 6 classes all distinct splits, beyond that random ones.

    Random codes have 10 bits per doubling of the classes, 15 at least; the one of 200 draws with
    the largest least distance between two rows is taken.
    """
    if classes < 2:
        return np.ones((classes, 1), dtype=np.int8)
    if classes <= 6:
        splits = range(1, 1 << (classes - 1))
        return np.array([[1 if c == 0 or not s >> (c - 1) & 1 else -1 for s in splits] for c in range(classes)], dtype=np.int8)
    bits = max(15, int(np.ceil(10 * np.log2(classes))))
    rng = np.random.default_rng(seed)
    best, least = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(classes, bits))
        code[:, np.abs(code.sum(0)) == classes] *= np.where(np.arange(classes) % 2, 1, -1)[:, None].astype(np.int8)
        apart = bits - code.astype(np.int32) @ code.T.astype(np.int32)
        np.fill_diagonal(apart, 2 * bits)
        if apart.min() > least:
            best, least = code, apart.min()
    return best


class Model:
    """One binary classifier per bit, its scale, its weight in decoding, and the codewords."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        self.code = codewords(len(languages))
        bits = self.code.shape[1]
        self.weights = np.zeros((FEATURES, bits), dtype=np.float32)
        self.middle, self.half, self.trust = np.zeros(bits), np.ones(bits), np.ones(bits)
        # Each language counts equally, however many texts it has.
        share = counts / np.maximum(counts.sum(1, keepdims=True), 1)
        for b in range(bits):
            yes, no = self.code[:, b] > 0, self.code[:, b] < 0
            if not no.any():
                continue
            floor = 1e-6
            self.weights[:, b] = np.log(share[yes].mean(0) + floor) - np.log(share[no].mean(0) + floor)
            mean = share @ self.weights[:, b]
            low, high = mean[yes].min(), mean[no].max()
            self.middle[b], self.half[b] = (low + high) / 2, max((low - high) / 2, 1e-3)
        self.trust = self.half / self.half.sum()

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword by weighted exponential loss, its share of belief, lead over the next."""
        z = np.clip((margins - self.middle) / self.half, -4, 4)
        loss = np.exp(-z[:, None, :] * self.code[None]) @ self.trust
        near = loss.argmin(1)
        belief = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        belief /= belief.sum(1, keepdims=True)
        ordered = np.sort(belief, axis=1)
        lead = ordered[:, -1] - ordered[:, -2] if len(self.languages) > 1 else ordered[:, -1]
        return near, belief[np.arange(len(near)), near], lead


def fit(docs: DataFrame, train: Column, text: str = "text", lang: str = "lang") -> Model:
    """Learn from every row where ``train`` holds and text and language are not null.

    One pass over all of them: n-gram counts by language, summed before the shuffle. The
    driver gets one number per language and feature, both bounded by parameters.
    """
    rows = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in blocks(batches, 1 << 18):
            names = batch.column("lang").to_pylist()
            known = sorted(set(names))
            place = {n: i for i, n in enumerate(known)}
            index, owner, _ = features(*flat(batch.column("text")))
            of = np.array([place[n] for n in names], dtype=np.int64)
            got = np.bincount(of[owner] * FEATURES + index, minlength=len(known) * FEATURES).reshape(-1, FEATURES)
            for i, n in enumerate(known):
                total[n] = total[n] + got[i] if n in total else got[i]
            if len(total) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for n, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["lang", "feature", "n"])

    summed = rows.mapInArrow(run, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    got = summed.groupBy("lang").agg(F.collect_list(F.struct("feature", "n")).alias("f")).select(
        "lang", F.col("f.feature").alias("feature"), F.col("f.n").alias("n")
    ).toArrow()
    languages = sorted(got.column("lang").to_pylist())
    counts = np.zeros((len(languages), FEATURES))
    for name, feature, n in zip(got.column("lang").to_pylist(), got.column("feature").to_pylist(), got.column("n").to_pylist(), strict=True):
        counts[languages.index(name), feature] = n
    return Model(languages, counts)


def predict(docs: DataFrame, model: Model, text: str = "text", least_lead: float = 0.2) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and ambiguous, from every whole text.

    Null texts and texts without a letter are ``und`` with score 0 and not ambiguous; so is
    everything if no language was learned. A text is ambiguous if its codeword leads the next
    by less than ``least_lead``. Equal texts get equal answers; other columns pass through
    (columns of the three names are replaced).
    """
    added = ("lang_pred", "score", "ambiguous")
    kept = [c for c in docs.columns if c not in added]
    slim = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = slim.drop("_text").schema.add("lang_pred", "string", False).add("score", "double", False).add("ambiguous", "boolean", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ascii_letter = np.zeros(256, dtype=np.int64)
        ascii_letter[[*range(65, 91), *range(97, 123)]] = 1
        for batch in blocks(batches, 1 << 18, "_text"):
            data, offsets = flat(batch.column("_text"))
            n = batch.num_rows
            seen = np.concatenate([[0], np.cumsum(ascii_letter[data])])
            plain = seen[offsets[1:]] > seen[offsets[:-1]]
            for i in np.flatnonzero(~plain & (np.diff(offsets) > 0)):
                plain[i] = LETTER.search(batch.column("_text")[int(i)].as_py()) is not None
            name, score, unsure = np.full(n, UNKNOWN, dtype=object), np.zeros(n), np.zeros(n, bool)
            if model.languages:
                index, owner, size = features(data, offsets)
                order = np.argsort(owner, kind="stable")
                margins = np.zeros((n, model.code.shape[1]))
                full = np.flatnonzero(size)
                if len(full):
                    begin = (np.cumsum(size) - size)[full]
                    margins[full] = np.add.reduceat(model.weights[index[order]], begin, axis=0, dtype=np.float64) / size[full, None]
                near, belief, lead = model.decode(margins)
                name[plain] = np.array(model.languages, dtype=object)[near[plain]]
                score[plain], unsure[plain] = belief[plain], lead[plain] < least_lead
            made = [pa.array(name.tolist(), pa.string()), pa.array(score), pa.array(unsure)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, *added])

    return slim.mapInArrow(run, schema)
