"""Toxic text by compression distance: which of two dictionaries shortens its windows more.

A text is rewritten before compression: each word becomes a fixed-width code, so a dictionary
match saves whole words, however long they are, and no parts of words. Windows
are runs of codes. The ordinary dictionary is trained on windows of ordinary texts; the toxic
one is the same with a lexicon behind it: the bare codes of the words that toxic texts hold
significantly more often. What is compressed is codes, not text, so a text without such words
has no signal. A window's distance is the ordinary minus the
toxic compressed length; thresholds on it are calibrated to the labels.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm.ragged import LOWER, Powers, Rolling, blocks, flat, mix
from mercato.llm.tables import attach, stage

WINDOW = 8
# Bounds of the sample a model is fitted on.
SAMPLE_DOCS = 12_000
SAMPLE_WINDOWS = 6_000
CONTRAST_WORDS = 600

# Code points of scripts written without spaces between words.
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]


class Kinds:
    """Of every code point: 1 in a word (letters, marks, digits), 2 a word with the next one of its kind, 0 a break.

    Kind 2 is letters of unspaced scripts, and what else beyond ASCII is neither punctuation nor space.
    Blocks of 256 are looked up when a text first has one.
    """

    def __init__(self) -> None:
        self.kind, self.known = np.zeros(0x110000, dtype=np.uint8), np.zeros(0x1100, dtype=bool)

    def of(self, codes: np.ndarray) -> np.ndarray:
        used = np.flatnonzero(np.bincount(codes >> 8, minlength=len(self.known)))
        for block in used[~self.known[used]].tolist():
            for c in range(block << 8, (block + 1) << 8):
                major = unicodedata.category(chr(c))[0]
                if major in "LMN":
                    self.kind[c] = 2 if any(low <= c <= high for low, high in UNSPACED) else 1
                elif major in "SC" and c >= 160:
                    self.kind[c] = 2
            self.known[block] = True
        return self.kind[codes]


# Made once per task and worker, by ``kinds_of``.
KINDS: list[Kinds] = []


def kinds_of(codes: np.ndarray) -> np.ndarray:
    if not KINDS:
        KINDS.append(Kinds())
    return KINDS[0].of(codes)


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of the characters that begin at the places; what is not UTF-8 is U+FFFD."""
    byte = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
    b, c, d, e = (byte[at + k] for k in range(4))
    c, d, e = c & 63, d & 63, e & 63
    four = (b & 7) << 18 | c << 12 | d << 6 | e
    out = np.select([b < 0x80, b < 0xC0, b < 0xE0, b < 0xF0], [b, 0xFFFD, (b & 31) << 6 | c, (b & 15) << 12 | d | c << 6], four)
    return np.where(out < 0x110000, out, 0xFFFD)


def wide(codes: np.ndarray) -> bytes:
    """16 bytes a word, so that a match pays in a window that holds nothing else known."""
    return np.stack([codes, mix(codes ^ np.uint64(0xA0761D6478BD642F))], 1).tobytes()


def codes_of(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit code of each whole word, words per text.

    Unspaced scripts and symbols give overlapping pairs of characters, so that all of them count.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    first = (data & 0xC0) != 0x80
    first[offsets[offsets < n]] = True
    at = np.flatnonzero(first)
    kind = kinds_of(code_points(data, at))
    # Whether a character goes on with the kind of the one before, in the same text.
    on = np.zeros(len(at) + 1, dtype=bool)
    on[1:-1] = kind[1:] == kind[:-1]
    on[np.searchsorted(at, offsets)] = False
    word, pair = kind == 1, kind == 2
    last = np.arange(len(at))
    last[word & ~on[:-1]] = np.flatnonzero(word & ~on[1:])
    last[pair & on[1:]] += 1
    begin = np.flatnonzero((word & ~on[:-1]) | (pair & (on[1:] | ~on[:-1])))
    starts, ends = at[begin], np.append(at, n)[last[begin] + 1]
    counts = np.diff(np.searchsorted(starts, offsets))
    return Rolling(LOWER[data], powers).of(starts, ends), counts


def windows_of(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end word of each window of each text, and its text."""
    made = -(-counts // size)
    owner = np.repeat(np.arange(len(counts)), made)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made)
    base = np.cumsum(counts) - counts
    first = base[owner] + step * size
    return first, np.minimum(first + size, (base + counts)[owner]), owner


class Lengths:
    """Compressed length of many windows at once under one dictionary."""

    def __init__(self, content: bytes) -> None:
        import zstandard

        self.z = zstandard
        options = {"write_checksum": 0, "write_content_size": 0, "write_dict_id": 0, "format": zstandard.FORMAT_ZSTD1_MAGICLESS}
        params = zstandard.ZstdCompressionParameters.from_level(3, **options)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params)

    def of(self, data: bytes, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Lengths of the byte ranges."""
        segments = np.stack([first, end - first], 1).astype(np.uint64)
        buffer = self.z.BufferWithSegments(data, segments.tobytes())
        return np.fromiter(map(len, self.compressor.multi_compress_to_buffer(buffer, threads=1)), dtype=np.int64, count=len(first))


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    steps: np.ndarray  # distances
    chance: np.ndarray  # calibrated chance at each of them

    def chance_of(self, distance: np.ndarray) -> np.ndarray:
        return np.interp(distance, self.steps, self.chance)


def distances(texts: pa.Array, ordinary: Lengths, toxic: Lengths, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Summed positive distances of the windows of each text, and its number of windows."""
    codes, counts = codes_of(*flat(texts), powers)
    first, end, owner = windows_of(counts, WINDOW)
    if not len(first):
        return np.zeros(len(counts)), np.zeros(len(counts), np.int64)
    data = wide(codes)
    gap = ordinary.of(data, first * 16, end * 16) - toxic.of(data, first * 16, end * 16)
    total = np.bincount(owner, weights=np.maximum(gap, 0), minlength=len(counts))
    return total, np.bincount(owner, minlength=len(counts))


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on the samples; too few to train on are taken as they are."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def fit(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """Fit on the labelled rows where ``train`` holds on the key.

    The dictionaries come from a bounded sample: at most ``SAMPLE_DOCS`` rows of each label with
    the smallest hashes of their key; their whole texts are used. The contrast of words is counted
    by Spark over all of the sample; at most ``CONTRAST_WORDS`` words and ``SAMPLE_WINDOWS``
    windows of each kind come to the driver, which trains the two dictionaries. Thresholds come
    from all labelled rows, so they don't depend on the sample's mix of labels. A key with both
    labels counts as toxic. None if one of the two labels is missing.
    """
    marked = labels.where(train & F.col(key).isNotNull() & F.col(label).isNotNull())
    marked = marked.groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label).cast("int")).alias("_label"))
    marked = stage(marked, "toxic-labels")
    order = F.xxhash64("_key"), F.col("_key")
    picked = [marked.where(F.col("_label") == v).orderBy(*order).limit(SAMPLE_DOCS) for v in (1, 0)]
    picked = stage(picked[0].unionByName(picked[1]), "toxic-keys")  # bounded, so it may be broadcast
    slim = docs.where(train & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    sample = stage(slim.join(F.broadcast(picked), "_key"), "toxic-sample")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct codes of each text with the counts of texts of either label."""
        powers = Powers()
        for batch in blocks(batches, text="_text"):
            codes, counts = codes_of(*flat(batch.column("_text")), powers)
            owner = np.repeat(np.arange(batch.num_rows), counts)
            order = np.lexsort((owner, codes))
            codes, owner = codes[order], owner[order]
            new = np.ones(len(codes), dtype=bool)
            new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
            codes, bad = codes[new], batch.column("_label").to_numpy(zero_copy_only=False)[owner[new]] == 1
            value, at = np.unique(codes, return_inverse=True)
            made = [value.view(np.int64), np.bincount(at, weights=bad, minlength=len(value)).astype(np.int64), np.bincount(at, weights=~bad, minlength=len(value)).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["code", "bad", "fine"])

    size = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return None
    n1, n0 = size[1], size[0]
    counted = sample.mapInArrow(words, "code long, bad long, fine long").groupBy("code").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))
    rate = (F.col("bad") + F.col("fine")) / (n1 + n0)
    z = (F.col("bad") - n1 * rate) / F.sqrt(n1 * rate * (1 - rate) * n0 / (n1 + n0) + 1e-9)
    strong = counted.where((F.col("bad") >= 3) & (F.col("bad") * n0 > 4 * F.col("fine") * n1)).withColumn("z", z).where("z >= 4")
    contrast = np.array([r["code"] for r in strong.orderBy(F.desc("z"), "code").limit(CONTRAST_WORDS).collect()], dtype=np.int64).view(np.uint64)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        known = np.sort(contrast)
        for batch in blocks(batches, text="_text"):
            codes, counts = codes_of(*flat(batch.column("_text")), powers)
            bad = np.repeat(batch.column("_label").to_numpy(zero_copy_only=False) == 1, counts)
            hit = np.flatnonzero(bad & (known[np.searchsorted(known, codes).clip(0, max(0, len(known) - 1))] == codes)) if len(known) and len(codes) else np.zeros(0, int)
            first, end, owner = windows_of(counts, WINDOW)
            fine = np.flatnonzero(~bad[first]) if len(first) else first
            raw = wide(codes)
            made = [raw[16 * i : 16 * i + 16] for i in hit] + [raw[16 * first[i] : 16 * end[i]] for i in fine]
            text = np.repeat(np.arange(batch.num_rows), counts)
            of = np.concatenate([text[hit], owner[fine]]).astype(np.int64)
            place = np.concatenate([hit, first[fine]]) - (np.cumsum(counts) - counts)[of]
            kind = pa.array([1] * len(hit) + [0] * len(fine), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("_key").take(pa.array(of)), pa.array(place, pa.int64()), pa.array(made, pa.binary()), kind], names=["_key", "_place", "window", "bad"])

    # Chosen by key and place in the text, however the rows are partitioned.
    placed = sample.select("_key").schema.add("_place", "long").add("window", "binary").add("bad", "integer")
    cut = sample.mapInArrow(windows, placed).withColumn("_at", F.xxhash64("_key", "_place", "window"))
    some = {v: [bytes(r["window"]) for r in cut.where(F.col("bad") == v).orderBy("_at", "window").limit(SAMPLE_WINDOWS).collect()] for v in (0, 1)}
    ordinary = trained(some[0], 16384)
    toxic = ordinary + trained([w * 2 for w in some[1]], max(1024, 20 * len(contrast)))
    return calibrated(Model(ordinary, toxic, np.array([0.0]), np.array([0.0])), slim, marked)


def calibrated(model: Model, texts: DataFrame, marked: DataFrame) -> Model:
    """Chance of the toxic label at each distance over all rows of ``marked``, made to rise by pooling neighbours."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary, toxic, powers = Lengths(model.ordinary), Lengths(model.toxic), Powers()
        for batch in blocks(batches, text="_text"):
            total, _ = distances(batch.column("_text"), ordinary, toxic, powers)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(np.minimum(total, 400).astype(np.int32))], names=["_key", "gap"])

    # Texts are measured before the join, so that no text is shuffled.
    gaps = texts.mapInArrow(measured, texts.select("_key").schema.add("gap", "integer"))
    rows = attach(gaps, marked, ["_key"], "inner").groupBy("gap").agg(F.sum("_label").alias("bad"), F.count("*").alias("n")).orderBy("gap").collect()
    pools: list[list[float]] = []
    for r in rows:
        pools.append([r["bad"], r["n"], r["gap"], r["gap"]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            b = pools.pop()
            a = pools[-1]
            pools[-1] = [a[0] + b[0], a[1] + b[1], a[2], b[3]]
    steps, chance = [], []
    for bad, n, low, high in pools:
        for at in dict.fromkeys((low, high)):
            steps.append(float(at))
            chance.append((bad + 0.5) / (n + 1))
    model.steps, model.chance = np.array(steps), np.maximum.accumulate(chance)
    return model


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 on), from every whole text.

    Null, empty and wordless texts have distance 0 and its chance; without a model every score is
    0. Equal texts get equal scores; other columns pass through (columns of the two names are replaced).
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    slim = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = slim.drop("_text").schema.add("score", "double", False).add("predicted", "integer", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        if model is not None:
            ordinary, toxic = Lengths(model.ordinary), Lengths(model.toxic)
        for batch in blocks(batches, text="_text"):
            if model is None:
                chance = np.zeros(batch.num_rows)
            else:
                chance = model.chance_of(distances(batch.column("_text"), ordinary, toxic, powers)[0])
            made = [pa.array(chance), pa.array((chance >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, "score", "predicted"])

    return slim.mapInArrow(run, schema)
