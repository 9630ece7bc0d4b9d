"""Toxicity by compression of the text itself: two dictionaries, window lengths compared.

The plain form of the method that ``toxicity`` departs from: one zstandard dictionary is trained on
windows of toxic texts, one on windows of ordinary texts, and the windows of a text are compressed
under both. It is kept so that what the departure gains can be measured; see the tests.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm.ragged import LOWER, blocks, flat, word_spans
from mercato.llm.tables import stage
from mercato.llm.toxicity import SAMPLE_DOCS, SAMPLE_WINDOWS, WINDOW, Lengths, trained, windows_of

DICTIONARY_BYTES = 110 << 10


@dataclass
class TextModel:
    ordinary: bytes
    toxic: bytes


def spans_of(texts: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (A-Z lower-cased), begin and end of each window of words, its text, and its place there."""
    data, offsets = flat(texts)
    starts, ends, counts = word_spans(data, offsets)
    first, end, owner = windows_of(counts, WINDOW)
    place = first - (np.cumsum(counts) - counts)[owner]
    if not len(first):
        return b"", first, end, owner, place
    return LOWER[data].tobytes(), starts[first], ends[end - 1], owner, place


def fit(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> TextModel | None:
    """Dictionaries from at most ``SAMPLE_WINDOWS`` windows of at most ``SAMPLE_DOCS`` rows of each label.

    Rows are chosen by the hash of their key, windows by key and place. A key with both labels is
    toxic; null keys and labels are left out. None if one of the two labels is missing.
    """
    marked = labels.where(train & F.col(key).isNotNull() & F.col(label).isNotNull())
    marked = stage(marked.groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label).cast("int")).alias("_label")), "text-labels")
    order = F.xxhash64("_key"), F.col("_key")
    picked = [marked.where(F.col("_label") == v).orderBy(*order).limit(SAMPLE_DOCS) for v in (1, 0)]
    picked = stage(picked[0].unionByName(picked[1]), "text-keys")  # bounded, so it may be broadcast
    slim = docs.where(train).select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    sample = slim.join(F.broadcast(picked), "_key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text="_text"):
            raw, begin, end, owner, place = spans_of(batch.column("_text"))
            of = pa.array(owner, pa.int64())
            windows = pa.array([raw[a:b] for a, b in zip(begin, end, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_key").take(of), batch.column("_label").take(of), pa.array(place, pa.int64()), windows], names=["_key", "_label", "_place", "window"])

    schema = sample.select("_key", "_label").schema.add("_place", "long").add("window", "binary")
    windows = stage(sample.mapInArrow(cut, schema).withColumn("_at", F.xxhash64("_key", "_place", "window")), "text-windows")
    some = [[bytes(r["window"]) for r in windows.where(F.col("_label") == v).orderBy("_at", "window").limit(SAMPLE_WINDOWS).collect()] for v in (0, 1)]
    if not some[0] or not some[1]:
        return None
    return TextModel(trained(some[0], DICTIONARY_BYTES), trained(some[1], DICTIONARY_BYTES))


def score(docs: DataFrame, model: TextModel, text: str = "text") -> DataFrame:
    """``docs`` with n_windows, and what their windows are shorter under the toxic dictionary than under the ordinary one.

    ``gain`` sums all differences, ``positive_gain`` only those that point to toxic. Null, empty and
    wordless texts have 0 of each. Every window of every whole text counts.
    """
    added = ("n_windows", "gain", "positive_gain")
    kept = [c for c in docs.columns if c not in added]
    slim = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = slim.drop("_text").schema.add("n_windows", "long").add("gain", "long").add("positive_gain", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary, toxic = Lengths(model.ordinary), Lengths(model.toxic)
        for batch in blocks(batches, text="_text"):
            raw, begin, end, owner, _ = spans_of(batch.column("_text"))
            gap = ordinary.of(raw, begin, end) - toxic.of(raw, begin, end) if len(begin) else np.zeros(0, np.int64)
            total = lambda x: pa.array(np.bincount(owner, weights=x, minlength=batch.num_rows).astype(np.int64))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), total(np.ones(len(gap))), total(gap), total(np.maximum(gap, 0))], names=[*kept, *added])

    return slim.mapInArrow(run, schema)
