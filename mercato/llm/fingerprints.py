"""Document fingerprints by consistent weighted sampling, and their likeness to neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from mercato.llm.ragged import BASE, BLOCK, Powers, flat, mix, word_hashes
from mercato.llm.tables import attach, stage

SAMPLES = 64
BUCKET_BYTES = 16 << 20


def terms(texts: list[str], powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each text, their weights, and how many there are.

    A term is a pair of neighbouring words (A-Z lower-cased), its weight the number of times it
    occurs; a text of one word has that word.
    """
    words, counts, _, _ = word_hashes(*flat(pa.array(texts, pa.large_string())), powers)
    made = np.where(counts == 1, 1, np.maximum(counts - 1, 0))
    owner = np.repeat(np.arange(len(counts)), made)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) + np.repeat(np.cumsum(counts) - counts, made)
    alone = np.repeat(counts == 1, made)
    value = mix(words[at] * BASE + np.where(alone, np.uint64(1), words[np.minimum(at + 1, len(words) - 1)])) if len(at) else words[:0]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(value)))
    return value[first], weight, np.bincount(owner[first], minlength=len(counts))


def draws(value: np.ndarray, weight: np.ndarray, samples: int) -> np.ndarray:
    """For each weighted term and sample: how early it comes, and what it would leave as the sample.

    Per sample a term has r and c of Gamma(2, 1) and b uniform, all from its hash. With
    t = floor(ln(weight) / r + b), the term of least c / exp(r (t - b + 1)) is taken and leaves
    (term, t), so two texts leave the same with the chance of their generalised Jaccard likeness.
    Both halves go into one 64-bit number: the order above, a hash of (term, t) below.
    """
    step = np.uint64(0xA0761D6478BD642F)
    out = np.empty((len(value), samples), dtype=np.uint64)
    log_w = np.log(weight.astype(np.float32))[:, None]
    scale, low = np.float32(2.0**-21), np.uint64((1 << 21) - 1)
    size = max(1, (1 << 15) // samples)
    seeds = mix((np.arange(samples, dtype=np.uint64) + np.uint64(1)) * step)
    single = weight == 1

    def whole(z: np.ndarray, shift: int) -> np.ndarray:
        """21 bits as a number between 0 and 1, never either."""
        cut = z >> np.uint64(shift)
        cut &= low
        made = cut.astype(np.int32).astype(np.float32)
        made *= scale
        made += np.float32(2.0**-22)
        return made

    for kind in (True, False):
        mine = np.flatnonzero(single == kind)
        for a in range(0, len(mine), size):
            at = mine[a : a + size]
            x = mix(value[at, None] + seeds[None])
            y = x * step
            y ^= y >> np.uint64(32)
            r, c = whole(x, 0), whole(x, 42)
            r *= whole(x, 21)
            c *= whole(y, 0)
            np.negative(np.log(r, out=r), out=r)
            np.negative(np.log(c, out=c), out=c)
            u = whole(y, 21)
            top = value[at, None] >> np.uint64(32)
            if kind:  # weight 1: t is 0, whatever r
                late = np.log(c) - r * (np.float32(0) - u + np.float32(1))
                left = top
            else:
                t = np.floor(log_w[at] / r + u)
                late = np.log(c) - r * (t - u + np.float32(1))
                left = top ^ (t.astype(np.int32).astype(np.uint64) * step >> np.uint64(32))
            # Floats in the order of unsigned numbers.
            bits = late.view(np.int32)
            bits = (bits ^ ((bits >> 31) | np.int32(-(2**31)))).view(np.uint32)
            out[at] = (bits.astype(np.uint64) << np.uint64(32)) | (left & np.uint64(0xFFFFFFFF))
    return out


def signatures(texts: list[str], powers: Powers, samples: int = SAMPLES) -> np.ndarray:
    """16 bits per sample and text; a text without words has all 0."""
    value, weight, counts = terms(texts, powers)
    out = np.zeros((len(texts), samples), dtype=np.uint16)
    if not len(value):
        return out
    order = np.lexsort((weight, value))
    v, w = value[order], weight[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    place = np.empty(len(v), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    drawn = draws(v[new], w[new], samples)
    full = np.flatnonzero(counts)
    ends = np.cumsum(counts[full])
    for a in range(0, len(full), 64):  # a few texts at a time, so that the rows stay in cache
        b = min(a + 64, len(full))
        base = ends[a] - counts[full[a]]
        begin = (ends - counts[full])[a:b] - base
        least = np.minimum.reduceat(drawn[place[base : ends[b - 1]]], begin, axis=0)
        out[full[a:b]] = np.maximum(least & np.uint64(0xFFFF), np.uint64(1)).astype(np.uint16)
    return out


def shown(signature: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in signature]


def compared(texts: list[str], after: list[str], powers: Powers) -> list[pa.Array]:
    """The result columns of each text with the one that follows it."""
    size = [len(t) for t in texts]
    edited = [t[: n - n // 4] + b[: n // 4] for t, n, b in zip(texts, size, after, strict=True)]
    m = len(texts)
    every = signatures([*texts, *edited, after[-1]], powers) if after[:-1] == texts[1:] else signatures([*texts, *edited, *after], powers)
    own, other = every[:m], every[m : 2 * m]
    follow = np.concatenate([own[1:], every[2 * m :]]) if len(every) == 2 * m + 1 else every[2 * m :]
    return [
        pa.array(size, pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
        pa.array(shown(own)),
        pa.array(shown(other)),
        pa.array((own == other).mean(1)),
        pa.array((own == follow).mean(1)),
    ]


NAMES = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
KINDS = (T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType())


def edited_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key with the fingerprint of its whole text and of its edited text, and two likenesses.

    Edited: the last quarter of the code points replaced by the first as many of the next row's
    text, in ascending order of the key (after the last: the first); null keys come first and
    equal keys are ordered by their text's hash. Null texts are empty. Two texts without words
    are fully alike, one without is not like any other. One range shuffle of the texts; the
    last row of each range meets the first of the next in a second, small step.
    """
    slim = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    total = slim.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    order = F.col("_key").asc_nulls_first(), F.xxhash64("_text"), F.col("_text")
    placed = slim.repartitionByRange(int(total // BUCKET_BYTES) + 1, *order[:2]).sortWithinPartitions(*order)
    key_type = slim.schema["_key"].dataType
    schema = T.StructType([T.StructField("_key", key_type), *(T.StructField(n, k) for n, k in zip(NAMES, KINDS, strict=True))])
    wide = T.StructType([*schema.fields, T.StructField("_edge", T.IntegerType()), T.StructField("_range", T.IntegerType()), T.StructField("_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, at, held = Powers(), TaskContext.get().partitionId(), None
        arrow_key = None

        def edge(kind: int, keys: pa.Array, text: str) -> pa.RecordBatch:
            empty = [pa.array([v], t) for v, t in zip((None,) * 6, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)]
            return pa.RecordBatch.from_arrays([keys, *empty, pa.array([kind], pa.int32()), pa.array([at], pa.int32()), pa.array([text], pa.string())], names=wide.names)

        for batch in batches:
            first, size = 0, 0
            texts = batch.column("_text").to_pylist()
            if held is None and texts:
                yield edge(1, batch.column("_key").slice(0, 1), texts[0])
            for i, t in enumerate(texts):
                size += len(t)
                if size < BLOCK // 2 and i + 1 < len(texts):
                    continue
                keys, part = batch.column("_key").slice(first, i + 1 - first), texts[first : i + 1]
                arrow_key = keys.type
                if held is not None:
                    keys, part = pa.concat_arrays([held[0], keys]), [held[1], *part]
                if len(part) > 1:
                    none = [pa.nulls(len(part) - 1, t) for t in (pa.int32(), pa.int32(), pa.string())]
                    yield pa.RecordBatch.from_arrays([keys[:-1], *compared(part[:-1], part[1:], powers), *none], names=wide.names)
                held = (keys[-1:], part[-1])
                first, size = i + 1, 0
        if held is not None and arrow_key is not None:
            yield edge(2, *held)

    made = stage(placed.mapInArrow(run, wide), "fingerprints")
    # At most two rows of each range; only their numbers pass through the window.
    heads = made.where("_edge = 1").select(F.col("_range"), F.col("_text").alias("_after"))
    lead = F.lead("_range").over(Window.orderBy("_range"))
    follow = heads.select("_range", F.coalesce(lead, F.min("_range").over(Window.partitionBy())).alias("_next"))
    last = made.where("_edge = 2").select("_key", "_range", "_text").join(follow, "_range")
    last = attach(last, heads.withColumnRenamed("_range", "_next"), ["_next"], "inner").select("_key", "_text", "_after")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                out = compared(one.column("_text").to_pylist(), one.column("_after").to_pylist(), powers)
                yield pa.RecordBatch.from_arrays([one.column("_key"), *out], names=schema.names)

    whole = made.where("_edge is null").select(*schema.names).unionByName(last.mapInArrow(finish, schema))
    return whole.withColumnRenamed("_key", key)
