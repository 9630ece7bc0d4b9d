"""Repeated byte strings by a partitioned enhanced suffix array and its tree of intervals.

Suffixes whose first ``least`` bytes occur twice are wanted. Each such stretch names an anchor by
its content: the position of the smallest hash of its half-length strings. Equal stretches have equal
anchors at equal places, so

1. texts that occur more than once are repeats as a whole; one of each goes on;
2. anchors are counted, and only stretches whose anchor occurs twice go on;
3. the suffixes of one anchor are dealt out by the anchor's hash, with as much text as they need;
   a block of texts ships equal pieces once and keeps the list of its places to itself;
4. each part sorts its suffixes, takes the common prefixes of neighbours and scans them with a stack
   into intervals. An interval whose occurrences follow different bytes is a maximal repeat; one
   whose occurrences all follow the same byte belongs to a longer one that begins earlier, unless a
   piece begins there. The bytes under the occurrences of these intervals are the repeated ones;
5. every block gets the answers for its distinct pieces as one list and lays them on its texts.

An anchor of very many places isn't dealt to one part: its stretches are compared by their hashes,
which are summed before they are shuffled and spread evenly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from mercato.llm.ragged import Powers, Rolling, blocks, flat, give_back, lean
from mercato.llm.tables import attach, drop, stage

LEAST = 400
PART_BYTES = 1 << 20  # of suffix text in one part; its arrays take some forty times as much
CROWDED = 20_000  # places of one anchor beyond which its stretches go by hash
PLACE = np.uint64(28)  # bits of the position in the order of anchors


def anchors(data: np.ndarray, offsets: np.ndarray, least: int, powers: Powers, rolling: Rolling | None = None) -> tuple[np.ndarray, ...]:
    """Text, first and last stretch and hash of every anchor; stretches of one anchor are consecutive."""
    k = least // 2
    width = least - k + 1
    n = len(data)
    size = np.diff(offsets)
    if not (size >= least).any():
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    rolling = rolling or Rolling(data, powers)
    m = n - k + 1
    at = np.arange(m)
    gram = rolling.of(at, at + k)
    order = (gram >> PLACE << PLACE) | at.astype(np.uint64)
    of = np.repeat(np.arange(len(size)), size)
    order[of[:m] != of[k - 1 :]] = np.uint64(2**64 - 1)  # runs over a text's end
    pad = -m % width
    rows = np.concatenate([order, np.full(pad, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(rows, axis=1).reshape(-1)
    start = np.flatnonzero(of[: n - least + 1] == of[least - 1 :])
    place = (np.minimum(ahead[start], behind[start + width - 1]) & np.uint64((1 << 28) - 1)).astype(np.int64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    text = of[start[first]]
    return text, start[first] - offsets[text], start[last] - offsets[text], gram[place[first]]


def keyed(docs: DataFrame, text: str, *more: str) -> DataFrame:
    raw = F.coalesce(F.col(text), F.lit(""))
    return docs.select(*more, raw.alias("_text"), F.unhex(F.md5(raw.cast("binary"))).alias("_key"))


def repeated(texts: DataFrame, least: int) -> DataFrame:
    """_key and the byte ranges [_from, _to) covered by stretches of ``least`` bytes that also start elsewhere.

    ``texts`` has every text of at least ``least`` bytes once.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in blocks(batches, text="_text"):
            text, first, last, gram = anchors(*flat(batch.column("_text")), least, powers)
            keys = batch.column("_key").take(pa.array(text))
            yield pa.RecordBatch.from_arrays([keys, pa.array(_nth(text), pa.int32()), pa.array(gram.view(np.int64))], names=["_key", "nth", "anchor"])

    found = stage(texts.mapInArrow(find, "_key binary, nth int, anchor long"), "anchors")
    often = stage(found.groupBy("anchor").agg(F.count("*").alias("places")).where("places > 1"), "anchors-shared")
    # A text's list has the numbers of its shared anchors, doubled, plus 1 for a crowded one.
    code = 2 * F.col("nth") + (F.col("places") > CROWDED).cast("int")
    lists = found.join(often, "anchor").groupBy("_key").agg(F.array_sort(F.collect_set(code)).alias("codes"))
    lists = stage(lists, "anchor-lists")
    drop(found, often)
    wanted = texts.join(lists, "_key")  # texts meet their lists alike at every size, by Spark's own check of it
    schema = ", ".join(f"{c} {k}" for c, k in zip(CUT, ("long", "long", "long", "long", "long", "int", "binary", "array<binary>", *["binary"] * 5), strict=True))
    cut = stage(wanted.mapInArrow(_cutter(least), schema), "pieces")

    pieces = cut.where("text is not null").select("chunk", "piece", "anchor", "copies", "owned", "text")
    total = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(total // PART_BYTES) + 1
    dealt = pieces.drop("chunk").withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(parts)))
    runs = dealt.groupBy("part").applyInArrow(lean(lambda table: _runs_of_part(table, least)), "piece long, begin int, end int")
    crowd = cut.where("hash is not null").select("chunk", F.col("hash").alias("piece"), "copies")
    counted = crowd.groupBy("piece").agg(F.sum("copies").alias("n")).where("n > 1").select("piece")

    # What is repeated of each block's distinct pieces and crowded stretches: one list per block.
    answers = pieces.select("chunk", "piece").join(runs, "piece").select("chunk", "piece", "begin", "end")
    lone = crowd.join(counted, "piece").select("chunk", "piece", F.lit(-1).alias("begin"), F.lit(-1).alias("end"))
    told = answers.unionByName(lone).groupBy("chunk").agg(F.collect_list(F.struct("piece", "begin", "end")).alias("l"))
    told = told.select("chunk", *[F.col(f"l.{c}").alias(c) for c in ("piece", "begin", "end")])
    places = cut.where("keys is not null").select("chunk", "keys", "doc", "first", "at", "crowd_doc", "crowd_at")
    laid = places.join(told, "chunk").mapInArrow(_laid(least), "_key binary, _from array<int>, _to array<int>")
    out = stage(laid, "repeat-lists")
    drop(cut)
    return out


def _nth(text: np.ndarray) -> np.ndarray:
    """Number of each anchor within its text."""
    return np.arange(len(text)) - np.searchsorted(text, text)


# One row per distinct piece, or crowded stretch, of a block; and one per block with its places.
CUT = ["chunk", "piece", "anchor", "copies", "hash", "owned", "text", "keys", "doc", "first", "at", "crowd_doc", "crowd_at"]


def _cutter(least: int):
    """Pieces of text for the shared anchors of each block of texts, and where the block has them."""
    kinds = [*[pa.int64()] * 5, pa.int32(), pa.binary(), pa.list_(pa.binary()), *[pa.binary()] * 5]

    def rows(n: int, **made: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([made[c].cast(k) if c in made else pa.nulls(n, k) for c, k in zip(CUT, kinds, strict=True)], names=CUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, chunk = Powers(), TaskContext.get().partitionId() << 32
        one = lambda x, kind: pa.array([np.asarray(x).astype(kind).tobytes()], pa.binary())
        for batch in blocks(batches, text="_text"):
            data, offsets = flat(batch.column("_text"))
            rolling = Rolling(data, powers)
            text, first, last, gram = anchors(data, offsets, least, powers, rolling)
            code = batch.column("codes").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), batch.column("codes").value_lengths().to_numpy(zero_copy_only=False))
            at = np.searchsorted(text, doc) + code // 2
            first, last, anchor, crowded = first[at], last[at], gram[at].view(np.int64), code % 2 == 1
            lo, hi = offsets[doc] + first, offsets[doc] + last + least
            before = np.where(first > 0, data[np.maximum(lo - 1, 0)], 0).astype(np.uint64) + (first > 0).astype(np.uint64)
            piece = (rolling.of(lo, hi) + before * np.uint64(0x9E3779B97F4A7C15) + (hi - lo).astype(np.uint64)).view(np.int64)
            few, many = np.flatnonzero(~crowded), np.flatnonzero(crowded)
            if len(few):
                value, each, copies = np.unique(piece[few], return_index=True, return_counts=True)
                at = few[each]
                raw = data.tobytes()
                # The byte before comes first; the start of a text has none.
                text = [bytes([int(before[i] > 0)]) + raw[max(lo[i] - 1, 0) : lo[i]][: int(before[i] > 0)].rjust(1, b"\0") + raw[lo[i] : hi[i]] for i in at]
                yield rows(len(at), chunk=pa.array([chunk] * len(at)), piece=pa.array(value), anchor=pa.array(anchor[at]), copies=pa.array(copies), owned=pa.array((last - first + 1)[at]), text=pa.array(text, pa.binary()))
            size = (last - first + 1)[many]
            start = np.repeat(lo[many] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            hashes = rolling.of(start, start + least).view(np.int64) if len(start) else start
            if len(many):
                value, copies = np.unique(hashes, return_counts=True)
                yield rows(len(value), chunk=pa.array([chunk] * len(value)), hash=pa.array(value), copies=pa.array(copies))
            whose = np.repeat(doc[many], size)
            yield rows(
                1, chunk=pa.array([chunk]), keys=pa.array([batch.column("_key").to_pylist()], pa.list_(pa.binary())),
                doc=one(doc[few], np.int32), first=one(first[few], np.int32), at=one(piece[few], np.int64),
                crowd_doc=one(np.stack([whose, start - offsets[whose]]) if len(start) else whose, np.int32), crowd_at=one(hashes, np.int64),
            )
            chunk += 1

    return run


def _laid(least: int):
    """The answers for a block's pieces, put where its texts have these pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                take = lambda name, kind: np.frombuffer(batch.column(name)[i].as_py(), kind)  # noqa: B023, E731
                piece, begin, end = (batch.column(c)[i].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("piece", "begin", "end"))
                run_ = begin >= 0
                order = np.argsort(piece[run_], kind="stable")
                known, begin, end = piece[run_][order], begin[run_][order], end[run_][order]
                at, first = take("at", np.int64), take("first", np.int32)
                low, high = np.searchsorted(known, at), np.searchsorted(known, at, "right")
                n = high - low
                row = np.repeat(np.arange(len(at)), n)
                which = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                crowd = np.unique(piece[~run_])
                hashes, pair = take("crowd_at", np.int64), take("crowd_doc", np.int32).reshape(2, -1)
                hit = np.flatnonzero(np.isin(hashes, crowd))
                doc = np.concatenate([take("doc", np.int32)[row], pair[0][hit]])
                a = np.concatenate([first[row] + begin[which], pair[1][hit]])
                b = np.concatenate([first[row] + end[which], pair[1][hit]])
                order = np.argsort(doc, kind="stable")
                docs, begins = np.unique(doc[order], return_index=True)
                cuts = [spans(a[x], b[x], least) for x in np.split(order, begins[1:])] if len(docs) else []
                keys = batch.column("keys")[i].values.take(pa.array(docs, pa.int64()))
                made = [pa.array([c[k].tolist() for c in cuts], pa.list_(pa.int32())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([keys, *made], names=["_key", "_from", "_to"])
        give_back()

    return run


class SuffixArray:
    """Suffixes of the pieces of one part, sorted, with common prefixes of neighbours.

    Suffixes are ordered by the hash of their first ``least`` bytes and then by the bytes that
    follow, which keeps equal beginnings together like the alphabetic order does. Only groups that
    a scan needs are put in order: those whose members follow different bytes, or of which one
    begins its piece. ``common`` is the length of the prefix shared with the one before if that is
    ``least`` or more, else 0; it counts no further than the shorter piece.
    """

    def __init__(self, texts: list[bytes], owned: np.ndarray, least: int) -> None:
        self.owned, self.least = owned, least
        self.raw = b"".join(texts)
        data = np.frombuffer(self.raw, dtype=np.uint8)
        base = np.cumsum([0, *map(len, texts)])
        self.piece = np.repeat(np.arange(len(texts)), owned)
        self.step = np.arange(len(self.piece)) - np.repeat(np.cumsum(owned) - owned, owned)
        self.at = base[self.piece] + 2 + self.step
        self.room = base[self.piece + 1] - self.at
        inner = self.step > 0
        self.before = np.where(inner | (data[base[self.piece]] > 0), data[self.at - 1].astype(np.int64), -1 - self.piece)
        self.rolling = Rolling(data, Powers())
        key = self.rolling.of(self.at, self.at + least)
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(key)))
        if len(begin):
            left = self.before[order]
            mixed = np.minimum.reduceat(left, begin) != np.maximum.reduceat(left, begin)
            head = np.minimum.reduceat(self.step[order], begin) == 0
            wanted = (size > 1) & (mixed | head)
            begin, size = begin[wanted], size[wanted]
        for a, n in zip(begin[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            order[a : a + n] = sorted(order[a : a + n].tolist(), key=self._rest)
        keep = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        self.order = order[keep]
        self.common = np.zeros(len(self.order) + 1, dtype=np.int64)
        first = np.zeros(len(self.order), dtype=bool)
        first[np.cumsum(size) - size] = True
        pair = np.flatnonzero(~first)
        self.common[pair] = self._common(self.order[pair - 1], self.order[pair])

    def _rest(self, s: int) -> bytes:
        at = int(self.at[s])
        return self.raw[at + self.least : at + int(self.room[s])]

    def text(self, s: int, length: int) -> bytes:
        return self.raw[int(self.at[s]) : int(self.at[s]) + length]

    def _common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes, ``least`` bytes being equal, by bisection on hashes."""
        low, high = np.full(len(x), self.least), np.minimum(self.room[x], self.room[y])
        while (open_ := low < high).any():
            half = (low + high + 1) >> 1
            same = self.rolling.of(self.at[x], self.at[x] + half) == self.rolling.of(self.at[y], self.at[y] + half)
            low, high = np.where(open_ & same, half, low), np.where(open_ & ~same, half - 1, high)
        return low

    def intervals(self) -> Iterator[tuple[int, int, int, bool]]:
        """(length, first, last, maximal) in suffix order, by a stack over the common prefixes.

        Intervals whose occurrences all follow one byte are left out, because a longer repeat that
        starts earlier has them, unless one of them begins its piece: these come as not maximal.
        """
        left = self.before[self.order]
        changes = np.concatenate([[0, 0], np.cumsum(left[1:] != left[:-1])]) if len(left) else np.zeros(1, np.int64)
        heads = np.concatenate([[0], np.cumsum(self.step[self.order] == 0)])
        stack: list[tuple[int, int]] = []
        for i, depth in enumerate(self.common.tolist()):
            low = i - 1
            while stack and stack[-1][0] > depth:
                length, low = stack.pop()
                diverse = bool(changes[i] > changes[low + 1])
                if diverse or heads[i] > heads[low]:
                    yield length, low, i - 1, diverse
            if depth and (not stack or stack[-1][0] < depth):
                stack.append((depth, low))

    def covered(self) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes that occur in an interval, and the longest length they have in one."""
        length = np.zeros(len(self.order), dtype=np.int64)
        for depth, low, high, _ in self.intervals():
            np.maximum(length[low : high + 1], depth, out=length[low : high + 1])
        hit = np.flatnonzero(length)
        return self.order[hit], length[hit]


def _distinct(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    table = table.combine_chunks()
    piece, copies, owned = (table.column(c).to_numpy() for c in ("piece", "copies", "owned"))
    value, one, back = np.unique(piece, return_index=True, return_inverse=True)
    return value, np.bincount(back, weights=copies).astype(np.int64), owned[one].astype(np.int64), table.column("text").take(pa.array(one)).to_pylist()


def _runs_of_part(table: pa.Table, least: int) -> pa.Table:
    """Runs of starts [begin, end] of repeated stretches in each distinct piece."""
    piece, copies, owned, texts = _distinct(table)
    array = SuffixArray(texts, owned, least)
    suffix, length = array.covered()
    many = np.flatnonzero(copies > 1)  # the piece itself is repeated
    of = np.concatenate([array.piece[suffix], many])
    begin = np.concatenate([array.step[suffix], np.zeros(len(many), np.int64)])
    end = np.concatenate([array.step[suffix] + length - least, owned[many] - 1])
    order = np.lexsort((begin, of))
    of, begin, end = of[order], begin[order], end[order]
    # Runs that touch or overlap are one: of one piece after the other, far apart.
    far = of * (int(owned.max(initial=0)) + 2)
    reach = np.maximum.accumulate(far + end) if len(of) else far
    new = np.flatnonzero(np.concatenate([[True], (far + begin)[1:] > reach[:-1] + 1])) if len(of) else np.zeros(0, np.int64)
    last = reach[np.append(new[1:], len(of)) - 1] - far[new] if len(of) else new
    return pa.table({"piece": pa.array(piece[of[new]], pa.int64()), "begin": pa.array(begin[new], pa.int32()), "end": pa.array(last, pa.int32())})


def spans(first: np.ndarray, last: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte ranges [a, b) that the stretches cover; touching ranges are one."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], np.maximum.accumulate(last[order] + least)
    new = np.ones(len(a), dtype=bool)
    new[1:] = a[1:] > b[:-1]
    at = np.flatnonzero(new)
    return a[at], b[np.append(at[1:], len(a)) - 1]


def covered(docs: DataFrame, least: int, text: str, *more: str) -> DataFrame:
    """``docs`` rows with the ranges [_from, _to) of their repeated bytes (null if none).

    A text that occurs more than once is repeated as a whole; one of each is compared with the others.
    """
    texts = keyed(docs, text, *more)
    size = F.octet_length("_text")
    long_ = texts.where(size >= least).select("_key", "_text")
    copies = long_.groupBy("_key").agg(F.count("*").alias("_rows"), F.max(size).alias("_size")).where("_rows > 1")
    copies = stage(copies, "copies")
    marked = attach(long_, copies, ["_key"])
    # Copies of a text are one before the shuffle, so a large group of them sends one from each task.
    single = stage(marked.where("_rows is not null").groupBy("_key").agg(F.first("_text").alias("_text")), "copies-once")
    lists = repeated(marked.where("_rows is null").select("_key", "_text").unionByName(single), least)
    # Copies have their range from the table of copies, short texts have none. What is left has a key of its own, so
    # no key of that join is hot.
    told = attach(texts.where(size >= least), copies, ["_key"])
    alone = told.where("_rows is null").drop("_rows", "_size").join(lists, "_key", "left")
    whole = told.where("_rows is not null").withColumns({"_from": F.array(F.lit(0)), "_to": F.array("_size")}).drop("_rows", "_size")
    none = F.lit(None).cast("array<int>")
    short = texts.where(size < least).withColumns({"_from": none, "_to": none})
    return alone.unionByName(whole).unionByName(short)


def remove_repeats(docs: DataFrame, least: int = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every whole text without its repeats: key, n_bytes, spans, kept, and n_removed, n_spans and kept_sha256 of these.

    Every byte goes that is covered by a string of ``least`` bytes that also starts anywhere else
    in the table, the same text included; judged on the input, overlaps count. Texts are UTF-8
    bytes, null is empty, matches stay inside a text. Repeated rows repeat each other.
    ``spans`` are the removed byte ranges [start, end), ``kept`` the bytes left, so a character may be cut.
    Equality of strings is that of 64-bit hashes under a shared anchor's.
    """
    kind = docs.schema[key].dataType
    laid = covered(docs.select(F.col(key).alias("_id"), F.col(text).alias("_t")), least, "_t", "_id")
    size, kept = F.lit(0).cast("long").alias("_size"), F.col("_text").cast("binary").alias("kept")
    schema = laid.select("_id", size, F.col("_from").alias("start"), F.col("_to").alias("end"), kept).schema
    assert kind == schema["_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("_text"))
            raw = data.tobytes()
            begins, ends = ([x or [] for x in batch.column(c).to_pylist()] for c in ("_from", "_to"))
            kept = [without(raw[offsets[i] : offsets[i + 1]], begins[i], ends[i]) for i in range(batch.num_rows)]
            made = [pa.array(np.diff(offsets)), pa.array(begins, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *made], names=schema.names)
        give_back()

    cut = laid.select("_id", "_text", "_from", "_to").mapInArrow(run, schema)
    return cut.select(
        F.col("_id").alias(key),
        F.col("_size").alias("n_bytes"),
        (F.col("_size") - F.octet_length("kept")).alias("n_removed"),
        F.size("start").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.arrays_zip("start", "end").alias("spans"),
        "kept",
    )


def without(body: bytes, a: np.ndarray | list[int], b: np.ndarray | list[int]) -> bytes:
    edges = [0, *(int(x) for pair in zip(a, b, strict=True) for x in pair), len(body)]
    return b"".join(body[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))


def strip_repeats(docs: DataFrame, least: int = LEAST, text: str = "text") -> DataFrame:
    """``docs`` with the repeats cut out of their texts; whole characters only.

    A character that a repeat covers in part stays. Null texts stay null.
    """
    names = docs.columns
    struct = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"), F.col(text).alias("_t"))
    laid = covered(struct, least, "_t", "_row")
    hit = laid.where("_from is not null").select("_row", "_text", "_from", "_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, begin, end in zip(batch.column("_text").to_pylist(), batch.column("_from").to_pylist(), batch.column("_to").to_pylist(), strict=True):
                raw = body.encode()
                a, b = np.array(begin, np.int64), np.array(end, np.int64)
                tail = (np.frombuffer(raw + b"a", np.uint8) & 0xC0) == 0x80
                while tail[a].any():
                    a = a + tail[a]
                while tail[b].any():
                    b = b - tail[b]
                out.append(without(raw, a, np.maximum(a, b)).decode())
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, pa.string())], names=["_row", "_new"])
        give_back()

    cut = hit.mapInArrow(run, hit.select("_row").schema.add("_new", "string"))
    cut = cut.select(*[F.col("_new").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in names])
    return laid.where("_from is null").select("_row.*").unionByName(cut)


def maximal_repeats(docs: DataFrame, least: int = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of maximal repeats with all their occurrences: (repeat_id, length, key, start).

    A repeat is maximal if its occurrences differ in the byte before them (or one is at a text's
    start) and in the byte after. ``length`` counts as far as the suffixes' shipped text goes, so
    repeats that go on beyond it are told apart by their start only.
    """
    texts = keyed(docs, text, F.col(key).alias("_id")).where(F.octet_length("_text") >= least)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in blocks(batches, text="_text"):
            data, offsets = flat(batch.column("_text"))
            doc, first, last, gram = anchors(data, offsets, least, powers)
            raw = data.tobytes()
            lo, hi = offsets[doc] + first, offsets[doc] + last + least
            body = [bytes([int(f > 0)]) + (raw[a - 1 : a] if f else b"\0") + raw[a:b] for f, a, b in zip(first, lo, hi, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pa.array(doc)), pa.array(first), pa.array(last - first + 1), pa.array(gram.view(np.int64)), pa.array(body, pa.binary())],
                names=["_id", "first", "owned", "anchor", "text"],
            )

    schema = texts.select("_id").schema.add("first", "long").add("owned", "long").add("anchor", "long").add("text", "binary")
    cut = stage(texts.mapInArrow(find, schema), "suffixes")
    often = cut.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    some = cut.join(often, "anchor")
    total = some.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(total // PART_BYTES) + 1
    out_schema = texts.select(F.lit(0).cast("long").alias("repeat_id"), F.lit(0).cast("long").alias("length"), F.col("_id").alias(key), F.lit(0).cast("long").alias("start")).schema

    def scan(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        bodies = table.column("text").to_pylist()
        array = SuffixArray(bodies, table.column("owned").to_numpy(), least)
        first = table.column("first").to_numpy()
        ids, lengths, rows, starts = [], [], [], []
        for depth, low, high, maximal in array.intervals():
            if not maximal:
                continue
            name = int.from_bytes(hashlib.blake2b(array.text(int(array.order[low]), depth), digest_size=8).digest(), "big", signed=True)
            for s in array.order[low : high + 1].tolist():
                ids.append(name), lengths.append(depth), rows.append(array.piece[s]), starts.append(int(first[array.piece[s]] + array.step[s]))
        keys = table.column("_id").take(pa.array(np.array(rows, dtype=np.int64)))
        return pa.table({"repeat_id": pa.array(ids, pa.int64()), "length": pa.array(lengths, pa.int64()), key: keys, "start": pa.array(starts, pa.int64())})

    return some.withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(parts))).groupBy("part").applyInArrow(scan, out_schema)
