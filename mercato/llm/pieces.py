"""Subword pieces with seeded merge-dropout, and their lossless decoding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from mercato.llm.merging import PairTable, merge_all
from mercato.llm.ragged import blocks, mix

GAP = 0x2581  # stands for a space inside pieces
STEP = np.uint64(0xD6E8FEB86659FD93)


class Pieces:
    """Pieces, ranks and byte pieces of a SentencePiece merge model, as arrays."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        ids = {model.id_to_piece(i): i for i in plain}
        byte = [i for i in range(n) if model.is_byte(i)]
        self.bytes = np.zeros(256, dtype=np.int32)
        for i in byte:
            self.bytes[int(model.id_to_piece(i)[3:5], 16)] = i
        chars = {p: i for p, i in ids.items() if len(p) == 1}
        self.points = np.array([ord(c) for c in chars], dtype=np.int64)
        self.ids = np.array(list(chars.values()), dtype=np.int32)
        keys, ranks, joined = [], [], []
        for piece, i in ids.items():
            for k in range(1, len(piece)):
                a, b = ids.get(piece[:k]), ids.get(piece[k:])
                if a is not None and b is not None:
                    keys.append(a * 65536 + b)
                    ranks.append(int(-model.get_score(i)))
                    joined.append(i)
        self.keys, self.ranks, self.joined = np.array(keys, np.uint32), np.array(ranks, np.int32), np.array(joined, np.int32)
        said = [b""] * n
        for i in byte:
            said[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
        for p, i in ids.items():
            said[i] = p.replace(chr(GAP), " ").encode()
        self.said = np.frombuffer(b"".join(said), dtype=np.uint8)
        self.said_at = np.cumsum([0, *map(len, said)])


class Encoder:
    def __init__(self, pieces: Pieces, dropout: float, seed: int) -> None:
        self.pieces, self.dropout, self.seed = pieces, dropout, np.uint64(seed & (2**64 - 1))
        self.table = PairTable(pieces.keys, pieces.ranks, pieces.joined)
        self.char = np.full(0x110000, -1, dtype=np.int32)
        self.char[pieces.points] = pieces.ids

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts one after the other, and how many each text has."""
        shown = [" " + t if t else "" for t in texts]
        size = np.array([len(t) for t in shown], dtype=np.int64)
        whole = "".join(shown)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        n = len(points)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        doc = np.repeat(np.arange(len(texts)), size)
        gap = points == 32
        symbols = self.char[np.where(gap, GAP, points)]
        symbols[points == GAP] = -1  # a literal one goes through bytes, so decoding gives it back
        # No piece holds a gap after another character, so that is where sequences end.
        cut = np.ones(n, dtype=bool)
        cut[1:] = (gap[1:] & ~gap[:-1]) | (doc[1:] != doc[:-1])
        counts = np.diff(np.append(np.flatnonzero(cut), n))
        begin = np.cumsum(size) - size
        bar = np.uint64(min(int(self.dropout * 2.0**64), 2**64 - 1))
        salt = mix(keys.astype(np.uint64) * STEP + self.seed)

        def skip(spot: np.ndarray, join: np.ndarray) -> np.ndarray:
            of = doc[spot]
            return mix(salt[of] + (spot - begin[of]).astype(np.uint64) * STEP + mix(join.astype(np.uint64))) < bar

        sym, spot, _ = merge_all(symbols, counts, self.table, np.arange(n, dtype=np.int32), skip if self.dropout > 0 else _none)
        lost = np.flatnonzero(sym < 0)
        made = np.ones(len(sym), dtype=np.int64)
        if len(lost):
            p = points[spot[lost]]
            made[lost] = 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF)
            data = np.frombuffer("".join(map(chr, p.tolist())).encode("utf-8", "surrogatepass"), dtype=np.uint8)
            out = np.repeat(sym, made)
            out[out < 0] = self.pieces.bytes[data]
        else:
            out = sym
        return out, np.bincount(doc[spot], weights=made, minlength=len(texts)).astype(np.int64)


def _none(spot: np.ndarray, join: np.ndarray) -> np.ndarray:
    return np.zeros(len(spot), dtype=bool)


def decode_ids(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of piece ids; exact for what ``Encoder`` made."""
    size = np.diff(pieces.said_at)[ids]
    place = np.repeat(pieces.said_at[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    data = pieces.said[place].tobytes()
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
    return [data[a + 1 : b].decode("utf-8", "surrogatepass") if b > a else "" for a, b in zip(ends[:-1], ends[1:], strict=True)]


def encode(
    docs: DataFrame, model: str, dropout: float, seed: int = 0, text: str = "text", key: str = "doc_id", check: bool = False
) -> DataFrame:
    """``docs`` with piece_ids (array of int) and n_pieces of every whole text.

    Candidate merges wait in an agenda ordered by rank, then place. One that comes up is skipped
    for good with probability ``dropout``, decided by a hash of ``seed``, the row's key, the place
    and the piece it would make: the same everywhere and on every retry, different between rows,
    places and seeds. Dropout 0 gives the library's own segmentation. Spaces are kept as they are
    and unknown characters, the gap sign included, become bytes, so ``decode`` returns every text.
    Null and empty texts have no pieces; a null key counts as 0; rows with equal key and text are
    equal. Other columns pass through. ``check`` decodes at once and adds ``same`` (boolean).
    """
    pieces = Pieces(model)
    kept = [c for c in docs.columns if c not in ("piece_ids", "n_pieces", "same")]
    slim = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"), F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("0"))).alias("_key"))
    schema = slim.drop("_text", "_key").schema.add("piece_ids", T.ArrayType(T.IntegerType(), False), False).add("n_pieces", "long", False)
    if check:
        schema = schema.add("same", "boolean", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces, dropout, seed)
        for batch in blocks(batches, 1 << 18, "_text"):
            texts = batch.column("_text").to_pylist()
            ids, counts = encoder.encode(texts, batch.column("_key").to_numpy(zero_copy_only=False).astype(np.int64))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32())), pa.array(counts)]
            if check:
                made.append(pa.array([a == b for a, b in zip(texts, decode_ids(pieces, ids, counts), strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, *schema.names[len(kept) :]])

    return slim.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, ids: str = "piece_ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its pieces; null ids give null."""
    pieces = Pieces(model)
    kept = [c for c in encoded.columns if c != to]
    schema = encoded.select(*kept).schema.add(to, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.array([len(x) if x.is_valid else 0 for x in column], dtype=np.int64)
            texts = decode_ids(pieces, values, counts)
            valid = column.is_valid().to_pylist()
            out = pa.array([t if v else None for t, v in zip(texts, valid, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), out], names=[*kept, to])

    return encoded.select(*kept).mapInArrow(run, schema)
