"""Two operators against plain versions written step by step."""

from __future__ import annotations

import heapq
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from mercato.llm import gru, pieces
from mercato.llm.queries import tokenizer
from mercato.llm.ragged import Powers, flat, mix, word_hashes
from tests.llm.conftest import by_id, documents

MODEL = "piece_bpe_32k.model"


def agenda(model, text, key, dropout, seed):
    """Piece ids of one text: candidates by rank and place, each skipped for good by the hash of its right part's place."""
    if not text:
        return []
    shown = ["▁" if c == " " else None if c == "▁" else c for c in " " + text]

    def piece(s):
        i = model.piece_to_id(s)
        plain = not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))
        return i if plain else None

    sym = [c if c is not None and piece(c) is not None else None for c in shown]
    after = [*range(1, len(sym)), None]
    before = [None, *range(len(sym) - 1)]
    heap = []

    def offer(i):
        j = after[i] if i is not None else None
        if j is not None and sym[i] and sym[j] and (made := piece(sym[i] + sym[j])) is not None:
            heapq.heappush(heap, (-model.get_score(made), i, made, sym[i], sym[j]))

    with np.errstate(over="ignore"):
        salt = mix(np.array([key], dtype=np.int64).astype(np.uint64) * pieces.STEP + np.uint64(seed))
        bar = min(int(dropout * 2.0**64), 2**64 - 1)
        skipped = lambda i, made: int(mix(salt + np.uint64(i) * pieces.STEP + mix(np.array([made], np.uint64)))[0]) < bar
        for i in range(len(sym)):
            offer(i)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j is None or sym[j] != b or (dropout and skipped(j, made)):
                continue
            sym[i], sym[j], after[i] = a + b, "", after[j]
            if after[i] is not None:
                before[after[i]] = i
            offer(before[i])
            offer(i)
    out, i = [], 0
    while i is not None:
        if sym[i] is None:
            out += [model.piece_to_id(f"<0x{x:02X}>") for x in (" " + text)[i].encode()]
        else:
            out.append(piece(sym[i]))
        i = after[i]
    return out


@pytest.mark.parametrize("dropout,seed", [(0.0, 0), (0.1, 20240), (0.5, 3), (1.0, 1)])
def test_pieces_equal_a_plain_agenda(dropout, seed):
    rnd = random.Random(7)
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer(MODEL))
    words = ["the", "naive", "café", "straße", "aaaaaaa", "understanding", "über", "中文字", "🎉", "▁x", "12345", "\n", "  "]
    texts = ["", "a", " ", "  two  spaces ", *(" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 30))) for _ in range(60))]
    texts += ["".join(rnd.choice("abcdeé ") for _ in range(300)) for _ in range(10)]
    keys = np.array([rnd.randrange(-(2**62), 2**62) for _ in texts], dtype=np.int64)
    ids, counts = pieces.Encoder(pieces.Pieces(tokenizer(MODEL)), dropout, seed).encode(texts, keys)
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    for text, key, mine in zip(texts, keys, got):
        assert mine == agenda(model, text, int(key), dropout, seed), text


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_score(model, text, train):
    """log10 probability of one text, a token at a time, in double precision."""
    p = {k: v.astype(np.float64) for k, v in model.weights.items()}
    n, width = gru.WIDTH, gru.PER_CLASS
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    hashes, _, _, _ = word_hashes(*flat(pa.array([" ".join(words)])), Powers())
    ids = [*model.ids(hashes).tolist(), gru.END]
    outside = model.tokens - int(model.counts.sum() - model.counts[gru.UNKNOWN])
    kinds = model.types - int((np.delete(model.counts, gru.UNKNOWN) > 0).sum())
    h, last, total = np.zeros(n), gru.END, 0.0
    for k, token in enumerate(ids):
        x = p["embed"][last] @ p["w"] + p["b"]
        if k == 0:
            h = np.zeros(n)
        u = h @ p["u"]
        z, r = sigmoid(x[:n] + u[:n]), sigmoid(x[n : 2 * n] + u[n : 2 * n])
        c = np.tanh(x[2 * n :] + r * u[2 * n :])
        h = z * h + (1 - z) * c
        a = h @ p["wc"] + p["bc"]
        b = h @ p["wo"][token // width] + p["bo"][token // width]
        total += (a[token // width] - np.log(np.exp(a).sum()) + b[token % width] - np.log(np.exp(b).sum())) / np.log(10)
        if token == gru.UNKNOWN:  # its share of the unknown symbol, by the word's own count
            total += np.log10((train.get(words[k], 0) + 1) / (outside + kinds + 1))
        last = token
    return total


def test_scores_equal_a_plain_loop(spark, monkeypatch):
    rnd = random.Random(12)
    lexicon = [f"w{i}" for i in range(1500)]  # more than the vocabulary holds
    pick = lambda: lexicon[min(int(rnd.expovariate(0.001)), 1499)]
    texts = [" ".join(pick() for _ in range(rnd.randrange(0, 90))) for _ in range(220)] + ["", "Never SEEN words w1", "w2"]
    held = F.col("doc_id") % 5 == 0
    kept, fit = [], gru.fit
    monkeypatch.setattr(gru, "fit", lambda *a: kept.append(fit(*a)) or kept[-1])
    docs = documents(spark, [*enumerate(texts), (1000, None)]).withColumns({c: F.lit(7) for c in ("score", "held_out", "n_tokens", "chunk", "_id")})
    got = by_id(gru.log_likelihood(docs, held))
    train = {}
    for i, t in enumerate(texts):
        if i % 5:
            for w in t.lower().split():
                train[w] = train.get(w, 0) + 1
    assert kept[0].types == len(train) + 1 > gru.VOCABULARY
    for i, t in [*enumerate(texts), (1000, "")]:
        assert got[i][0].score == pytest.approx(plain_score(kept[0], t, train), rel=1e-4, abs=1e-4), t[:60]
        assert got[i][0].n_tokens == len(t.split()) + 1 and got[i][0].held_out == (i % 5 == 0)
