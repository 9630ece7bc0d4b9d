"""Token counts and pieces against the libraries, round trips, awkward cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
import regex
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from mercato.llm import bpe_count, merging, pieces
from mercato.llm.queries import tokenizer
from mercato.llm.ragged import Powers
from tests.llm.conftest import by_id, documents

LETTERS = "ab'stredvlmLL 12 \n\t.,!?-<|>éÉßΣσςİıﬁ中文字ا🎉́\u0085​\x1c\x00٣½▁"


def fuzz(n, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def counting():
    words = bpe_count.Vocabulary(tokenizer("word_bpe_49k.json"))
    table = merging.PairTable(words.keys, np.arange(len(words.keys), dtype=np.int32), words.joined)
    marks = regex.compile("|".join(map(regex.escape, words.special)))
    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    powers = Powers()
    ours = lambda texts: bpe_count.counts_of(texts, words, table, powers, marks).tolist()
    return ours, lambda texts: [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_librarys(counting):
    ours, library = counting
    texts = [*fuzz(3000), "<|endoftext|>a<|startoftext|> x", "'s's'stop ''s !'s don't", "a" * 3000, ""]
    assert ours(texts) == library(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_counts_of_any_text(counting, texts):
    ours, library = counting
    assert ours(texts) == library(texts)


def test_counting_rows(spark, awkward, nothing):
    path = tokenizer("word_bpe_49k.json")
    got = by_id(bpe_count.count_tokens(awkward.withColumn("n_tokens", awkward.n_chars), path, limit=2))
    library = Tokenizer.from_file(path)
    for r in awkward.collect():
        row = got[r.doc_id][0]
        text = r.text or ""
        assert (row.n_bytes, row.n_tokens) == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids))
        assert row.over_limit == (row.n_tokens > 2) and row.source == "s"
    assert len(got[4]) == 2 and got[4][0] == got[4][1]
    assert bpe_count.count_tokens(nothing, path, limit=2).count() == 0


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(tokenizer("piece_bpe_32k.model"))


def test_without_dropout_pieces_equal_the_librarys(model):
    texts = [t.replace("▁", "") for t in fuzz(2000)] + ["the cat  sat\n" * 300, ""]
    ids, counts = pieces.Encoder(model, 0.0, 1).encode(texts, np.arange(len(texts)))
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library.encode(texts)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 1.0])
def test_every_text_comes_back(model, dropout):
    texts = fuzz(1500)
    ids, counts = pieces.Encoder(model, dropout, 9).encode(texts, np.arange(len(texts)))
    assert pieces.decode_ids(model, ids, counts) == texts


def test_dropout_depends_on_seed_and_key_only(model):
    text = ["thinking about international relations " * 20] * 2
    run = lambda seed, keys: pieces.Encoder(model, 0.3, seed).encode(text, np.array(keys))[0].tolist()
    assert run(1, [5, 5]) == run(1, [5, 5])
    assert run(1, [5, 5]) != run(2, [5, 5]) and run(1, [5, 5]) != run(1, [5, 6])
    plain = pieces.Encoder(model, 0.0, 1).encode(text, np.array([5, 5]))[0]
    assert len(run(1, [5, 5])) > len(plain)


def test_rounds_and_heap_agree(model, monkeypatch):
    texts = fuzz(50) + ["thequickbrownfox" * 20, "an ordinary sentence of some length"]
    encoder = pieces.Encoder(model, 0.2, 7)
    rounds = encoder.encode(texts, np.arange(len(texts)))[0]
    monkeypatch.setattr(merging, "LONG", 4)
    assert encoder.encode(texts, np.arange(len(texts)))[0].tolist() == rounds.tolist()


def test_encoding_rows(spark, awkward, nothing):
    path = tokenizer("piece_bpe_32k.model")
    made = pieces.encode(awkward, path, 0.2, 3, check=True)
    back = by_id(pieces.decode(made, path))
    for r in awkward.collect():
        row = back[r.doc_id][0]
        assert row.decoded == (r.text or "") and row.same and row.n_pieces == len(row.piece_ids)
    assert back[4][0] == back[4][1]
    assert pieces.encode(nothing, path, 0.2, 3).count() == 0
    assert documents(spark, [(1, "x")]).columns == ["doc_id", "text", "lang", "source", "n_chars"]
