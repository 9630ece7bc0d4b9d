"""Every stage of the pipeline against a brute-force version on that stage's own input."""

from __future__ import annotations

import os
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from mercato.llm import contamination
from mercato.llm.queries import tokenizer
from mercato.llm.tables import load, stage
from tests.llm.conftest import frame

PATH = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def stages(spark):
    """Rows that go into each stage and come out of the last."""
    docs, out = load(spark, PATH, "documents"), []
    out.append(docs.collect())
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        docs = stage(step(spark, docs, PATH), f"stages-{k}")
        out.append(docs.collect())
    return out


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def test_one_of_each_group_of_near_copies(stages):
    before, after = stages[1], stages[2]
    sets = {r.doc_id: shingles(r.text) for r in before}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    assert sorted(r.doc_id for r in after) == [i for i in ids if find(i) == i]
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id] == r.text for r in after)


def test_repeats_are_cut_and_emptied_rows_go(stages):
    before, after = stages[2], {r.doc_id: r for r in stages[3]}
    least = corpus_pipeline.REPEAT_BYTES
    raw = {r.doc_id: (r.text or "").encode() for r in before}
    seen = Counter(hash(b[i : i + least]) for b in raw.values() for i in range(len(b) - least + 1))
    cut = 0
    for key, b in raw.items():
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - least + 1):
            if seen[hash(b[i : i + least])] > 1:
                gone[i : i + least] = True
        kept, at = [], 0
        for ch in b.decode():
            n = len(ch.encode())
            if not gone[at : at + n].all():
                kept.append(ch)
            at += n
        text = "".join(kept)
        cut += bool(gone.any())
        if b and not text:
            assert key not in after
        else:
            assert (after[key].text or "") == text and (after[key].n_chars or 0) == len(text)
    assert cut and len(after) == len(stages[3])


def test_benchmark_texts_go_and_others_stay(stages, spark):
    """Against the longest common subsequence of every window with every passage."""
    items = [r.text.lower() for r in load(spark, PATH, "benchmark").collect() if r.text]
    kept = {r.doc_id for r in stages[4]}
    gone = [r for r in stages[3] if r.doc_id not in kept]
    number = {}
    code = lambda t: [number.setdefault(w, len(number)) for w in WORD.findall(t.lower())]
    passages = [list(p) for t in items for w in [code(t)] for p in (np.array_split(w, -(-len(w) // contamination.LONGEST)) if w else [])]
    held = [set(p) for p in passages]

    def share(words):
        """The best share of a passage's words in order, in windows of twice its length."""
        best = 0.0
        own = set(words)
        for p, s in zip(passages, held):
            if len(own & s) < 0.5 * len(s):
                continue
            for a in range(0, max(1, len(words) - len(p) + 1), max(1, len(p) // 2)):
                best = max(best, contamination.common_words(p, words[a : a + 2 * len(p)]) / len(p))
        return best

    assert all(share(code(r.text)) >= contamination.PARAPHRASE for r in gone)
    found = {r.doc_id: share(code(r.text or "")) for r in stages[4]}
    assert max(found.values(), default=0) < contamination.SAME


def test_pieces_decode_to_the_text(stages):
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text or "" for r in stages[4]}
    assert len(stages[5]) == len(texts)
    for r in stages[5]:
        raw = b"".join(bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("\u2581", " ").encode() for i in r.piece_ids)
        # The model puts a space before every text.
        assert (raw.decode()[1:] if raw else "") == texts[r.doc_id]
        assert r.n_pieces == len(r.piece_ids)


def test_language_stage_keeps_what_can_be_told(stages):
    before, after = stages[0], {r.doc_id: r for r in stages[1]}
    for r in before:
        if not any(c.isalpha() for c in r.text or ""):
            assert r.doc_id not in after
    assert len(after) >= 0.95 * sum(any(c.isalpha() for c in r.text or "") for r in before)
    assert all(r.lang for r in after.values())


def test_run_is_the_stages_one_after_the_other(spark, stages):
    got = corpus_pipeline.run(spark, PATH)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in stages[-1])


def test_stages_on_awkward_rows(spark, awkward, nothing, tmp_path):
    path = os.path.join(str(tmp_path), "t")
    load(spark, PATH, "benchmark").write.parquet(f"{path}/benchmark.parquet")
    for docs in (awkward, nothing):
        docs = stage(docs, "awkward")
        for k, (_, step) in enumerate(corpus_pipeline.STAGES):
            docs = stage(step(spark, docs, path), f"awkward-{k}")
            if k < 4:
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.count() >= 0
    only = frame(spark, [(1, "ab " * 100, "en", "s", 300), (2, "ab " * 100 + "c", "en", "s", 301)])
    assert corpus_pipeline.without_repeats(spark, only, path).select("doc_id", "text").collect() == [(2, "c")]
