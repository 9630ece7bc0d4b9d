"""Removed bytes against brute force: many parts, crowded anchors, copies, runs over piece borders."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mercato.llm import queries, repeats
from mercato.llm.ragged import Powers
from tests.llm.conftest import documents, frame


def brute(texts, least):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) per text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + least] for b in raw for i in range(len(b) - least + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - least + 1):
            if seen[b[i : i + least]] > 1:
                gone[i : i + least] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)) == 1)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), len(edge), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, alphabet):
    rnd = random.Random(seed)
    word = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    passages = [word(n) for n in (30, 39, 40, 41, 80, 300, 1200)]
    texts = [None, "", word(39), word(40), "x" * 500, "ab" * 200]
    for _ in range(60):
        parts = [word(rnd.randrange(0, 120)) if rnd.random() < 0.5 else rnd.choice(passages) for _ in range(rnd.randrange(1, 6))]
        texts.append("".join(parts))
    base = word(700)
    texts += [base[:i] + "!" + base[i + 1 :] for i in range(0, 700, 60)]  # near copies
    texts += [texts[10]] * 9 + [base] * 3 + ["x" * 500, word(39) * 2]
    return texts


@pytest.mark.parametrize("part_bytes,crowded", [(2 << 20, 20_000), (3_000, 20_000), (1 << 20, 3), (2_000, 6)])
@pytest.mark.parametrize("seed,alphabet", [(1, "abcdefgh é\n"), (2, "ab")])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, part_bytes, crowded, seed, alphabet):
    monkeypatch.setattr(repeats, "PART_BYTES", part_bytes)
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    texts = corpus(seed, alphabet)
    docs = documents(spark, list(enumerate(texts))).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs, 40).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 40)


def test_a_long_text_with_a_crowded_anchor(spark, monkeypatch):
    """One text repeats a line very often, so its anchor has too many places for one part."""
    monkeypatch.setattr(repeats, "CROWDED", 50)
    rnd = random.Random(6)
    line = "".join(rnd.choice("abcdefghij") for _ in range(130))
    texts = [line * 300 + "end", "start" + line, "".join(rnd.choice("klmnop") for _ in range(5000)), line[5:] + line[:90]]
    docs = documents(spark, list(enumerate(texts)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs, 60).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 60)


def test_clashing_names_and_text_keys(spark):
    texts = ["p" * 50 + "q", "r" + "p" * 50, "nothing"]
    docs = frame(spark, [(f"k{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("n_bytes", "n_removed", "_key", "_text", "_from", "chunk", "kept_sha256")})
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs, 40).collect()}
    assert [got[f"k{i}"] for i in range(3)] == brute(texts, 40)
    cut = {r.doc_id: r.text for r in repeats.strip_repeats(docs, 40).collect()}
    assert cut == {"k0": "q", "k1": "r", "k2": "nothing"}


def plain_intervals(strings, before, least):
    """Maximal repeats of suffixes given whole: (prefix, members) with different bytes before and after."""
    out = set()
    order = sorted(range(len(strings)), key=lambda i: strings[i])
    for i in order:
        for n in range(least, len(strings[i]) + 1):
            members = [j for j in order if strings[j][:n] == strings[i][:n] and len(strings[j]) >= n]
            follow = {strings[j][n : n + 1] or (None, j) for j in members}
            if len(members) > 1 and len(follow) > 1 and len({before[j] for j in members}) > 1:
                out.add((n, frozenset(members)))
    return out


def test_nested_intervals_equal_brute_force():
    """Stack scan over common prefixes: nested repeats of different lengths, each with all occurrences."""
    rnd = random.Random(11)
    for _ in range(20):
        least = 6
        core = [bytes(rnd.choice(b"ab") for _ in range(10)) for _ in range(3)]
        bodies, owned = [], []
        for _ in range(12):
            c = rnd.choice(core)
            text = c[: rnd.randrange(6, 11)] + bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(0, 4)))
            bodies.append(bytes([1]) + rnd.choice([b"x", b"y"]) + text)
            owned.append(len(text) - least + 1)
        array = repeats.SuffixArray(bodies, np.array(owned), least)
        got = {(d, frozenset(array.order[a : b + 1].tolist())) for d, a, b, maximal in array.intervals() if maximal}
        strings = [bodies[p][2 + s :] for p, s in zip(array.piece, array.step)]
        before = [bodies[p][1 + s] for p, s in zip(array.piece, array.step)]
        assert got == plain_intervals(strings, before, least)


def test_anchors_are_named_by_content_alone():
    rnd = random.Random(3)
    shared = "".join(rnd.choice("abc") for _ in range(60))
    texts = [f"{'u' * i}{shared}{'v' * (9 - i)}" for i in range(9)]
    from mercato.llm.ragged import flat

    text, first, last, gram = repeats.anchors(*flat(pa.array(texts)), 60, Powers())
    place = {int(t): int(g) for t, f, n, g in zip(text, first, last, gram) if f <= t <= n}
    assert len(place) == 9 and len(set(place.values())) == 1


def test_a_task_that_lays_answers_returns_its_memory(monkeypatch):
    """Workers live on, so what a task's arrays took would stay with the executor."""
    returned = []
    monkeypatch.setattr(repeats, "give_back", lambda: returned.append(True))
    assert list(repeats._laid(repeats.LEAST)(iter([]))) == []
    assert returned == [True]


def test_what_is_left_and_what_went_can_be_read(spark, tmp_path):
    """Passages of over 50 words: one of 400 bytes goes, one of 399 stays; the digests follow from spans and kept bytes."""
    rnd = random.Random(8)
    passage = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))[:n]
    long_, short = passage(400), passage(399)
    assert min(len(long_.split()), len(short.split())) > 50
    # The third and fourth share the first byte of their last characters too.
    texts = ["One " + long_ + "x", "Two" + long_, "Three" + long_[::-1] + "é!", "Four" + long_[::-1] + "è?", "Five" + short + "y", "Six" + short, None, "alone"]
    documents(spark, list(enumerate(texts))).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op7_repeat_intervals(spark, str(tmp_path)).collect()}
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for _, r in sorted(got.items())] == brute(texts, 400)
    assert [got[i].repeated for i in range(8)] == [True] * 4 + [False] * 4
    assert [got[i].kept_text for i in range(8)] == ["One x", "Two", "Three\ufffd!", "Four\ufffd?", texts[4], texts[5], "", "alone"]
    for r in repeats.remove_repeats(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect():
        raw = (texts[r.doc_id] or "").encode()
        left = bytearray(raw)
        for a, b in reversed([(s.start, s.end) for s in r.spans]):
            del left[a:b]
        assert bytes(r.kept) == bytes(left) and hashlib.sha256(left).hexdigest() == got[r.doc_id].kept_sha256
