"""Jaccard components, repeats and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mercato.llm import components, fingerprints, jaccard, repeats
from mercato.llm.ragged import Powers
from tests.llm.conftest import by_id, documents

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOW)) if x]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            k = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * k >= 75 * len(sets[a] | sets[b]):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


def family(seed, copies, words=60, edits=4):
    """A text and near copies of it."""
    rnd = random.Random(seed)
    base = [f"b{seed}x{rnd.randrange(200)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randrange(edits)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        out.append(" ".join(w).capitalize())
    return out


@pytest.fixture(scope="module")
def near_texts():
    rnd = random.Random(1)
    texts = family(1, 60) + family(2, 5, 20, 2) + family(3, 3, 200, 9)
    passage = " ".join(f"common{i}" for i in range(30))
    texts += [" ".join(f"u{rnd.randrange(10**6)}" for _ in range(40)) + " " + passage for _ in range(50)]
    texts += ["only four words here", "Only four words here", "five", "", " "]
    return dict(enumerate(texts))


@pytest.mark.parametrize("short, block", [(32, 256), (3, 4), (3, 256)])
def test_components_are_exact(spark, near_texts, monkeypatch, short, block):
    """With short lists cut low, nearly everything goes through leaders and blocks."""
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    got = jaccard.near_components(documents(spark, near_texts.items()))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(near_texts)


def test_fragments_do_not_change_the_answer(spark, near_texts, monkeypatch):
    monkeypatch.setattr(jaccard, "FRAGMENT_BYTES", 1000)
    monkeypatch.setattr(jaccard, "CHUNK", 2000)
    got = jaccard.near_components(documents(spark, near_texts.items()).repartition(5))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(near_texts)


def test_near_awkward(spark, awkward, nothing):
    got = by_id(jaccard.near_components(awkward))
    assert [(r.n_shingles, r.component_id) for k in (1, 2, 3) for r in got[k]] == [(0, 1), (0, 2), (0, 3)]
    assert {r.component_id for k in (4, 5) for r in got[k]} == {4} and len(got[4]) == 2
    assert got[None][0].component_id is None and got[None][0].n_shingles == 3
    assert got[6][0].component_id == 6
    assert jaccard.near_components(nothing).count() == 0


def test_chain_and_loops_of_links(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 201), (201, 200), (None, 3)]
    got = components.components(spark.createDataFrame(pairs, "a long, b long"))
    assert {(r.node, r.component) for r in got.collect()} == {(i, 0) for i in range(41)} | {(200, 200), (201, 200)}


def brute_repeats(texts, least):
    raw = {i: (t or "").encode() for i, t in texts}
    seen = Counter(b[k : k + least] for b in raw.values() for k in range(len(b) - least + 1))
    out = {}
    for i, b in raw.items():
        hit = np.zeros(len(b) + 1, dtype=int)
        for k in range(len(b) - least + 1):
            if seen[b[k : k + least]] > 1:
                hit[k : k + least] = 1
        kept = bytes(c for c, h in zip(b, hit, strict=False) if not h)
        out[i] = (len(b), int(hit.sum()), int((np.diff(np.concatenate([[0], hit])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def repeat_texts(seed=2):
    rnd = random.Random(seed)
    noise = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    p, q = noise(70), noise(45)
    texts = [noise(30) + p + noise(20), p, noise(10) + q + noise(5) + q, q[:-1], "x" * 90, noise(200), None, "", p[:40] + noise(9), noise(50) + p]
    return list(enumerate(texts))


@pytest.mark.parametrize("crowded", [20_000, 1])
def test_removed_bytes_are_exact(spark, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    texts = repeat_texts()
    got = repeats.remove_repeats(documents(spark, texts), 40)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()} == brute_repeats(texts, 40)


def test_stripping_keeps_whole_characters(spark):
    p = "é" * 3 + "".join(chr(97 + i % 26) for i in range(60))
    texts = [(1, "Ãx" + p), (2, "Éy" + p + "é"), (3, None), (4, "alone")]
    got = {r.doc_id: r.text for r in repeats.strip_repeats(documents(spark, texts), 40).collect()}
    assert got == {1: "Ãx", 2: "Éyé", 3: None, 4: "alone"}


def test_maximal_repeats_have_all_occurrences(spark):
    p = "".join(chr(97 + i * i % 26) + str(i) for i in range(30))
    texts = [(1, "A" + p + "B"), (2, "C" + p + "D"), (3, "E" + p + "F"), (4, "nothing of it " * 9)]
    rows = [r for r in repeats.maximal_repeats(documents(spark, texts), 60).collect() if r.doc_id < 4]
    whole = [r for r in rows if r.start == 1]
    assert sorted(r.doc_id for r in whole) == [1, 2, 3] and len({r.repeat_id for r in whole}) == 1


def test_repeats_awkward(spark, awkward, nothing):
    got = by_id(repeats.remove_repeats(awkward, 3))
    assert [r.n_removed for r in got[4]] == [3, 3] and got[5][0].n_removed == 3
    assert got[1][0].n_bytes == 0 and got[None][0].n_bytes == 27
    assert repeats.remove_repeats(nothing).count() == 0
    assert repeats.strip_repeats(nothing).count() == 0


def likeness(a, b):
    """Generalised Jaccard of word pair counts."""

    def bag(t):
        w = t.translate(LOW).split()
        return Counter(zip(w, w[1:], strict=False)) if len(w) > 1 else Counter(w)

    x, y = bag(a), bag(b)
    keys = set(x) | set(y)
    return sum(min(x[k], y[k]) for k in keys) / max(1, sum(max(x[k], y[k]) for k in keys))


def test_collision_rate_is_generalised_jaccard():
    rnd = random.Random(4)
    word = lambda: f"w{rnd.randrange(8)}"
    for share in (0.0, 0.3, 0.7, 1.0):
        a = [word() for _ in range(400)]
        b = [x if rnd.random() < share else word() for x in a]
        s = fingerprints.signatures([" ".join(a), " ".join(b)], Powers(), 2048)
        assert abs((s[0] == s[1]).mean() - likeness(" ".join(a), " ".join(b))) < 0.05


def test_edited_neighbours(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BUCKET_BYTES", 40)  # several ranges
    texts = [(3, "gamma delta epsilon zeta"), (1, "alpha béta gamma"), (2, ""), (7, None), (9, "alpha béta gamma"), (8, "x y z")]
    got = {r.doc_id: r for r in fingerprints.edited_neighbours(documents(spark, texts)).collect()}
    order = sorted(texts)
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert got[1].fingerprint == got[9].fingerprint and got[9].near_next == 1.0
    assert got[2].fingerprint == got[7].fingerprint == "0" * 256 and got[2].near_next == 0.0
    assert got[2].near_edited == 1.0


def test_fingerprints_awkward(spark, awkward, nothing):
    got = fingerprints.edited_neighbours(awkward.withColumn("fingerprint", F.lit(1)))
    assert got.count() == awkward.count() and got.where("near_edited is null").count() == 0
    assert fingerprints.edited_neighbours(nothing).count() == 0
    one = documents(awkward.sparkSession, [(1, "just one text here")])
    assert fingerprints.edited_neighbours(one).first().near_next == 1.0


def test_anchor_is_the_same_wherever_a_string_stands():
    rnd = random.Random(6)
    s = "".join(rnd.choice("abc") for _ in range(60))
    found = []
    for text in (s, "zz" + s, s + "q", "abcabc" + s + "ab"):
        from mercato.llm.ragged import flat

        doc, first, last, gram = repeats.anchors(*flat(pa.array([text])), 60, Powers())
        at = text.index(s)
        k = next(i for i in range(len(doc)) if first[i] <= at <= last[i])
        found.append(int(gram[k]))
    assert len(set(found)) == 1


def test_components_of_text_keys(spark):
    """Keys keep their type; the smallest text names a component."""
    base = " ".join(f"w{i}" for i in range(60))
    texts = {"b": base, "a": base + " more", "z": base, "é": "something else entirely of more words", None: base, "e": ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string").withColumn("n_shingles", F.lit(9)).withColumn("cid", F.lit(1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_components(docs).collect()}
    assert got == {"b": (56, "a"), "a": (57, "a"), "z": (56, "a"), "é": (2, "é"), None: (56, None), "e": (0, "e")}


def test_bands_of_length_lose_no_link(spark, monkeypatch):
    """Sets of all sizes that share one crowded shingle list; links sit right at the bound."""
    monkeypatch.setattr(jaccard, "SHORT", 2)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 3)
    common = [f"c{i}" for i in range(24)]
    texts = []
    for n in range(0, 40):
        texts.append((n, " ".join([*common, *[f"t{n % 4}x{i}" for i in range(n // 3)]])))
        texts.append((100 + n, " ".join([*[f"h{n}y{i}" for i in range(n)], *common])))
    got = {r.doc_id: r.component_id for r in jaccard.near_components(documents(spark, texts)).collect()}
    words = {i: t.split() for i, t in texts}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in words.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert got == {i: find(i) for i in sets}
