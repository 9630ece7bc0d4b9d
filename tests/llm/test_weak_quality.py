"""Weak supervision: features against plain counting, estimation against known rules."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import weak_quality as wq
from mercato.llm.queries import op11_weak_quality
from tests.llm.conftest import by_id, documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {w: windows.count(w) for w in set(windows)} if len(windows) < 3000 else None
    if seen is None:
        seen = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_letter_words": sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words),
        "n_closed_words": sum(w[-1] in ".!?" for w in words),
        "n_punctuation": len(re.findall(r"[!-/:-@\[-`{-~]", text)),
        "n_digits": len(re.findall(r"[0-9]", text)),
        "n_upper": len(re.findall(r"[A-Z]", text)),
        "n_cased": len(re.findall(r"[A-Za-z]", text)),
    }


def base_failed(f):
    return f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]


TEXTS = [
    None, "", " \n\t\r\x0b\x0c ", "one", "a b c", "a b c a b c", "a b c x a b c\na b c", "l\nl\nl \nl\n\n\nl", "x\ny\r\nx\r\ny", "é é é é\né é é é",
    "# * $ % & | < > ! ?", "a b a b a b", "A b\x1fC d", "ab\nab", "no feed at the end\nno feed at the end", "🎉 中文 " * 30,
    "Aa bB 12 3.4 ... end. Stop! Why?",
]


def test_features_equal_plain_counting(spark):
    rng = np.random.default_rng(1)
    texts = TEXTS + [" ".join(rng.choice(list("ab c\nde"), size=n)) for n in (5, 40, 400, 4000)]
    texts += ["\n".join(" ".join(rng.choice(["x", "y", "zé"], size=4)) for _ in range(200)), "w " * 30_000]
    docs = documents(spark, list(enumerate(texts))).repartition(3)
    for r in wq.features(docs).collect():
        assert {n: r[n] for n in wq.FEATURES} == brute(texts[r.doc_id]), repr(texts[r.doc_id])[:80]


def test_equals_on_the_table(spark):
    """The query's base columns, and its verdicts by a plain estimation from the same votes."""
    path = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op11_weak_quality(spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    assert len(got) == len(docs)
    found = {d.doc_id: brute(d.text) for d in docs}
    judged = plain(list(found.values()))
    for (key, f), p in zip(found.items(), judged):
        r = got[key]
        assert all(r[c] == f[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert r.base_failed == base_failed(f)
        assert r.p_good == pytest.approx(p, abs=1e-6)
        assert r.kept == (not base_failed(f) and p >= 0.5)


def voted(f, rule):
    """A rule's vote by Python's own reading of its conditions."""
    def true(condition):
        c = re.sub(r"(\w+) between (.+?) and (.+?)(?= and |$)", r"(\2 <= \1 <= \3)", condition)
        return eval(c, {}, f)  # noqa: S307

    return -1 if true(rule.bad) else 1 if true(rule.good) else 0


def plain(features):
    """Posteriors by expectation-maximisation text by text."""
    votes = [[voted(f, r) for r in wq.RULES] for f in features]
    n, k = len(votes), len(wq.RULES)
    mass, share, good, bad = 0.002 * n, 0.8, [0.97] * k, [0.3] * k

    def odds(v):
        p, q = share, 1 - share
        for j, x in enumerate(v):
            if x:
                p *= good[j] if x == 1 else 1 - good[j]
                q *= bad[j] if x == -1 else 1 - bad[j]
        return p / (p + q)

    last = None
    for _ in range(200):
        p = [odds(v) for v in votes]
        share = (sum(p) + mass * 0.8) / (n + mass)
        for j in range(k):
            cast = [(x, v[j]) for x, v in zip(p, votes) if v[j]]
            good[j] = (sum(x for x, y in cast if y == 1) + mass * 0.97) / (sum(x for x, _ in cast) + mass)
            bad[j] = (sum(1 - x for x, y in cast if y == -1) + mass * 0.3) / (sum(1 - x for x, _ in cast) + mass)
            good[j] = min(max(good[j], 0.5), 1 - 1e-4)
            bad[j] = min(max(bad[j], 1 - good[j]), 1 - 1e-4)
        if last is not None and abs(share - last) < 1e-9:
            break
        last = share
    return [odds(v) for v in votes]


def test_estimates_known_rules():
    """Votes drawn from known accuracies give these back, and better classes than any one rule."""
    rng = np.random.default_rng(5)
    n, right = 40_000, np.array([0.95, 0.9, 0.85, 0.75, 0.9, 0.8])
    good = rng.random(n) < 0.7
    votes = np.where(rng.random((n, 6)) < right, np.where(good, 1, -1)[:, None], np.where(good, -1, 1)[:, None])
    votes[rng.random((n, 6)) < 0.3] = 0
    kinds, counts = np.unique(votes, axis=0, return_counts=True)
    model = wq.estimate(kinds, counts.astype(float), wq.RULES[:6])
    assert abs(model.share - 0.7) < 0.02
    assert np.abs(np.array(model.right_on_good) - right).max() < 0.03
    assert np.abs(np.array(model.right_on_bad) - right).max() < 0.03
    odds = np.log(model.share / (1 - model.share)) + sum(np.where(votes[:, j] == 1, g, 0) + np.where(votes[:, j] == -1, b, 0) for j, (g, b) in enumerate(model.weights()))
    assert ((odds > 0) == good).mean() > 0.95
    tenfold = wq.estimate(kinds, 10.0 * counts, wq.RULES[:6])
    assert np.allclose(tenfold.right_on_good, model.right_on_good) and np.isclose(tenfold.share, model.share)


def test_verdicts(spark):
    """Prose stays, whatever its length above the least; shouting, symbols and loops go."""
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefghilmnoprstu"), size=rng.integers(2, 9))) for _ in range(900)]
    prose = lambda n: " ".join(str(w) + ("." if i % 11 == 10 else "") + ("\n" if i % 40 == 39 else "") for i, w in enumerate(rng.choice(words, size=n)))
    clean = [(i, prose(60 + i)) for i in range(300)]
    shout = [(1000 + i, prose(120).upper().replace(" ", "!! ")) for i in range(12)]
    symbols = [(2000 + i, prose(120).replace(" ", "### ")) for i in range(12)]
    loops = [(3000 + i, " ".join([prose(9)] * 30)) for i in range(12)]
    got = by_id(wq.judge(documents(spark, clean + shout + symbols + loops)))
    kept = {k for k, rows in got.items() if rows[0].kept}
    assert kept == {k for k, _ in clean}


def test_awkward_rows(spark, awkward, nothing):
    clash = awkward.withColumn("n_words", F.lit(-1)).withColumn("kept", F.lit(True)).withColumn("p_good", F.lit(2.0))
    got = by_id(wq.judge(clash))
    for row in awkward.collect():
        for r in got[row.doc_id]:
            f = brute(row.text)
            assert {n: r[n] for n in wq.FEATURES} == f and r.base_failed == base_failed(f)
            assert 0 <= r.p_good <= 1 and not (r.kept and r.base_failed)
    assert len(got[4]) == 2 and got[4][0] == got[4][1]
    assert wq.judge(nothing).collect() == []


def test_labels_are_met(spark):
    """No label is read, yet the verdicts on texts that pass the base rules are those of the labels."""
    path = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    told = op11_weak_quality(spark, path).where("not base_failed").join(labels, "doc_id").collect()
    assert len(told) > 100 and all(r.kept == (r.quality == 1) for r in told)


def test_other_keys(spark):
    named = frame(spark, [("a", None), (None, "x y z")], "doc_id string, text string")
    assert {r.doc_id: r.n_words for r in wq.judge(named).collect()} == {"a": 0, None: 3}
