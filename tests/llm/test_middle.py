"""Fill-in-middle against plain slicing, and the wavelet matrix against counting."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import middle
from mercato.llm.queries import op12_fill_in_middle
from mercato.llm.ragged import flat
from tests.llm.conftest import by_id, documents, frame
from tests.llm.sql import assert_equals_sql

PATTERNS = {"line": r"[^\n]*\n|[^\n]+", "char": r"(?s)."}


def units(text, unit):
    if unit != "word":
        return re.findall(PATTERNS[unit], text)
    at = [m.start() for m in re.finditer(r"[^ \t-\r]+", text)]
    return [text[0 if i == 0 else a : b] for i, (a, b) in enumerate(zip(at, [*at[1:], len(text)]))] if at else []


def brute(key, text, unit="line", rate=100, spm=50, seed=7):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    u = units(text, unit)
    n = len(u)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if text == "" or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not u:
        s = text
    assert p + m + s == text
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return n, form, len(p), len(m), out


TEXTS = [
    None, "", "\n", "\n\n\n", "one", "a\nb", "a\nb\n", "ä\nöü\n\n中文🎉\nlast", "x <P> y\nz", "<S", "<\n<S\n>M>\n", "  \t\n ",
    " lead\ttail ", "\r\nwin\r\n", "é" * 300 + "\n" + "line\n" * 50, "\n".join(f"row {i} of some words" for i in range(5000)),
]


@pytest.mark.parametrize("unit", ["line", "word", "char"])
@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (100, 100)])
def test_equals_plain_slicing(spark, unit, rate, spm):
    rows = [(i * 100 + k, t) for i, t in enumerate(TEXTS) for k in range(6)]
    docs = documents(spark, rows).repartition(3)
    made = middle.transform(docs, unit=unit, rate=rate, spm=spm).withColumn("back", middle.restored())
    got = {r.doc_id: r for r in made.collect()}
    assert len(got) == len(rows)
    for key, text in rows:
        r = got[key]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(key, text, unit, rate, spm), (key, text)
        assert r.back == (text or "")


def test_awkward_rows(spark, awkward, nothing):
    clash = awkward.withColumn("n", F.lit(5)).withColumn("form", F.lit("x")).withColumn("output", F.lit("y")).withColumn("_key", F.lit(1))
    got = by_id(middle.transform(clash))
    for row in awkward.collect():
        same = got[row.doc_id]
        assert all((r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(row.doc_id, row.text) for r in same)
    assert len(got[4]) == 2
    assert middle.transform(nothing).collect() == []
    named = frame(spark, [("b", "x\ny\nz"), (None, "q\nr")], "doc_id string, text string")
    assert {r.doc_id: r.output for r in middle.transform(named).collect()} == {k: brute(k, t)[4] for k, t in (("b", "x\ny\nz"), (None, "q\nr"))}


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for size in (0, 1, 63, 64, 65, 1000):
        classes = rng.integers(0, 4, size).astype(np.uint8)
        matrix = middle.WaveletMatrix(classes)
        at = np.arange(size + 1)
        for kind in range(4):
            assert matrix.rank(kind, at).tolist() == [int((classes[:i] == kind).sum()) for i in at]
    start, end = np.array([100, 100, 100]), np.array([900, 900, 900])
    found = matrix.locate((1, 3), start, end, np.array([0, 7, 5000]))
    seventh = 101 + int(np.flatnonzero(np.isin(classes[100:900], (1, 3)))[6])
    assert found.tolist() == [100, seventh, 900]


def test_classes():
    import pyarrow as pa

    data, offsets = flat(pa.array(["ab c", "d\né", ""]))
    assert middle.byte_classes(data, offsets).tolist() == [2, 0, 0, 2, 2, 1, 2, 3]


def test_query(spark):
    assert_equals_sql(spark, "op12_fill_in_middle", op12_fill_in_middle)
