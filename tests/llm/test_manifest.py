"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from mercato.llm import manifest
from mercato.llm.queries import op13_merkle_manifest
from tests.llm.conftest import frame
from tests.llm.sql import assert_equals_sql


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(digests):
    """Root and each leaf's proof."""
    proofs = [[] for _ in digests]
    level, under = list(digests), [[i] for i in range(len(digests))]
    while len(level) > 1:
        above, beneath = [], []
        for i in range(0, len(level), 2):
            pair = level[i : i + 2]
            for side, leaves in enumerate(under[i : i + 2]):
                other = "-" if len(pair) == 1 else ("L" + pair[0] if side else "R" + pair[1])
                for leaf in leaves:
                    proofs[leaf].append(other)
            above.append(H(*pair))
            beneath.append(sum(under[i : i + 2], []))
        level, under = above, beneath
    return level[0], proofs


def brute(rows):
    """(tree, key, digest) rows to (key, digest, subroot, root, proof) rows."""
    groups = {}
    for t, k, d in rows:
        groups.setdefault(t, []).append((k is None, k or 0, d, k))
    names = sorted(groups, key=lambda t: (t is not None, (t or "").encode()))
    made = {t: tree([r[2] for r in sorted(groups[t])]) for t in names}
    root, above = tree([made[t][0] for t in names])
    out = []
    for t, more in zip(names, above):
        for r, proof in zip(sorted(groups[t]), made[t][1]):
            out.append((r[3], r[2], made[t][0], root, tuple(proof + more)))
    return sorted(out, key=str)


def proved(spark, rows, bits):
    df = frame(spark, rows, "lang string, doc_id long, leaf string").repartition(4)
    got = manifest.prove(df, "lang", "doc_id", bits=bits)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple(r.proof)) for r in got.collect()), key=str)


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_equals_a_plain_tree(spark, bits):
    sizes = {None: 3, "": 1, "de": 2, "en": 23, "fr": 8, "ü": 5, "Z": 17}
    rows = [(t, i * 7 % 101 - 30, H(f"{t}/{i}")) for t, n in sizes.items() for i in range(n)]
    rows += [("en", None, H("none")), ("en", 4, H("same key")), ("en", 4, H("same row")), ("en", 4, H("same row"))]
    assert proved(spark, rows, bits) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 100])
def test_one_tree(spark, n):
    rows = [("x", i, H(str(i))) for i in range(n)]
    assert proved(spark, rows, 2) == brute(rows)


def test_no_rows(spark):
    assert proved(spark, [], 2) == []


def test_blocks_meet(spark):
    """One tree of 5,000 leaves over several rounds of blocks."""
    rows = [("x", i, H(str(i))) for i in range(5000)]
    assert proved(spark, rows, 5) == brute(rows)


def test_sweeps_keep_short_queues():
    """The upward sweep hands out nodes in the order of their labels, children first."""
    nodes = list(manifest.sweep_up(0, [H(str(i)) for i in range(100)], 7))
    labels = [((i + 1) << lv, lv) for lv, i, _ in nodes]
    assert labels == sorted(labels) and len(nodes) == 100 + 50 + 25 + 13 + 7 + 4 + 2 + 1
    down = list(manifest.sweep_down({(lv, i): d for lv, i, d in nodes}, 7, 0, ["-"]))
    assert [i for i, _ in down] == list(range(99, -1, -1))
    assert all(len(p) == 8 for _, p in down)


def test_tampering_shows(spark):
    rows = [("en", i, H(str(i))) for i in range(40)]
    df = frame(spark, rows, "lang string, doc_id long, leaf string")
    claimed = F.when(F.col("doc_id") % 5 == 0, F.sha2("leaf", 256)).otherwise(F.col("leaf"))
    told = manifest.verify(manifest.prove(df.withColumn("claimed", claimed), "lang", "doc_id", keep=["claimed"], bits=3), "claimed")
    for r in told.collect():
        assert r.verified == (r.doc_id % 5 != 0)
        fold = r.claimed
        for p in r.proof:
            fold = H(fold) if p == "-" else H(p[1:], fold) if p[0] == "L" else H(fold, p[1:])
        assert fold == r.folded_root


def test_fields(spark):
    df = frame(spark, [(1, None, "é", ""), (None, 5, None, "abc")], "a long, b int, c string, d string")
    got = df.select(manifest.leaf(*[F.col(c) for c in "abcd"])).collect()
    assert [r[0] for r in got] == [H("1:1", "-", "2:é", "0:"), H("-", "1:5", "-", "3:abc")]


def test_clashing_names(spark):
    df = frame(spark, [("x", i, H(str(i)), i) for i in range(9)], "lang string, doc_id long, leaf string, _at int").withColumn("root", F.lit(1)).withColumn("proof", F.lit(2))
    got = sorted((r.doc_id, r.leaf, r.subroot, r.root, tuple(r.proof)) for r in manifest.prove(df, "lang", "doc_id").collect())
    assert got == brute([("x", i, H(str(i))) for i in range(9)])


def whole(rows):
    """The query's rows from (doc_id, text, lang, source, n_chars) rows."""
    def leaf(i, t, lang, s, n):
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, lang, n, t)])

    made = {}
    for k, d, sub, root, proof in brute([(r[2], r[0], leaf(*r)) for r in rows]):
        made[d] = (sub, root, proof)
    out = []
    for i, t, lang, s, n in rows:
        own = leaf(i, t, lang, s, n)
        sub, root, proof = made[own]
        fold = leaf(i, t, lang, s, None if n is None else n + (zlib.crc32(str("" if i is None else i).encode()) % 7 == 0))
        for p in proof:
            fold = H(fold) if p == "-" else H(p[1:], fold) if p[0] == "L" else H(fold, p[1:])
        out.append((i, own, sub, root, H(*[p[1:] for p in proof if p != "-"]), fold, fold == root))
    return sorted(out, key=str)


def test_query_on_awkward_rows(spark, awkward, nothing, tmp_path):
    docs = awkward.where("doc_id is null or doc_id <> 4").union(frame(spark, [(i, "t", None, None, None) for i in range(20, 40)]))
    docs.withColumn("leaf", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in op13_merkle_manifest(spark, str(tmp_path)).collect()), key=str)
    assert got == whole([tuple(r) for r in docs.collect()])
    nothing.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert op13_merkle_manifest(spark, str(tmp_path / "none")).collect() == []


def test_query(spark):
    assert_equals_sql(spark, "op13_merkle_manifest", op13_merkle_manifest)
