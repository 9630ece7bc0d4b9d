"""Window lengths against direct compression, and the plain form beside the lexicon's."""

from __future__ import annotations

import random

import numpy as np
import zstandard
from pyspark.sql import functions as F

from mercato.llm import queries, text_toxicity, toxicity
from mercato.llm.tables import fold, load
from tests.llm.conftest import by_id, documents, frame

PATH = "/root/testdata/sf0.1"


def length(window, content):
    """One window compressed alone under a raw dictionary."""
    params = zstandard.ZstdCompressionParameters.from_level(3, write_checksum=0, write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return len(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params).compress(window))


def gains(text, model):
    words = text.lower().split()
    gap = []
    for i in range(0, len(words), 8):
        a = text.lower()
        begin = 0
        for _ in range(i):
            begin = a.index(words[_], begin) + len(words[_])
        begin = a.index(words[i], begin)
        end = begin
        for w in words[i : i + 8]:
            end = a.index(w, end) + len(w)
        window = a[begin:end].encode()
        gap.append(length(window, model.ordinary) - length(window, model.toxic))
    return len(gap), sum(gap), sum(max(g, 0) for g in gap)


def test_gains_equal_direct_compression(spark):
    rnd = random.Random(4)
    word = lambda a: "".join(rnd.choice(a) for _ in range(rnd.randrange(2, 9)))
    texts = [" ".join(word("abcdefgh" if i % 3 else "rstuvwxyz") for _ in range(rnd.randrange(1, 60))) for i in range(120)]
    labels = frame(spark, [(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    docs = documents(spark, [*enumerate(texts), (500, None), (501, " \n"), (502, "Über  Ärger\tund mehr")])
    model = text_toxicity.fit(docs, labels, F.lit(True))
    got = by_id(text_toxicity.score(docs.withColumn("gain", F.lit("clash")), model))
    for i, t in [*enumerate(texts[:40])]:
        r = got[i][0]
        assert (r.n_windows, r.gain, r.positive_gain) == gains(t, model)
    assert [tuple(got[k][0][c] for c in ("n_windows", "gain", "positive_gain")) for k in (500, 501)] == [(0, 0, 0)] * 2
    assert got[502][0].n_windows == 1
    bad, fine = ([got[i][0].gain for i in range(120) if (i % 3 == 0) == v] for v in (True, False))
    assert np.mean(bad) > np.mean(fine)
    again = text_toxicity.fit(docs.repartition(7), labels.repartition(5), F.lit(True))
    assert (again.ordinary, again.toxic) == (model.ordinary, model.toxic)  # whatever the layout
    assert text_toxicity.fit(docs, labels.where("toxic = 1"), F.lit(True)) is None


def area(pairs):
    """Chance that a toxic text ranks above an ordinary one."""
    value, label = np.array([p[0] for p in pairs], float), np.array([p[1] for p in pairs])
    order = np.argsort(value, kind="stable")
    rank = np.empty(len(value))
    rank[order] = np.arange(1, len(value) + 1)
    for v in np.unique(value):
        rank[value == v] = rank[value == v].mean()
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_the_lexicon_form_ranks_better_than_the_text_form(spark):
    """The figures in the README: areas on held-out labels of both forms."""
    docs = load(spark, PATH, "documents").select("doc_id", "text")
    labels = load(spark, PATH, "labels").select("doc_id", "toxic")
    marked = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held = marked.where(fold(parts=5) == 0)
    model = text_toxicity.fit(docs, labels, fold(parts=5) != 0)
    plain = text_toxicity.score(docs.join(held, "doc_id"), model).collect()
    areas = {c: area([(r[c], r.toxic) for r in plain]) for c in ("gain", "positive_gain")}
    lexicon = queries.op3_compression_toxicity(spark, PATH).join(held, "doc_id").collect()
    areas["lexicon"] = area([(r.score, r.toxic) for r in lexicon])
    print(areas, len(plain))
    assert areas["lexicon"] > 0.9
    assert max(areas["gain"], areas["positive_gain"]) < areas["lexicon"] - 0.15


def test_scores_do_not_depend_on_the_layout(spark):
    docs = load(spark, PATH.replace("0.1", "0.001"), "documents").select("doc_id", "text")
    labels = load(spark, PATH.replace("0.1", "0.001"), "labels").select("doc_id", "toxic")
    one, two = (toxicity.fit(d, labels, F.lit(True)) for d in (docs.coalesce(1), docs.repartition(9)))
    assert (one.ordinary, one.toxic) == (two.ordinary, two.toxic)
    assert np.array_equal(one.steps, two.steps) and np.array_equal(one.chance, two.chance)
