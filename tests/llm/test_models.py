"""URL rules, contamination, toxicity, language and likelihood; queries and the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from mercato.llm import contamination, gru, language, queries, toxicity, url_rules
from mercato.llm.tables import fold
from tests.conftest import DATA
from tests.llm.conftest import by_id, documents, frame

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- op1 ----


def test_written_rules(spark):
    urls = {
        "http://a.org/x": ("a.org", "/x", "org/", "allow"),
        "http://A.Example.ORG/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12?q=/": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "https://x.com/de/1#a": ("x.com", "/de/1", "com/de/", "block"),
        "https://x.com/DE/1": ("x.com", "/DE/1", None, "allow"),
        "https://x.org": ("x.org", "", None, "allow"),
        "https://h?a://b/c": ("h", "", None, "allow"),
        "nothing": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = frame(spark, list(enumerate(urls)), "page_id long, url string")
    labelled = spark.createDataFrame([], "url string, bad int")
    got = url_rules.judge(pages.withColumn("rule", F.lit("clash")), queries.URL_POLICY, labelled)
    assert {r.url: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == urls


def test_mined_rules(spark):
    seen = [(f"http://casino.{d}.net/p/{i}", 1) for d in ("a", "b") for i in range(10)]
    seen += [(f"http://news.{d}.net/p/{i}", 0) for d in ("a", "b") for i in range(20)] + [(None, 1), ("http://x.net/", None)]
    pages = frame(spark, [(1, "http://casino.zz.net/q/1"), (2, "http://news.zz.net/q"), (3, "http://casino.zz.net/q/1")], "page_id long, url string")
    got = by_id(url_rules.judge(pages, [], frame(spark, seen, "url string, bad int")), "page_id")
    assert [got[k][0].verdict for k in (1, 2, 3)] == ["block", "allow", "block"] and got[1][0].mined


def test_op1_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = queries.op1_url_rules(spark, DATA)
    cols = sorted(got.columns)
    want = con.execute(queries.ORACLE["op1_url_rules"])
    names = [c[0] for c in want.description]
    assert sorted(names) == cols
    rows = sorted(tuple(str(r[names.index(c)]) for c in cols) for r in want.fetchall())
    assert sorted(tuple(str(r[c]) for c in cols) for r in got.collect()) == rows


# ---- op2 ----


def planted(seed=3):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    text = lambda n: [rnd.choice(words) for _ in range(n)]
    items = {i: text(30 + i) for i in range(12)} | {50: text(150)}
    docs, want = {}, set()
    for i in range(200):
        body = text(300)
        if i % 10 == 0:
            k = (i // 10) % 12
            leak = list(items[k])
            if i % 20 == 0:  # a paraphrase: an eighth of the words replaced, an eighth gone
                leak = [rnd.choice(words) if rnd.random() < 0.12 else w for w in leak if rnd.random() > 0.12]
            at = rnd.randrange(300)
            body[at:at] = leak
            want.add((i, k))
        docs[i] = " ".join(body)
    docs[500] = " ".join(items[50][70:148]).upper()  # a part of a long item
    want.add((500, 50))
    return docs, {i: " ".join(w) for i, w in items.items()}, want


def test_planted_passages_are_found_and_nothing_else(spark):
    docs, items, want = planted()
    bench = frame(spark, [*items.items(), (90, ""), (91, None)], "item_id long, text string")
    got = contamination.find(documents(spark, docs.items()), bench)
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    assert len(found & want) >= 0.9 * len(want) and not found - want


@pytest.mark.parametrize("around, copies, others", [(20, 2, 1), (0, 30, 60), (0, 3, 0)])
def test_a_leak_that_fills_the_table_is_found(spark, around, copies, others):
    """Its own words are in over a tenth of all units then, in few long texts or in many short ones."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(7))
    leak = [word() for _ in range(40)]
    rows = [(i, " ".join([word() for _ in range(around)] + leak * (i < copies) + [word() for _ in range(around or 8)])) for i in range(copies + others)]
    bench = frame(spark, [(1, " ".join(leak)), (2, " ".join(word() for _ in range(40)))], "item_id long, text string")
    got = contamination.find(documents(spark, rows), bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, 1) for i in range(copies)}


def test_search_recall_against_brute_force(monkeypatch):
    """Latent candidates hold at least nine tenths of what comparing all windows finds."""
    rnd = np.random.default_rng(5)
    lists = [rnd.integers(1, 3000, 30).astype(np.uint64) for _ in range(100)]
    words = np.unique(np.concatenate(lists))
    idf = np.ones(len(words))
    spaces = [contamination.latent(contamination.weighted(lists, words, idf), 80, 0)]
    searcher = contamination.Searcher(lists, np.zeros(100, int), words, idf, spaces)
    hits = 0
    for p, own in enumerate(lists):
        text = np.concatenate([rnd.integers(5000, 9000, 40).astype(np.uint64), own, rnd.integers(5000, 9000, 40).astype(np.uint64)])
        unit = np.arange(len(text)) // contamination.UNIT
        hits += any(q == p for _, q, _ in searcher.candidates(text, unit, np.zeros(unit[-1] + 1, int)))
    assert hits >= 90


@pytest.mark.parametrize("seed", range(5))
def test_common_subsequence(seed):
    rnd = random.Random(seed)
    a, b = ([rnd.randrange(5) for _ in range(rnd.randrange(40))] for _ in range(2))
    row = [0] * (len(b) + 1)
    for x in a:
        old = row
        row = [0]
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(row[-1], old[j + 1]))
    assert contamination.common_words(a, b) == row[-1]


def test_contamination_awkward(spark, awkward, nothing):
    bench = frame(spark, [(1, "no key but some words in it"), (2, None)], "item_id long, text string")
    got = contamination.mark(awkward.withColumn("item_ids", F.lit(1)), bench)
    assert got.count() == awkward.count() and not got.where("contaminated").count()
    assert contamination.mark(nothing, bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert not contamination.mark(awkward, empty).where("contaminated").count()


# ---- op3, op4 ----


def held_out(name, label):
    truth = {r[0]: r[1] for r in label.collect() if r[1] is not None}
    return [(r, truth[r["doc_id"]]) for r in name.where("held_out").collect() if r["doc_id"] in truth]


def test_toxicity_ranks_held_out_texts(spark):
    directory = DATA.replace("0.001", "0.01")
    scored = queries.op3_compression_toxicity(spark, directory)
    rows = held_out(scored, spark.read.parquet(f"{directory}/labels.parquet").select("doc_id", "toxic"))
    bad, fine = ([r["score"] for r, t in rows if t == v] for v in (1, 0))
    wins = np.mean([(x > y) + 0.5 * (x == y) for x in bad for y in fine])
    assert wins > 0.75
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r, _ in rows)


def test_toxicity_of_plain_words(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows = [(i, " ".join(["grobian"] * (i % 4 == 0) + [word() for _ in range(30)])) for i in range(400)]
    labels = frame(spark, [(i, int(i % 4 == 0)) for i in range(0, 400)], "doc_id long, toxic int")
    docs = documents(spark, rows)
    got = by_id(toxicity.score(docs, toxicity.fit(docs, labels, fold(parts=5) != 0)))
    assert all(got[i][0].predicted == (i % 4 == 0) for i in range(400))


def test_toxicity_thresholds_hold_the_true_shares(spark, monkeypatch):
    """Two thirds of the texts with the word are toxic, however few ordinary ones the sample has."""
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", 34)
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows = [(i, " ".join(["grobian"] * (i % 20 == 0) + [word() for _ in range(30)])) for i in range(1000)]
    labels = frame(spark, [(i, int(i % 20 == 0 and i % 60 < 40)) for i in range(1000)], "doc_id long, toxic int")
    docs = documents(spark, rows)
    got = toxicity.score(docs, toxicity.fit(docs, labels, F.lit(True))).where("doc_id % 20 = 0").collect()
    assert abs(np.mean([r.score for r in got]) - 0.68) < 0.05


def test_codes_read_every_word_whole():
    def codes(*texts):
        raw = [x.encode() for x in texts]
        made, counts = toxicity.codes_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), toxicity.Powers())
        return np.split(made, np.cumsum(counts)[:-1])

    long_, other, case = codes("unbearableness ok", "unbearably; OK", "UNBEARABLENESS")
    assert long_[0] != other[0] and long_[1] == other[1] and long_[0] == case[0]
    text = "".join(chr(0x4E00 + 37 * i) for i in range(60))
    whole, tail, mixed, empty, symbol = codes(text, text[-20:], f"что,{text[:2]}—что", "", "🎉")
    assert len(whole) == 59 and len(set(whole)) == 59 and list(whole[-19:]) == list(tail)
    assert len(mixed) == 3 and mixed[0] == mixed[2] and mixed[1] == whole[0] and not len(empty) and len(symbol) == 1
    assert len(codes("слово«слово»")[0]) == 2 and len(codes("ab", "cd")[1]) == 1


def test_language_of_held_out_texts(spark):
    directory = DATA.replace("0.001", "0.01")
    rows = held_out(queries.op4_output_codes(spark, directory), spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "lang"))
    assert np.mean([r["lang_pred"] == lang for r, lang in rows]) > 0.98


def test_codewords_differ():
    for n in (2, 4, 6, 40):
        code = language.codewords(n).astype(int)
        apart = (code[:, None] != code[None]).sum(2)
        assert (apart + np.eye(n, dtype=int)).min() >= 1 and code.shape[0] == n
    assert language.codewords(40).shape[1] >= 50


def test_models_take_awkward_rows(spark, awkward, nothing):
    model = language.fit(awkward, F.lit(True))
    told = by_id(language.predict(awkward.withColumn("score", F.lit("clash")), model))
    assert [told[k][0].lang_pred for k in (1, 2, 3, 8)] == ["und"] * 4 and told[8][0].score == 0
    assert told[7][0].lang_pred == "en" and told[4][0] == told[4][1]
    none = language.fit(nothing, F.lit(True))
    assert {r.lang_pred for r in language.predict(awkward, none).collect()} == {"und"}
    assert language.predict(nothing, model).count() == 0
    labels = frame(spark, [(4, 1), (6, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    fitted = toxicity.fit(awkward, labels, F.lit(True))
    assert toxicity.score(awkward, fitted).count() == awkward.count()
    assert toxicity.fit(nothing, labels, F.lit(True)) is None
    assert {r.score for r in toxicity.score(awkward, None).collect()} == {0.0}


# ---- op8 ----


def test_base_score_is_the_add_one_unigram(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect() if r.doc_id is not None] + [(20 + i, f"a b c{i} A") for i in range(20)]
    words = {i: [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOW)) if x] + [None] for i, t in rows}
    counts = Counter(x for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for x in words[i])
    n, v = sum(counts.values()), len(counts)
    got = by_id(gru.log_likelihood(documents(spark, rows), fold(parts=7) == 2))
    assert len(got[4]) == 2 and got[4][0] == got[4][1]
    for i, w in words.items():
        r = got[i][0]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.start(rng.integers(0, 50, gru.VOCABULARY)).items()}
    x, y = rng.integers(0, gru.VOCABULARY, (2, 5, 3))
    fresh, live = np.zeros((5, 3), bool), np.ones((5, 3), bool)
    fresh[0] = fresh[3, 1] = True
    live[4, 2] = False
    h0 = np.zeros((3, gru.WIDTH))
    g, _ = gru.gradients(p, x, y, fresh, live, h0)

    def loss(q):
        on = live.reshape(-1)
        return -gru.score_window(q, gru.forward(q, x, fresh, h0).reshape(-1, gru.WIDTH)[on], y.reshape(-1)[on]).mean()

    spots = {"embed": (x[1, 0], 3), "w": (2, 5), "u": (1, 40), "b": (7,), "wc": (3, 4), "bc": (2,), "wo": (y[1, 0] // gru.PER_CLASS, 2, y[1, 0] % gru.PER_CLASS), "bo": (y[0, 0] // gru.PER_CLASS, 1)}
    for k, at in spots.items():
        up, down = ({**p, k: p[k].copy()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert math.isclose(g[k][at], (loss(up) - loss(down)) / 2e-5, rel_tol=1e-3, abs_tol=1e-6)


def test_state_runs_through_windows():
    p = gru.start(np.ones(gru.VOCABULARY))
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, gru.VOCABULARY, n).astype(np.int32) for n in (200, 3, 1, 90)]
    together = gru.likelihood(p, texts)
    for t, got in zip(texts, together, strict=True):
        x = np.append(0, t[:-1])[:, None]
        fresh = np.zeros((len(t), 1), bool)
        fresh[0] = True
        states = gru.forward(p, x, fresh, np.zeros((1, gru.WIDTH), np.float32))
        assert math.isclose(got, gru.score_window(p, states[:, 0], t).sum(), rel_tol=1e-4)


def test_the_recurrent_model_beats_the_base(spark):
    r = queries.op8_recurrent_likelihood(spark, DATA.replace("0.001", "0.01")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_a_thousand_words_have_entries_of_their_own(spark, monkeypatch):
    """No word of a corpus of 1,022 different ones is the unknown symbol."""
    models = []
    fit = gru.fit
    monkeypatch.setattr(gru, "fit", lambda *a: models.append(fit(*a)) or models[0])
    text = " ".join(f"w{i}" for i in range(1022))
    assert gru.log_likelihood(documents(spark, [(1, text), (2, text)]), F.lit(False)).count() == 2
    assert models[0].counts[gru.UNKNOWN] == 0 and (models[0].counts[2:1024] == 2).all()


def test_likelihood_without_training_rows(spark, nothing):
    assert gru.log_likelihood(nothing, F.lit(False)).count() == 0
    got = gru.log_likelihood(documents(spark, [(1, "a b"), (None, None)]), F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens) for r in got} == {(0, 0)} and len(got) == 2


# ---- together ----


def test_all_are_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


def test_pipeline_stages(spark):
    rnd = random.Random(12)
    text = lambda k, n: " ".join(f"{rnd.choice('abcdefghij')}{rnd.choice('aeiou')}{rnd.choice('lmnrst')}{rnd.randrange(3)}" for _ in range(n))
    passage, leak = text(0, 60), text(1, 40)
    docs = [(i, text(2, 120)) for i in range(12)]
    docs += [(100, docs[0][1]), (101, docs[1][1] + " more"), (102, "!!! 123"), (103, None), (104, text(3, 50) + " " + leak + " " + text(3, 50))]
    docs += [(105 + k, text(4, 80) + " " + passage + " " + text(4, 80)) for k in range(2)] + [(0, docs[0][1])]
    table = documents(spark, docs)
    bench = frame(spark, [(1, leak)], "item_id long, text string")
    steps = dict(corpus_pipeline.STAGES)
    a = steps["language"](spark, table, DATA)
    assert {r.doc_id for r in a.collect()} == {i for i, _ in docs} - {102, 103}
    b = steps["near copies"](spark, a, DATA)
    assert sorted(r.doc_id for r in b.collect()) == sorted({i for i, _ in docs} - {100, 101, 102, 103})
    c = steps["repeats"](spark, b, DATA)
    kept = {r.doc_id: r for r in c.collect()}
    assert all(passage[20:-20] not in kept[k].text and kept[k].n_chars == len(kept[k].text) for k in (105, 106))
    assert all(kept[i].text == t for i, t in docs if i < 12)
    assert a.columns == b.columns == c.columns == list(corpus_pipeline.COLUMNS)
    d = contamination.mark(c, bench).where("contaminated")
    assert [r.doc_id for r in d.collect()] == [104]
    e = steps["pieces"](spark, steps["benchmark"](spark, c, DATA), DATA)
    assert e.count() == c.count() and e.where("n_pieces = 0").count() == 0


def test_pipeline_on_awkward_tables(spark, awkward, nothing):
    for name, step in corpus_pipeline.STAGES:
        for table in (awkward, nothing):
            got = step(spark, table.withColumn("extra", F.lit(1)), DATA)
            if name != "pieces":
                assert got.columns == list(corpus_pipeline.COLUMNS)
            assert got.count() <= table.count()


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, DATA)
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert 0.8 * n < out.count() < n
