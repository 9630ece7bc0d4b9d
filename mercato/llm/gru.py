"""Log-likelihood of whole documents under a gated recurrent language model.

Words are counted over all training documents. The most frequent ones and the end of a text are
the recurrent model's vocabulary, in classes by frequency; every other word is the unknown symbol
times its own share among such words, so the model gives each text a proper probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm.ragged import Powers, binary, blocks, flat, lean, word_hashes
from mercato.llm.tables import stage

CLASSES, PER_CLASS = 32, 32
VOCABULARY = CLASSES * PER_CLASS  # the end, the unknown, and the most frequent words
WIDTH = 16
WINDOW = 16  # steps of truncated backpropagation
STREAMS = 256
STRETCH = 256  # tokens of a text that training takes at a time
ROUNDS = 3
RATE = 0.01
CHUNK = 4 << 20
TOGETHER = 800_000  # tokens that run side by side when texts are scored
PART_BYTES = 16 << 20  # of text whose words share one part of the count
END, UNKNOWN = 0, 1


# ---- the network ----


def sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.tanh(x * np.float32(0.5))
    x += 1
    x *= np.float32(0.5)
    return x


def start(counts: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """First weights; the output biases give the words' own frequencies."""
    rng = np.random.default_rng(seed)
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    share = (counts + 1.0).reshape(CLASSES, PER_CLASS)
    return {
        "embed": small(VOCABULARY, WIDTH), "w": small(WIDTH, 3 * WIDTH) * 3, "u": small(WIDTH, 3 * WIDTH) * 3, "b": np.zeros(3 * WIDTH, np.float32),
        "wc": small(WIDTH, CLASSES), "bc": np.log(share.sum(1) / share.sum()).astype(np.float32),
        "wo": small(CLASSES, WIDTH, PER_CLASS), "bo": np.log(share / share.sum(1, keepdims=True)).astype(np.float32),
    }


def forward(p: dict[str, np.ndarray], x: np.ndarray, fresh: np.ndarray, h: np.ndarray, tape: list | None = None) -> np.ndarray:
    """States before each target of a window; x is the token before, fresh where a text begins."""
    n = WIDTH
    pre = (p["embed"] @ p["w"] + p["b"])[x]
    states = np.empty((*x.shape, n), dtype=h.dtype)
    begins = fresh.any(1)
    u = p["u"]
    for t in range(x.shape[0]):
        if begins[t]:
            h = np.where(fresh[t][:, None], h.dtype.type(0), h)
        g, k = pre[t], h @ u
        zr = sigmoid(g[:, : 2 * n] + k[:, : 2 * n])
        z, r, k = zr[:, :n], zr[:, n:], k[:, 2 * n :]
        c = np.tanh(g[:, 2 * n :] + r * k)
        if tape is not None:
            tape.append((h, z, r, c, k))
        new = states[t]
        np.subtract(h, c, out=new)
        new *= z
        new += c
        h = new
    return states


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def by_class(cls: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(cls, kind="stable")
    bounds = np.searchsorted(cls[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        if bounds[c] < bounds[c + 1]:
            yield c, order[bounds[c] : bounds[c + 1]]


def score_window(p: dict[str, np.ndarray], h: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural log probability of each target."""
    cls, word = y // PER_CLASS, y % PER_CLASS
    out = log_softmax(h @ p["wc"] + p["bc"])[np.arange(len(y)), cls].astype(np.float64)
    for c, at in by_class(cls):
        out[at] += log_softmax(h[at] @ p["wo"][c] + p["bo"][c])[np.arange(len(at)), word[at]]
    return out


def gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, fresh: np.ndarray, live: np.ndarray, h0: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Mean gradient of one window and the last state; y and live are (steps, streams)."""
    n = WIDTH
    tape: list = []
    states = forward(p, x, fresh, h0, tape)
    flat_h, flat_y = states.reshape(-1, n), y.reshape(-1)
    on = np.flatnonzero(live.reshape(-1))
    scale = np.float32(1 / max(1, len(on)))
    g = {k: np.zeros_like(v) for k, v in p.items()}
    h, target = flat_h[on], flat_y[on]
    cls, word = target // PER_CLASS, target % PER_CLASS
    d = np.exp(log_softmax(h @ p["wc"] + p["bc"]))
    d[np.arange(len(on)), cls] -= 1
    d *= scale
    g["wc"], g["bc"] = h.T @ d, d.sum(0)
    dh = d @ p["wc"].T
    for c, at in by_class(cls):
        e = np.exp(log_softmax(h[at] @ p["wo"][c] + p["bo"][c]))
        e[np.arange(len(at)), word[at]] -= 1
        e *= scale
        g["wo"][c], g["bo"][c] = h[at].T @ e, e.sum(0)
        dh[at] += e @ p["wo"][c].T
    back = np.zeros_like(flat_h)
    back[on] = dh
    back = back.reshape(states.shape)
    carry = np.zeros_like(h0)
    da = np.empty((*x.shape, 3 * n), np.float32)
    for t in range(x.shape[0] - 1, -1, -1):
        h, z, r, c, k = tape[t]
        dnew = back[t] + carry
        dc = dnew * (1 - z) * (1 - c * c)
        dz = dnew * (h - c) * z * (1 - z)
        dr = dc * k * r * (1 - r)
        da[t] = np.concatenate([dz, dr, dc], 1)
        du = np.concatenate([dz, dr, dc * r], 1)
        g["u"] += h.T @ du
        carry = np.where(fresh[t][:, None], np.float32(0), dnew * z + du @ p["u"].T)
    a = da.reshape(-1, 3 * n)
    g["b"] = a.sum(0)
    seen = np.bincount(x.reshape(-1), minlength=VOCABULARY) > 0
    index = x.reshape(-1)
    order = np.argsort(index, kind="stable")
    sums = np.add.reduceat(a[order], np.searchsorted(index[order], np.flatnonzero(seen)), axis=0)
    g["w"] = p["embed"][seen].T @ sums
    g["embed"][seen] = sums @ p["w"].T
    return g, states[-1]


def laid_out(tokens: list[np.ndarray], most: int = STREAMS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other in up to ``most`` streams: targets, begins, text of each, live ones a step.

    Longest first to the shortest stream; streams are ordered by length, so those still running
    are always the first ones.
    """
    size = np.array([len(t) for t in tokens])
    # More streams than this would not end sooner, because the longest text runs in one.
    width = max(1, min(most, len(tokens), int(1.3 * size.sum() / size.max()) + 1)) if len(size) else 0
    streams: list[list[int]] = [[] for _ in range(width)]
    load = np.zeros(width, dtype=np.int64)
    for i in np.argsort(-size, kind="stable"):
        s = int(load.argmin())
        streams[s].append(int(i))
        load[s] += size[i]
    order = np.argsort(-load, kind="stable")
    steps = int(load.max())
    y = np.zeros((steps, width), dtype=np.int32)
    fresh = np.zeros((steps, width), dtype=bool)
    owner = np.zeros((steps, width), dtype=np.int32)
    for col, s in enumerate(order):
        at = 0
        for i in streams[s]:
            y[at : at + size[i], col] = tokens[i]
            owner[at : at + size[i], col] = i
            fresh[at, col] = True
            at += size[i]
    running = np.searchsorted(-load[order], -np.arange(steps), "left")
    return y, fresh, owner, running


def windows(y: np.ndarray, fresh: np.ndarray, running: np.ndarray, size: int) -> Iterator[tuple]:
    x = np.zeros_like(y)
    x[1:] = y[:-1]
    x[fresh] = END
    for a in range(0, len(y), size):
        b = min(a + size, len(y))
        n = int(running[a])
        live = np.arange(n)[None] < running[a:b, None]
        yield a, b, n, x[a:b, :n], y[a:b, :n], fresh[a:b, :n], live


def train(p: dict[str, np.ndarray], chunks: Iterator[list[np.ndarray]]) -> tuple[dict[str, np.ndarray], int]:
    """Truncated backpropagation over the texts of the chunks, state carried from window to window."""
    p = {k: v.copy() for k, v in p.items()}
    m, s = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    step = total = 0
    for tokens in chunks:
        # A long text is learned in stretches, so that one of them does not run alone for long.
        y, fresh, _, running = laid_out([t[a : a + STRETCH] for t in tokens for a in range(0, len(t), STRETCH)], 2 * STREAMS)
        h = np.zeros((y.shape[1], WIDTH), np.float32)
        for _, _, n, x, t, f, live in windows(y, fresh, running, WINDOW):
            g, h = gradients(p, x, t, f, live, h[:n])
            step += 1
            total += int(live.sum())
            for k in p:
                d = np.clip(g[k], -0.1, 0.1)
                m[k] += 0.1 * (d - m[k])
                s[k] += 0.01 * (d * d - s[k])
                fix = RATE / (1 - 0.9**step)
                p[k] -= (fix * m[k] / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return p, total


def likelihood(p: dict[str, np.ndarray], tokens: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each whole text; the state runs through all its windows."""
    y, fresh, owner, running = laid_out(tokens, 2 * STREAMS)
    out = np.zeros(len(tokens))
    h = np.zeros((y.shape[1], WIDTH), np.float32)
    for a, b, n, x, t, f, live in windows(y, fresh, running, 2 * WINDOW):
        states = forward(p, x, f, h[:n])
        h = states[-1]
        on = live.reshape(-1)
        got = score_window(p, states.reshape(-1, WIDTH)[on], t.reshape(-1)[on])
        out += np.bincount(owner[a:b, :n].reshape(-1)[on], weights=got, minlength=len(out))
    return out


# ---- the corpus ----


@dataclass
class Model:
    words: np.ndarray  # sorted hashes of the vocabulary's words
    index: np.ndarray  # their places in the vocabulary
    counts: np.ndarray  # training count of every vocabulary entry
    weights: dict[str, np.ndarray]
    tokens: int  # N
    types: int  # V

    def ids(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(words), UNKNOWN, np.int32)
        at = np.searchsorted(self.words, words).clip(0, len(self.words) - 1)
        return np.where(self.words[at] == words, self.index[at], UNKNOWN).astype(np.int32)


def texts_of(batch: pa.RecordBatch, i: int, model: Model) -> list[np.ndarray]:
    """Vocabulary entries of each text of a chunk, the end included."""
    ids = model.ids(np.frombuffer(batch.column("words")[i].as_py(), np.uint64))
    tokens = ids[np.frombuffer(batch.column("tokens")[i].as_py(), np.uint32)]
    counts = np.frombuffer(batch.column("counts")[i].as_py(), np.int64)
    ends = np.cumsum(counts)
    return [np.append(tokens[b - n : b], np.int32(END)) for b, n in zip(ends, counts, strict=True)]


NAMES = ["chunk", "ids", "rids", "held", "counts", "tokens", "words", "trained"]


def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk of texts: its distinct words, training counts, and its texts as places in them."""
    powers, at, row = Powers(), TaskContext.get().partitionId() << 32, TaskContext.get().partitionId() << 40
    for batch in blocks(batches, CHUNK):
        words, counts = [], []
        for part in blocks(iter([batch])):
            w, c, _, _ = word_hashes(*flat(part.column("text")), powers)
            words.append(w), counts.append(c)
        words, counts = np.concatenate(words), np.concatenate(counts)
        held = batch.column("held_out").to_numpy(zero_copy_only=False)
        value, tokens = np.unique(words, return_inverse=True)
        trained = np.bincount(tokens[np.repeat(~held, counts)], minlength=len(value))
        n = batch.num_rows
        ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column("_id"))
        one = [np.arange(row, row + n)], [held], [counts.astype(np.int64)], [tokens.astype(np.uint32)], [value], [trained.astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), ids, *map(binary, one)], names=NAMES)
        at, row = at + 1, row + n


def dealt(parts: int):
    """Each part of the count gets its words of every chunk and their occurrences per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                take = lambda name, kind: np.frombuffer(batch.column(name)[i].as_py(), kind)  # noqa: B023, E731
                rids, counts, tokens, words, trained = take("rids", np.int64), take("counts", np.int64), take("tokens", np.uint32), take("words", np.uint64), take("trained", np.int64)
                text = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
                pair, times = np.unique(text << 32 | tokens, return_counts=True)
                text, word = pair >> 32, pair & 0xFFFFFFFF
                part = (words % np.uint64(parts)).astype(np.int64)
                # One stable sort of the words and one of the pairs: a part is then a slice of each.
                by_part = np.argsort(part, kind="stable")
                edges = np.searchsorted(part[by_part], np.arange(parts + 1))
                place = np.empty(len(words), dtype=np.int64)
                place[by_part] = np.arange(len(words)) - edges[part[by_part]]
                pairs = np.argsort(part[word], kind="stable")
                text, word, times = text[pairs], word[pairs], times[pairs]
                bounds = np.searchsorted(part[word], np.arange(parts + 1))
                place, words, trained = place[word], words[by_part], trained[by_part]
                for f in np.flatnonzero(np.diff(edges)).tolist():
                    x, y = bounds[f], bounds[f + 1]
                    new = np.flatnonzero(np.concatenate([[True], text[x + 1 : y] != text[x : y - 1]]))
                    held = slice(edges[f], edges[f + 1])
                    made = [text[x:y][new].astype(np.uint32)], [np.diff(np.append(new, y - x)).astype(np.int32)], [place[x:y].astype(np.uint32)], [times[x:y].astype(np.uint32)], [words[held]], [trained[held]]
                    yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), batch.column("chunk").slice(i, 1), pa.array(rids[:1]), *map(binary, made)], names=["part", "chunk", "base", "rids", "sizes", "word", "times", "words", "trained"])

    return run


def count_part(table: pa.Table) -> pa.Table:
    """Sums of one part: a row per chunk with its texts, the most frequent words, and the totals."""
    take = lambda name, kind: [np.frombuffer(x.as_py(), kind) for x in table.column(name)]
    words = take("words", np.uint64)
    value, back = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(back, weights=np.concatenate(take("trained", np.int64)), minlength=len(value)).astype(np.int64)
    chunks, rids, logs, known = [], [], [], []
    edges = np.cumsum([0, *map(len, words)])
    log = np.log10(total + 1.0)
    for i, (chunk, base, r, size, word, times) in enumerate(zip(table.column("chunk").to_pylist(), table.column("base").to_pylist(), take("rids", np.uint32), take("sizes", np.int32), take("word", np.uint32), take("times", np.uint32), strict=True)):
        if not len(r):
            continue
        at = back[edges[i] : edges[i + 1]][word]
        begin = np.cumsum(size) - size
        chunks.append(chunk)
        rids.append(r.astype(np.int64) + base)  # a chunk numbers its texts in a row
        logs.append(np.add.reduceat(log[at] * times, begin))
        known.append(np.add.reduceat(np.where(total[at] > 0, times, 0).astype(np.int64), begin))
    best = np.lexsort((value, -total))[:VOCABULARY]
    best = best[total[best] > 0]
    n, m = len(rids), len(best)
    wide = lambda x, kind, a, b: pa.concat_arrays([pa.nulls(a, kind), x if isinstance(x, pa.Array) else pa.array(x, kind), pa.nulls(b, kind)])
    return pa.table({
        "chunk": wide(chunks, pa.int64(), 0, m + 1),
        "rids": wide(binary(rids), pa.binary(), 0, m + 1),
        "logs": wide(binary(logs), pa.binary(), 0, m + 1),
        "known": wide(binary(known), pa.binary(), 0, m + 1),
        "word": wide(value[best].view(np.int64), pa.int64(), n, 1),
        "n": wide([*total[best].tolist(), int(total.sum())], pa.int64(), n, 0),
        "types": wide([int((total > 0).sum())], pa.int64(), n + m, 0),
    })


def summed(table: pa.Table) -> pa.Table:
    """Of one chunk: the sums over all parts for each of its texts."""
    take = lambda name, kind: np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])
    rid, at = np.unique(take("rids", np.int64), return_inverse=True)
    logs = np.bincount(at, weights=take("logs", np.float64), minlength=len(rid))
    known = np.bincount(at, weights=take("known", np.int64), minlength=len(rid)).astype(np.int64)
    return pa.table({"rid": pa.array(rid), "logs": pa.array(logs), "known": pa.array(known)})


def log_likelihood(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Key, held_out, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    Tokens are words (A-Z lower-cased) and one end; null texts are empty. Counts, N and V come from
    all rows that are not ``held_out``; base_score is their add-one unigram log10 probability and
    score that of the recurrent model, which sees every training text once: its chunks fall into
    ``rounds``, each task of a round trains on its own from the last weights, and the results are
    averaged by tokens. Repeated rows are scored each; a null key stays null. Without training
    rows the model keeps its first weights.
    """
    slim = docs.select(F.col(key).alias("_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(total // PART_BYTES) + 1
    kind = slim.select(F.lit(0).cast("long").alias("chunk"), F.array("_id").alias("ids")).schema
    for name in NAMES[2:]:
        kind = kind.add(name, "binary")
    chunks = stage(slim.select("_id", "held_out", "text").mapInArrow(summarise, kind), "lm-chunks")
    counted = chunks.drop("ids").mapInArrow(dealt(parts), "part int, chunk long, base long, rids binary, sizes binary, word binary, times binary, words binary, trained binary")
    counted = stage(counted.groupBy("part").applyInArrow(lean(count_part), "chunk long, rids binary, logs binary, known binary, word long, n long, types long"), "lm-counts")
    sums = counted.where("chunk is not null").groupBy("chunk").applyInArrow(lean(summed), "rid long, logs double, known long")
    model = fit(chunks, counted, slim.where(~F.col("held_out")).count(), rounds)
    oov = model.tokens - int(model.counts[:UNKNOWN].sum() + model.counts[UNKNOWN + 1 :].sum())
    spare = model.types - int((np.delete(model.counts, UNKNOWN) > 0).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = np.log10(model.counts + 1.0)
        inside[[END, UNKNOWN]] = 0

        def scored_rows(rows: list[tuple]) -> pa.RecordBatch:
            tokens = [t for row in rows for t in row[0]]
            score = likelihood(model.weights, tokens) / np.log(10)
            unknown = np.array([int((t == UNKNOWN).sum()) for t in tokens])
            known = np.array([float(inside[t].sum()) for t in tokens])
            ids = pa.concat_arrays([row[1] for row in rows])
            made = [np.concatenate([row[k] for row in rows]) for k in (2, 3)]
            made += [np.array([len(t) for t in tokens]), score - unknown * np.log10(oov + spare + 1.0) - known]
            return pa.RecordBatch.from_arrays([ids, *map(pa.array, made)], names=["_id", "rid", "held_out", "n_tokens", "part"])

        rows, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = texts_of(batch, i, model)
                take = lambda name, kind: np.frombuffer(batch.column(name)[i].as_py(), kind)  # noqa: B023, E731
                rows.append((tokens, batch.column("ids").slice(i, 1).flatten(), take("rids", np.int64), take("held", bool)))
                size += sum(map(len, tokens))
                if size >= TOGETHER:
                    yield scored_rows(rows)
                    rows, size = [], 0
        if rows:
            yield scored_rows(rows)

    scored = chunks.drop("trained").mapInArrow(run, slim.select("_id").schema.add("rid", "long").add("held_out", "boolean").add("n_tokens", "long").add("part", "double"))
    ends = int(model.counts[END])
    out = scored.join(sums, "rid", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    base = logs + float(np.log10(ends + 1.0)) - F.col("n_tokens") * float(np.log10(model.tokens + (model.types + 1.0)))
    return out.select(
        F.col("_id").alias(key), "held_out", "n_tokens", (F.coalesce("known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("part") + logs).alias("score"),
    )


def fit(chunks: DataFrame, counted: DataFrame, ends: int, rounds: int) -> Model:
    """Vocabulary from the counts, weights from ``rounds`` of training over all chunks."""
    totals = counted.where("types is not null").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).first()
    top = counted.where("word is not null").orderBy(F.desc("n"), "word").limit(VOCABULARY - 2).collect()
    n, types = int(totals["n"] or 0) + ends, int(totals["types"] or 0) + int(ends > 0)
    counts = np.zeros(VOCABULARY, dtype=np.int64)
    counts[END] = ends
    counts[2 : 2 + len(top)] = [r["n"] for r in top]
    counts[UNKNOWN] = n - counts.sum()
    words = np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    index = np.arange(2, 2 + len(top), dtype=np.int64)  # by frequency, so classes hold entries of like frequency
    model = Model(words[order], index[order], counts, start(counts), n, types)
    weights = model.weights
    shapes = {k: v.shape for k, v in weights.items()}
    for r in range(rounds if n else 0):
        now = weights

        def learn(batches: Iterator[pa.RecordBatch], now: dict[str, np.ndarray] = now) -> Iterator[pa.RecordBatch]:
            def texts() -> Iterator[list[np.ndarray]]:
                for batch in batches:
                    for i in range(batch.num_rows):
                        out = np.frombuffer(batch.column("held")[i].as_py(), bool)
                        mine = [t for t, h in zip(texts_of(batch, i, model), out, strict=True) if not h]
                        if mine:
                            yield mine

            got, seen = train(now, texts())
            if seen:
                flat_ = np.concatenate([v.reshape(-1) for v in got.values()]).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat_)), pa.int32()), pa.array(flat_ * seen), pa.array(np.full(len(flat_), seen), pa.int64())], names=["at", "x", "seen"])

        some = chunks.where(F.pmod(F.xxhash64("chunk"), F.lit(rounds)) == r)
        mean = some.mapInArrow(learn, "at int, x double, seen long").groupBy("at").agg((F.sum("x") / F.sum("seen")).alias("x"))
        got = mean.toArrow()
        if got.num_rows:
            x = np.empty(got.num_rows)
            x[got.column("at").to_numpy()] = got.column("x").to_numpy()
            ends_ = np.cumsum([int(np.prod(s)) for s in shapes.values()])
            weights = {k: v.reshape(s).astype(np.float32) for (k, s), v in zip(shapes.items(), np.split(x, ends_[:-1]), strict=True)}
    model.weights = weights
    return model
