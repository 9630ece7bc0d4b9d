"""Exact Jaccard links of word-shingle sets by vertical partitioning, and their components.

1. Texts of one shingle set form a class; everything below is about classes.
2. The hash order of shingles is cut into fragments. In each fragment, apart from the others,
   the shingles that two classes hold are found and counted per class; the partial counts are
   summed. A class that shares too few of its shingles with anything has no link.
3. What is left is ordered by frequency. Two linked classes share a shingle among the first
   few of each (prefix filter). Short posting lists give their pairs.
4. Long posting lists would give the square of their length. Each names three leaders instead,
   and only pairs with a leader are counted. Members that this does not connect are compared in
   blocks against their whole bundle: no pair is left out, none is written that links nothing new.
5. Overlaps of a pair are counted per fragment and summed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm.components import components
from mercato.llm.ragged import Powers, binary, blocks, flat, lean, mix, shingles, word_hashes
from mercato.llm.tables import attach, drop, stage, stage_kinds

WORDS = 5
FRAGMENT_BYTES = 16 << 20  # of text whose shingles share one fragment
CHUNK = 4 << 20  # of text that one task summarises at a time
SHORT = 32
LEADERS = 3
BLOCK_ROWS = 256
CUTS = 4  # fragments of a pair's count


def set_ids(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """64-bit id of each set of shingles."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values)])
    ends = np.cumsum(counts)
    spread = np.concatenate([[np.uint64(0)], np.cumsum(mix(values * np.uint64(0xD6E8FEB86659FD93)))])
    return mix(sums[ends] - sums[ends - counts] + mix(spread[ends] - spread[ends - counts]) + counts.astype(np.uint64))


def summarise(docs: DataFrame, fragments: int) -> DataFrame:
    """Rows of two kinds: one per text (fragment null), and per chunk (cid is its number) and fragment its shingles.

    A chunk ships each shingle once: with its owner, or as common if two of its classes hold it.
    """

    def chunk(held: list, number: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        values, counts, ids = (np.concatenate([h[k] for h in held]) for k in range(3))
        _, first = np.unique(ids, return_index=True)
        once = np.zeros(len(ids), dtype=bool)
        once[first] = True
        values = values[np.repeat(once, counts)]
        counts, ids = counts[once], ids[once]
        owner = np.repeat(np.arange(len(ids)), counts)
        order = np.argsort(values, kind="stable")
        v = values[order]
        same = np.zeros(len(v) + 1, dtype=bool)
        same[1:-1] = v[1:] == v[:-1]
        common = np.empty(len(v), dtype=bool)
        common[order] = same[:-1] | same[1:]
        fragment = ((values >> np.uint64(33)) % np.uint64(fragments)).astype(np.int64)
        order = np.lexsort((owner, fragment))
        values, owner, common, fragment = values[order].astype(np.uint32), owner[order], common[order], fragment[order]
        bounds = np.searchsorted(fragment, np.arange(fragments + 1))
        rows = []
        for f in range(fragments):
            a, b = bounds[f], bounds[f + 1]
            if a == b:
                continue
            mine, which = np.unique(owner[a:b], return_inverse=True)
            c = common[a:b]
            alone = np.bincount(which[~c], minlength=len(mine)).astype(np.int32)
            shared = np.bincount(which[c], minlength=len(mine)).astype(np.int32)
            rows.append((f, ids[mine], alone, shared, values[a:b][~c], np.unique(values[a:b][c])))
        cols = list(zip(*rows, strict=True))
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, kind), pa.nulls(n, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(cols[0], pa.int32()), *map(binary, cols[1:])],
            names=NAMES,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size, number = Powers(), [], 0, TaskContext.get().partitionId() << 32
        for batch in blocks(batches):
            kind = batch.column("doc_id").type
            data, offsets = flat(batch.column("text"))
            words, counts, _, _ = word_hashes(data, offsets, powers)
            values, counts = shingles(words, counts, WORDS)
            ids = set_ids(values, counts)
            none = [pa.nulls(batch.num_rows, t) for t in (pa.int32(), *[pa.binary()] * 5)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), pa.array(ids.view(np.int64)), *none], names=NAMES)
            held.append((values, counts, ids))
            size += len(data)
            if size >= CHUNK:
                yield from chunk(held, number, kind) if sum(len(h[0]) for h in held) else ()
                held, size, number = [], 0, number + 1
        if held and sum(len(h[0]) for h in held):
            yield from chunk(held, number, kind)

    kind_of = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind_of}, n_shingles long, cid long, fragment int, ids binary, alone binary, shared binary, tokens binary, common binary")


NAMES = ["doc_id", "n_shingles", "cid", "fragment", "ids", "alone", "shared", "tokens", "common"]


def shared_counts(table: pa.Table) -> pa.Table:
    """Of one fragment: how many of its shingles each class of each chunk shares with another class.

    The counts go back as one row per chunk, so their number does not grow with the texts.
    """
    take = lambda name, kind: [np.frombuffer(x.as_py(), dtype=kind) for x in table.column(name)]
    ids = np.concatenate(take("ids", np.int64))
    alone = np.concatenate(take("alone", np.int32))
    shared = np.concatenate(take("shared", np.int32)).astype(np.int64)
    tokens = np.concatenate(take("tokens", np.uint32))
    common = np.unique(np.concatenate(take("common", np.uint32)))
    classes, cls = np.unique(ids, return_inverse=True)
    row = np.repeat(np.arange(len(ids), dtype=np.int32), alone)
    order = np.argsort(tokens, kind="stable")
    t, c = tokens[order], cls[row[order]].astype(np.int32)
    begin = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
    hit = np.zeros(0, dtype=bool)
    if len(t):
        hit = np.minimum.reduceat(c, begin) != np.maximum.reduceat(c, begin)
        if len(common):
            at = np.searchsorted(common, t[begin]).clip(0, len(common) - 1)
            hit |= common[at] == t[begin]
        hit = np.repeat(hit, np.diff(np.append(begin, len(t))))
        shared = shared + np.bincount(row[order][hit], minlength=len(ids))
    edges = np.cumsum([0, *map(len, take("ids", np.int64))])
    full = [np.flatnonzero(shared[a:b]) + a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.table({"chunk": table.column("cid"), "ids": binary([ids[x] for x in full]), "n": binary([shared[x] for x in full])})


def summed():
    """Of one chunk: its classes that share enough shingles, by the sum over all fragments."""

    def run(table: pa.Table) -> pa.Table:
        take = lambda name: np.concatenate([np.frombuffer(x.as_py(), dtype=np.int64) for x in table.column(name)])
        cid, back = np.unique(take("ids"), return_inverse=True)
        return pa.table({"cid": pa.array(cid), "k": pa.array(np.bincount(back, weights=take("n"), minlength=len(cid)).astype(np.int64))})

    return run


def linked(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (a + b - overlap)


def least(size: Column, percent: int) -> Column:
    """Fewest shared shingles of a linked set of this size."""
    return F.ceil(size * percent / F.lit(100))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (a, b): partial overlaps per fragment, summed per pair."""
    cut = lambda k: F.filter("tokens", lambda t: F.shiftrightunsigned(t, 62) == k)
    parts = sets.select("cid", "n", F.posexplode(F.array(*[cut(k) for k in range(CUTS)])).alias("part", "held"))
    left = parts.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), "part", F.col("held").alias("held_a"))
    right = parts.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), "part", F.col("held").alias("held_b"))
    partial = pairs.join(left, "a").join(right, ["b", "part"]).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("held_a", "held_b")).alias("k"))
    summed = partial.groupBy("a", "b").agg(F.sum("k").alias("k"), F.min("n_a").alias("n_a"), F.min("n_b").alias("n_b"))
    return summed.where(linked(F.col("k"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def near_components(docs: DataFrame, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Two rows link when 100 * intersection >= ``percent`` * union of their sets of distinct
    5-word shingles (A-Z lower-cased; fewer words: the whole sequence). component_id is the smallest
    key that links reach. Null, empty and wordless texts have 0 shingles and their own key. Repeated
    rows are one class; a null key takes part in links, but names a component only if no
    member has a key. Shingles and sets are told apart by 64-bit hashes.
    """
    slim = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = int(total // FRAGMENT_BYTES) + 1
    made = summarise(slim, fragments).withColumn("kind", F.col("fragment").isNotNull().cast("int"))
    rows, pieces = stage_kinds(made, "shingles", "kind", (0, 1))
    rows = rows.select("doc_id", "n_shingles", "cid")
    classes = rows.where("n_shingles > 0 and doc_id is not null").groupBy("cid").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"))
    counted = pieces.select("cid", "fragment", "ids", "alone", "shared", "tokens", "common")
    counted = counted.groupBy("fragment").applyInArrow(lean(shared_counts), "chunk long, ids binary, n binary")
    counted = counted.groupBy("chunk").applyInArrow(lean(summed()), "cid long, k long").groupBy("cid").agg(F.max("k").alias("k"))
    kept = stage(classes.join(counted, "cid").where(F.col("k") >= least(F.col("n"), percent)).select("cid", "rep", "n"), "classes")
    drop(pieces)
    comp = _components(slim, kept, percent)
    named = comp.join(classes.select(F.col("cid").alias("node"), "rep"), "node")
    named = named.join(named.groupBy("component").agg(F.min("rep").alias("least")), "component").select(F.col("node").alias("cid"), "least")
    named = stage(named, "near-components")
    first = attach(classes, named, ["cid"]).select("cid", F.coalesce("least", "rep").alias("component_id"))
    out = rows.join(first, "cid", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"))


def _components(slim: DataFrame, kept: DataFrame, percent: int) -> DataFrame:
    """(node, component) of all kept classes that link with another."""
    n_kept = kept.count()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in blocks(batches):
            words, counts, _, _ = word_hashes(*flat(batch.column("text")), powers)
            values, counts = shingles(words, counts, WORDS)
            right = set_ids(values, counts).view(np.int64) == batch.column("cid").to_numpy(zero_copy_only=False)
            values, counts = values[np.repeat(right, counts)].view(np.int64), counts[right]
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("cid").filter(pa.array(right)), pa.array(counts), lists], names=["cid", "n", "tokens"])

    rep = kept.select(F.col("rep").alias("doc_id"), "cid")
    some = attach(slim.where("doc_id is not null"), rep, ["doc_id"], "inner", n_kept)
    sets = stage(some.select("text", "cid").mapInArrow(tokenise, "cid long, n long, tokens array<long>").dropDuplicates(["cid"]), "sets")

    held = sets.select("cid", "n", F.explode("tokens").alias("v"))
    often = stage(held.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "frequencies")
    shared = held.join(often, "v").groupBy("cid").agg(F.min("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "v"))).alias("o"))
    # Shingles that nothing else holds come first in the order, then the shared ones from rare to common.
    single = F.col("n") - F.size("o")
    room = F.col("n") - least(F.col("n"), percent) + 1 - single
    prefix = shared.where(room > 0).select("cid", "n", single.alias("s"), F.posexplode(F.slice("o", F.lit(1), F.greatest(room, F.lit(0)).cast("int"))).alias("i", "e"))
    prefix = stage(prefix.select("cid", "n", (F.col("s") + F.col("i")).alias("i"), F.col("e.v").alias("v")), "prefixes")
    lists = prefix.groupBy("v").agg(F.count("*").alias("held")).where("held > 1")
    lists = stage(prefix.join(lists, "v"), "postings")

    short = lists.where(F.col("held") <= SHORT).select("v", "cid", "n", "i")
    x = short.select("v", F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("i").alias("i_a"))
    y = short.select("v", F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("i").alias("i_b"))
    most = F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b"))
    near = (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & linked(most, F.col("n_a"), F.col("n_b"), percent)
    pairs = x.join(y, "v").where((F.col("a") < F.col("b")) & near).select("a", "b")

    long_ = lists.where(F.col("held") > SHORT).select("v", "cid", "n")
    heavy = not long_.isEmpty()
    if heavy:
        rank = lambda k: F.struct(F.xxhash64("cid", F.lit(k)), F.col("cid"))
        leaders = long_.groupBy("v").agg(*[F.min(rank(k)).alias(f"l{k}") for k in range(LEADERS)])
        stars = long_.join(leaders, "v").select("cid", F.explode(F.array(*[F.col(f"l{k}.cid") for k in range(LEADERS)])).alias("hub"))
        stars = stage(stars.where("cid <> hub").select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct(), "stars")
        pairs = pairs.unionByName(stars)
    found = stage(verified(stage(pairs.distinct(), "pairs"), sets, percent), "verified")
    if not heavy:
        return components(found)
    # Verified links and bundles of long lists in one run.
    of = lambda kind, pairs: pairs.select(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("cid")).alias(c) for c in ("a", "b")])
    both = stage(components(of(0, found).unionByName(of(1, stars))).select("node.kind", "node.cid", F.col("component.cid").alias("component")), "both-components")
    comp = both.where("kind = 0").select(F.col("cid").alias("node"), "component")
    extra = stage(_in_blocks(both, sets, percent), "links-in-blocks")
    if extra.isEmpty():
        return comp
    joined = components(extra).select(F.col("node").alias("component"), F.col("component").alias("root"))
    known = comp.join(joined, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    single = joined.select(F.col("component").alias("node"), F.col("root").alias("component")).join(comp.select("node"), "node", "left_anti")
    return known.unionByName(single)


def _in_blocks(both: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components within one bundle of long posting lists."""
    bundle = both.where("kind = 1").select("cid", F.col("component").alias("bundle"))
    comp = both.where("kind = 0").select("cid", F.col("component").alias("comp"))
    member = bundle.join(comp, "cid", "left").select("cid", "bundle", F.coalesce("comp", "cid").alias("comp"))
    size = member.groupBy("bundle", "comp").agg(F.count("*").alias("size"))
    torn = size.groupBy("bundle").agg(F.count("*").alias("comps"), F.sum(F.when(F.col("size") < BLOCK_ROWS, F.col("size")).otherwise(0)).alias("loose")).where("comps > 1")
    member = member.join(size, ["bundle", "comp"]).join(torn, "bundle").join(sets.select("cid", "n"), "cid")
    solid = F.when(F.col("size") >= BLOCK_ROWS, F.col("comp"))
    # Linked sets differ in size by the factor 100 / percent at most, so in bands of that factor by one band at most.
    band = F.col("n") if percent >= 100 else F.floor(F.log("n") / math.log(100 / percent) + 1e-9)
    member = stage(member.select("cid", "bundle", "comp", solid.alias("solid"), band.cast("long").alias("band")), "members")
    rows = member.groupBy("bundle", "solid", "band").agg(F.count("*").alias("rows"))
    rows = rows.select(F.col("bundle").alias("_b"), F.col("solid").alias("_s"), F.col("band").alias("_d"), "rows")
    member = member.join(rows, (F.col("bundle") == F.col("_b")) & F.col("solid").eqNullSafe(F.col("_s")) & (F.col("band") == F.col("_d")))
    number = F.pmod(F.xxhash64("cid"), F.ceil(F.col("rows") / BLOCK_ROWS))
    member = stage(member.select("cid", "bundle", "comp", "solid", "band", F.xxhash64("bundle", "solid", "band", number).alias("block")), "blocks")
    block = member.select("bundle", "solid", "band", "block").distinct()
    x = block.select("bundle", F.col("solid").alias("s1"), F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), F.col("block").alias("b1"), F.col("band").alias("own"))
    y = block.select("bundle", F.col("solid").alias("s2"), "band", F.col("block").alias("b2"))
    # Two blocks of one component have nothing left to find; two of one band meet once.
    couples = x.join(y, ["bundle", "band"]).where("(own < band or b1 <= b2) and not (s1 <=> s2 and s1 is not null)").select(F.xxhash64("b1", "b2").alias("couple"), "b1", "b2")
    sides = couples.select("couple", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("b1").alias("block")), F.struct(F.lit(1).alias("side"), F.col("b2").alias("block")))).alias("x"))
    sides = sides.select("couple", "x.side", "x.block")
    laid = sides.join(member.select("block", "cid", "comp"), "block").join(sets, "cid").select("couple", "side", "cid", "comp", "n", "tokens")

    def compare(table: pa.Table) -> pa.Table:
        return pa.table(dict(zip(("a", "b"), map(pa.array, block_links(table, percent)), strict=True)), schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return laid.groupBy("couple").applyInArrow(lean(compare), "a long, b long")


def block_links(table: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """Pairs of components of the two sides that a link connects, overlaps counted cut by cut."""
    table = table.combine_chunks()
    side = table.column("side").to_numpy()
    cid, comp, n = (table.column(c).to_numpy() for c in ("cid", "comp", "n"))
    column = table.column("tokens").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    tokens = column.flatten().to_numpy()
    row = np.repeat(np.arange(len(cid)), np.diff(column.offsets.to_numpy()))
    value, col = np.unique(tokens, return_inverse=True)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    place = np.zeros(len(cid), dtype=np.int64)
    place[left], place[right] = np.arange(len(left)), np.arange(len(right))
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    for a in range(0, len(value), 4096):
        lo, hi = np.searchsorted(col, (a, a + 4096))
        r, c = row[lo:hi], col[lo:hi] - a
        m1, m2 = np.zeros((len(left), 4096), np.float32), np.zeros((len(right), 4096), np.float32)
        first = side[r] == 0
        m1[place[r[first]], c[first]] = 1
        m2[place[r[~first]], c[~first]] = 1
        both += m1 @ m2.T
    k = both.astype(np.int64)
    ok = (100 * k >= percent * (n[left][:, None] + n[right][None] - k)) & (comp[left][:, None] != comp[right][None])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out_a, out_b = [], []
    for i, j in zip(*np.nonzero(ok), strict=True):
        p, q = root(int(comp[left[i]])), root(int(comp[right[j]]))
        if p != q:
            parent[p] = q
            out_a.append(int(comp[left[i]]))
            out_b.append(int(comp[right[j]]))
    return out_a, out_b
