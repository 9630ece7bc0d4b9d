"""Merkle manifest of a dataset by time-forward processing.

Every node has a label, and children come before their parent in the order of labels: (end of the
run of leaves beneath, level). An upward sweep goes through the labels; a priority queue ordered by
label holds the digests sent to nodes further on, and hands a node all its children's digests when its
turn comes. A second sweep in reversed order starts at the root and sends every node the rest of its proof
from its parent on, until the leaves have theirs.

A tree can have any number of leaves, so the queue is external: a sweep goes block by block, 2^``BITS``
neighbouring nodes each, whose digests go to the block above them through Spark's own sorted shuffle, which is the part
of the queue that does not fit a task. A task holds one block; the rounds are as many as a tree has levels
divided by ``BITS``.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.llm.tables import attach, stage
from mercato.operators.ordered import place, row_numbers

BITS = 12


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its length in bytes, a colon and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def joined(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def sweep_up(first: int, digests: Sequence[str], height: int) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of every node over the leaves ``first``, ``first`` + 1, ... in order of labels.

    Nodes are made up to ``height`` levels above the leaves. The queue holds at most two
    messages a level.
    """
    queue: list[tuple[int, int, int, str]] = []

    def send(level: int, index: int, digest: str) -> None:
        if level < height:
            heapq.heappush(queue, (((index >> 1) + 1) << (level + 1), level + 1, index, digest))

    def due(until: float) -> Iterator[tuple[int, int, str]]:
        while queue and queue[0][0] <= until:
            end, level, _, _ = queue[0]
            got = []
            while queue and queue[0][:2] == (end, level):
                got.append(heapq.heappop(queue)[3])
            index, digest = (end >> level) - 1, joined(got)
            yield level, index, digest
            send(level, index, digest)

    for at, digest in enumerate(digests, first):
        yield 0, at, digest
        send(0, at, digest)
        yield from due(at + 1)
    yield from due(float("inf"))


def sweep_down(nodes: dict[tuple[int, int], str], height: int, top: int, rest: Sequence[str]) -> Iterator[tuple[int, list[str]]]:
    """(leaf, its proof) from the last leaf to the first, ``rest`` being the proof of the top node."""
    queue: list[tuple[int, int, int, tuple]] = [(-((top + 1) << height), -height, top, ())]
    while queue:
        _, level, index, proof = heapq.heappop(queue)
        level = -level
        if level == 0:
            told = []
            while proof:
                told.append(proof[0])
                proof = proof[1]
            yield index, [*told, *rest]
            continue
        pair = [(level - 1, 2 * index + side) for side in (0, 1)]
        pair = [(lv, i) for lv, i in pair if (lv, i) in nodes]
        for lv, i in pair:
            other = (lv, i ^ 1)
            sibling = ("L" if i & 1 else "R") + nodes[other] if other in nodes else "-"
            heapq.heappush(queue, (-((i + 1) << lv), -lv, i, (sibling, proof)))


def height_of(size: int, bits: int) -> int:
    """Levels that a block of a tree of ``size`` nodes rises: ``bits``, or fewer up to a small tree's root."""
    return min(bits, max(size - 1, 0).bit_length())


def raised(nodes: DataFrame, bits: int) -> DataFrame:
    """The nodes (_tree, _at, _digest, _size) ``bits`` levels further up, one per block."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_at")
        first, size, tree = (table.column(c)[0].as_py() for c in ("_at", "_size", "_tree"))
        height, digest = height_of(size, bits), None
        for level, _, digest in sweep_up(first, table.column("_digest").to_pylist(), height):  # noqa: B007
            pass
        return pa.table({"_tree": pa.array([tree], pa.int64()), "_at": pa.array([first >> bits], pa.int64()), "_digest": [digest], "_size": pa.array([-(-size >> bits)], pa.int64())})

    block = F.shiftright("_at", bits).alias("_block")
    return nodes.select("_tree", "_at", "_digest", "_size").groupBy("_tree", block).applyInArrow(run, "_tree long, _at long, _digest string, _size long")


def lowered(nodes: DataFrame, above: DataFrame, bits: int, keep: Sequence[str] = ()) -> DataFrame:
    """The proofs of ``nodes`` from those of the nodes ``above`` (_tree, _at, _proof) their blocks.

    Returns _tree, _at, _proof and the columns of ``keep``.
    """

    def run(table: pa.Table, head: pa.Table) -> pa.Table:
        table = table.sort_by("_at")
        first, size = table.column("_at")[0].as_py(), table.column("_size")[0].as_py()
        height = height_of(size, bits)
        known = {(lv, i): d for lv, i, d in sweep_up(first, table.column("_digest").to_pylist(), height)}
        proofs: list[list[str]] = [[]] * table.num_rows
        for i, proof in sweep_down(known, height, first >> height, head.column("_proof")[0].as_py()):
            proofs[i - first] = proof
        out = table.select(["_tree", "_at", *keep])
        return out.append_column("_proof", pa.array(proofs, pa.list_(pa.string())))

    kinds = [f"{c} {nodes.schema[c].dataType.simpleString()}" for c in keep]
    more = [c for c in keep if c != "_digest"]
    below = nodes.select("_tree", "_at", "_digest", "_size", *more).groupBy("_tree", F.shiftright("_at", bits).alias("_block"))
    over = above.select("_tree", "_at", "_proof").groupBy("_tree", F.col("_at").alias("_block"))
    schema = ", ".join(["_tree long", "_at long", *kinds, "_proof array<string>"])
    return below.cogroup(over).applyInArrow(run, schema)


def climb(nodes: DataFrame, size: int, bits: int) -> list[DataFrame]:
    """The nodes and every further round of them, until each tree is one node; ``size``: of the largest tree."""
    rounds = [nodes]
    while True:
        rounds.append(stage(raised(rounds[-1], bits), "merkle-round"))
        size = -(-size >> bits)
        if size <= 1:
            return rounds


def descend(rounds: Sequence[DataFrame], proofs: DataFrame, bits: int, keep: Sequence[str]) -> DataFrame:
    """Proofs of the first round's nodes from those of the last round's."""
    for nodes in reversed(rounds[1:-1]):
        proofs = stage(lowered(nodes, proofs, bits), "merkle-proofs")
    return lowered(rounds[0], proofs, bits, keep)


def prove(leaves: DataFrame, tree: str, key: str, digest: str = "leaf", keep: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """The manifest: every leaf with the root of its tree, the root over all trees, and its proof.

    Per value of ``tree`` the digests ascend by ``key`` (null keys last, equal keys by digest); every two
    consecutive nodes become the hash of their digests, a last one alone the hash of its own, until one
    remains. The trees' roots, ordered by value (null first, by bytes), are taken together likewise.
    Returns ``key``, ``digest``, the columns of ``keep``, ``subroot``, ``root`` and ``proof``: per level the sibling's
    digest after ``L`` or ``R`` for its side, or ``-`` where there is none. No leaves: no rows.

    Positions are numbered over range-partitioned rows, so a value of ``tree`` with most of the rows, or rows
    that are all alike, spread over all tasks.
    """
    named = F.when(F.col(tree).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(tree).cast("string")))
    slim = leaves.select(named.alias("_name"), F.col(key).alias("_k"), F.col(digest).alias("_digest"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    slim = stage(slim, "merkle-leaves")
    extra = [f"_keep{i}" for i in range(len(keep))]
    tie = F.monotonically_increasing_id()  # over staged rows: a repeated task gives the same
    placed = place(slim.withColumn("_tie", tie), [F.col(c) for c in ("_name", "_k", "_digest", "_tie")], ["_name", "_k", "_digest", *extra])
    # At most one row per range and one per tree.
    parts = stage(placed.groupBy("_bucket", "_name").agg(F.count("*").alias("_own"), F.min("_row").alias("_first")), "merkle-parts")
    trees = parts.groupBy("_name").agg(F.sum("_own").alias("_size"))
    trees = stage(row_numbers(trees, [F.col("_name")], "_tree").withColumn("_tree", F.col("_tree") - 1), "merkle-trees")
    found = trees.agg(F.count("*").alias("n"), F.max("_size").alias("largest")).first()
    before = F.sum("_own").over(Window.partitionBy("_name").orderBy("_bucket")) - F.col("_own")
    shift = attach(parts.withColumn("_shift", before - F.col("_first")), trees, ["_name"], "inner", rows=found.n).drop("_own", "_first")
    nodes = attach(placed, stage(shift, "merkle-shift"), ["_bucket", "_name"], "inner")
    nodes = stage(nodes.select("_tree", (F.col("_row") + F.col("_shift")).cast("long").alias("_at"), "_digest", "_size", "_k", *extra), "merkle-nodes")

    rounds = climb(nodes, found.largest or 0, bits)
    subroots = rounds[-1].select(F.col("_tree").alias("_at"), F.col("_digest"))
    tops = climb(subroots.select(F.lit(0).cast("long").alias("_tree"), "_at", "_digest", F.lit(found.n).cast("long").alias("_size")), found.n, bits)
    root = tops[-1].first()  # one row
    start = tops[-1].select("_tree", "_at", F.array().cast("array<string>").alias("_proof"))
    of_trees = descend(tops, start, bits, ["_digest"])
    of_trees = stage(of_trees.select(F.col("_at").alias("_tree"), F.lit(0).cast("long").alias("_at"), F.col("_digest").alias("subroot"), "_proof"), "merkle-proofs")
    out = descend(rounds, of_trees, bits, ["_k", "_digest", *extra])
    out = attach(out, of_trees.select("_tree", "subroot"), ["_tree"], "inner", rows=found.n)
    return out.select(
        F.col("_k").alias(key),
        F.col("_digest").alias(digest),
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
        "subroot",
        F.lit(root._digest if root else None).cast("string").alias("root"),
        F.col("_proof").alias("proof"),
    )


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and a proof lead to."""

    def step(so_far: Column, part: Column) -> Column:
        other = F.substring(part, 2, 64)
        both = F.when(part == "-", so_far).when(F.substring(part, 1, 1) == "L", F.concat(other, so_far)).otherwise(F.concat(so_far, other))
        return F.sha2(both, 256)

    return F.aggregate(proof, digest, step)


def siblings(proof: Column) -> Column:
    """The digests of a proof one after the other."""
    return F.array_join(F.transform(F.filter(proof, lambda p: p != "-"), lambda p: F.substring(p, 2, 64)), "")


def verify(claimed: DataFrame, digest: str, root: str = "root", proof: str = "proof") -> DataFrame:
    """With ``folded_root`` from the claimed digest, and ``verified``: does it equal the root."""
    told = claimed.withColumn("folded_root", folded(F.col(digest), F.col(proof)))
    return told.withColumn("verified", F.col("folded_root") == F.col(root))


