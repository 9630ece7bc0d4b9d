"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mercato.llm.tables import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node.

    Each round rewires every neighbour of a node to the smallest one it knows, until nothing
    changes; the number of rounds grows with the logarithm of the longest chain. Every round is
    written to the shared folder. Nothing but counts comes to the driver. Links with a null end
    and loops are left out; repeated links change nothing.
    """
    pairs = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stage(pairs.distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        edges = both.join(least, "a").where("b > a and b <> m").select(F.col("m").alias("a"), "b").distinct()
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        small = edges.join(least, "b")
        # Every neighbour below a node, and the node itself, now point at the least of them.
        small = small.select(F.explode(F.array("a", "b")).alias("b"), F.col("m").alias("a")).where("a <> b")
        edges = stage(small.select("a", "b").distinct(), "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("a").alias("component")).distinct().withColumn("node", F.col("component"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots.select("node", "component"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
