"""Connected components of an undirected graph by alternating hooking of large and small neighbours; every round is a join-free pair of group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import materialize


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a long, b long) reaches.  Nodes without an edge do not appear.

    Each round replaces every edge's larger end's parent by the smallest node seen beside it, then shortens paths by a join of the parent
    table with itself; it ends when no edge joins two trees.  Rounds are logarithmic in the longest path.  Parents are written
    to the shared folder each round, so lineage stays short, and only a count reaches the driver.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    pairs = materialize(pairs, f"{name}-edges")
    if pairs.isEmpty():
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    live = pairs
    root = None
    while True:
        # Hook: the larger root of each live edge takes the smallest root beside it.
        hook = live.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        if root is None:
            nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
            root = nodes.join(hook, "node", "left").select("node", F.coalesce("up", "node").alias("root"))
        else:
            moved = hook.withColumnsRenamed({"node": "root"})
            root = root.join(moved, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        root = materialize(root, f"{name}-roots")
        while True:
            up = root.select(F.col("node").alias("root"), F.col("root").alias("next")).filter("root != next")
            short = root.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
            short = materialize(short, f"{name}-roots")
            root = short.select("node", "root")
            if short.filter("moved").isEmpty():
                break
        ends = live.join(root.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(root.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        live = materialize(ends.filter("ra != rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"{name}-edges")
        if live.isEmpty():
            return root.select("node", F.col("root").alias("component"))


