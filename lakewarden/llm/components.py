"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakewarden.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Map every end of ``edges`` (a, b: long) to the smallest node of its component (node, root).

    Each round hooks every node to its smallest neighbour, shortens the paths of that forest to
    its roots by doubling, and contracts the edges to the roots. A root is smaller than all its
    neighbours, so a round at least halves the nodes with edges left. All tables are joined by
    key and stored per round; nothing is collected. An empty edge list gives an empty table.
    """
    edges = scratch.save(edges.filter("a <> b").select("a", "b"), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = scratch.save(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
            .select("node", F.least("node", "b").alias("up")), "parent")
        while True:
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = scratch.save(
                parent.join(above, "up", "left")
                .select("node", F.col("up").alias("was"),
                        F.coalesce("top", "up").alias("up")), "jump")
            done = jumped.filter("was <> up").isEmpty()
            scratch.drop(parent)
            parent = jumped.drop("was")
            parent._scratch = jumped._scratch
            if done:
                break
        if labels is None:
            labels = scratch.save(parent.select("node", F.col("up").alias("root")), "labels")
        else:
            moved = labels.join(parent.select(F.col("node").alias("root"), "up"), "root", "left") \
                .select("node", F.coalesce("up", "root").alias("root"))
            fresh = scratch.save(moved, "labels")
            scratch.drop(labels)
            labels = fresh
        up_a = parent.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        up_b = parent.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        rest = scratch.save(
            edges.join(up_a, "a").join(up_b, "b").filter("ra <> rb")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
        scratch.drop(edges, parent)
        edges = rest
    return labels if labels is not None else edges.select(
        F.col("a").alias("node"), F.col("b").alias("root"))
