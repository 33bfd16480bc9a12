"""Connected components of an edge table, entirely as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import stored


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, comp``: the smallest node reachable, for every node of an edge.

    ``edges`` has columns ``a`` and ``b``.  Every round hooks each node to its
    smallest neighbour, follows these pointers to their roots by doubling and
    contracts the edges to roots, so the nodes left at least halve.  A hot node
    costs one partial minimum per task; the joins are plain equi-joins of
    stored tables, which adaptive execution splits where a node is hot."""
    left = stored(_ordered(edges), "cc-edges")
    labels: DataFrame | None = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("p"))
        parent = stored(parent, "cc-parents")
        while True:
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("top"))
            jumped = parent.join(up, "p").select("u", F.col("top").alias("p"), (F.col("top") != F.col("p")).alias("moved"))
            jumped = stored(jumped, "cc-jump")
            parent = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        if labels is None:
            labels = parent.select(F.col("u").alias("node"), F.col("p").alias("comp"))
        else:
            up = parent.select(F.col("u").alias("comp"), F.col("p").alias("top"))
            labels = stored(labels.join(up, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp")), "cc-labels")
        pa, pb = parent.select(F.col("u").alias("a"), F.col("p").alias("ra")), parent.select(F.col("u").alias("b"), F.col("p").alias("rb"))
        left = stored(_ordered(left.join(pa, "a").join(pb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "cc-edges")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return labels
