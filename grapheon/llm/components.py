"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grapheon.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v) with u > v. One step; gives such edges again."""
    if large:  # all neighbours; each larger one is linked to the least
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        new = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # smaller neighbours; they and the node itself are linked to the least
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        new = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return new.filter("u <> v").distinct()


def components(edges: DataFrame, most: int = 64) -> DataFrame:
    """node, root: the least node that each node with an edge reaches. edges: a, b (long); loops and repeats do no harm.

    Each round halves the depth of what is left at least, and edges never become more than nodes and edges at first.
    A round ends with a checkpoint, so its plan stays short and a lost executor costs one round. Rounds are logarithmic in the longest path;
    if `most` aren't enough, that is an error, not a result.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    for _ in range(most):
        now = cut(_star(_star(now, True), False))
        # a forest of stars: no root has a parent, and each node has one
        parents = now.groupBy("u").agg(F.count("*").alias("n"))
        roots = now.select("v").distinct()
        open_ = parents.filter("n > 1").select("u").unionByName(parents.join(roots, parents["u"] == roots["v"], "left_semi").select("u"))
        if open_.isEmpty():
            break
    else:
        raise RuntimeError(f"components haven't settled after {most} rounds")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
