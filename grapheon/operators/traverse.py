"""Bounded traversal: hops, breadth-first walks from one or many roots, path totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grapheon.plans.lineage import cut


def directed(edges: DataFrame, direction: str = "out") -> DataFrame:
    """src, dst in walking order: "out", "in", or "any" (both)."""
    out = edges.select("src", "dst")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return out if direction == "out" else back if direction == "in" else out.unionByName(back)


def hop(vertices: DataFrame, edges: DataFrame, key: str = "key", direction: str = "out") -> DataFrame:
    """Each vertex with each neighbour (dst): one equi-join."""
    return vertices.join(directed(edges, direction).withColumnRenamed("src", key), key)


def walk(roots: DataFrame, edges: DataFrame, most: int = 8, least: int = 0, direction: str = "out") -> DataFrame:
    """root, node, depth: every node that each root reaches, once, at its least depth; `least` 1 leaves the roots out.

    roots: column root. All roots walk in one job: the frontier is keyed by (root, node), so its growth is spread by both. Each level is
    one join with the edges and one anti-join with what is visited; a checkpoint ends it, and an empty frontier ends the walk.
    """
    steps = cut(directed(edges, direction).withColumnRenamed("src", "node"))  # once, not at each level; what is reached twice is made one below
    seen = frontier = roots.select("root", F.col("root").alias("node"), F.lit(0).alias("depth")).distinct()
    for depth in range(1, most + 1):
        reached = frontier.select("root", "node").join(steps, "node").select("root", F.col("dst").alias("node")).distinct()
        frontier = cut(reached.join(seen.select("root", "node"), ["root", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen.filter(F.col("depth") >= least)


#: Roots that a long's bits stand for.
MARKS = 63


def marks(roots: DataFrame, edges: DataFrame, most: int = 8) -> tuple[DataFrame, DataFrame] | None:
    """node, seen: every node that up to MARKS roots reach, once, with the bits of these roots; and root, bit. None for more roots.

    What `walk` finds, with a row for each node, not for each root and node.
    """
    named = cut(roots.select("root").distinct())
    if named.count() > MARKS:
        return None
    place = F.row_number().over(Window.orderBy("root")) - 1  # MARKS rows at most
    names = cut(named.withColumn("bit", F.call_function("shiftleft", F.lit(1).cast("long"), place)))
    steps = cut(directed(edges).withColumnRenamed("src", "node"))
    none = F.lit(0).cast("long")
    state = names.select(F.col("root").alias("node"), F.col("bit").alias("seen"), F.col("bit").alias("fresh"))
    for _ in range(most):
        came = state.filter("fresh <> 0").select("node", "fresh").join(steps, "node").groupBy(F.col("dst").alias("node")).agg(F.bit_or("fresh").alias("came"))
        both = state.select("node", "seen", none.alias("came")).unionByName(came.select("node", none.alias("seen"), "came"))
        merged = both.groupBy("node").agg(F.bit_or("seen").alias("seen"), F.bit_or("came").alias("came"))
        state = cut(merged.select("node", F.expr("seen | came").alias("seen"), F.expr("came & ~seen").alias("fresh")))
        if state.filter("fresh <> 0").isEmpty():
            break
    return state.select("node", "seen"), names


def marked(rows: DataFrame, names: DataFrame) -> DataFrame:
    """rows (seen, and what else they carry) once for each root whose bit they have, with root in place of seen."""
    return rows.join(F.broadcast(names), F.col("seen").bitwiseAND(F.col("bit")) != 0).drop("seen", "bit")


def forest(edges: DataFrame, direction: str = "out") -> bool:
    """Whether no element is entered by two edges, so that a walk has as many paths as elements."""
    twice = directed(edges, direction).distinct().groupBy("dst").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return direction != "any" and twice.isEmpty()


def walk_recursive(roots: DataFrame, edges: DataFrame, most: int = 8, least: int = 0, direction: str = "out") -> DataFrame:
    """The rows of `walk`, by Spark's own recursive relation: one statement, without checkpoints or actions of ours.

    A recursion's union keeps repeats, so it has a row for each path, and only the result has each element once. Choose it for forests (see `forest`) and short walks; `walk`
    for graphs whose paths meet or run in circles, where paths outgrow elements, and for walks that are to survive lost executors level by level.
    """
    spark = roots.sparkSession
    rows = "spark.sql.cteRecursionRowLimit"
    if spark.conf.get(rows) != "-1":
        spark.conf.set(rows, "-1")  # the relation is distributed; a limit of rows would be an error at scale
    out = spark.sql(
        f"""WITH RECURSIVE w(root, node, depth) MAX RECURSION LEVEL {most + 1} AS (
          SELECT root, root AS node, 0 AS depth FROM {{starts}}
          UNION ALL SELECT w.root, s.dst, w.depth + 1 FROM w JOIN {{steps}} s ON s.src = w.node WHERE w.depth < {most})
        SELECT root, node, min(depth) AS depth FROM w GROUP BY root, node""",
        starts=roots.select("root").distinct(), steps=directed(edges, direction).distinct(),
    )
    return out.filter(F.col("depth") >= least)


def within(edges: DataFrame, collection: str) -> DataFrame:
    """Edges that lead to elements of one collection (keys `collection/...`): a walk over them stays in it."""
    return edges.filter(F.substring_index("dst", "/", 1) == collection)


def successors(states: DataFrame, edges: DataFrame, label: str = "transitionsTo") -> DataFrame:
    """key, dst, trigger, guard: one step of a state machine from each state (key), with what sets it off."""
    step = edges.filter(F.col("label") == label).select(F.col("src").alias("key"), "dst", "trigger", "guard")
    return states.select("key").join(step, "key")


def subtree_sizes(roots: DataFrame, edges: DataFrame, most: int = 8) -> DataFrame:
    """root, size: nodes below each root, the root left out."""
    found = marks(roots, edges, most)
    if found:
        return marked(found[0], found[1]).groupBy("root").agg((F.count("*") - 1).alias("size")).filter("size > 0")
    return walk(roots, edges, most, 1).groupBy("root").agg(F.count("*").alias("size"))


def path_totals(roots: DataFrame, edges: DataFrame, values: DataFrame, most: int = 8) -> DataFrame:
    """root, total: values over all paths, each path's value times the product of its edges' `multiplicity` (1 where null).

    Paths that meet at a node are summed there level by level, so a level has a row for each (root, node), not for each path.
    edges: src, dst, multiplicity; values: node, value.
    """
    steps = cut(edges.select(F.col("src").alias("node"), "dst", F.coalesce(F.col("multiplicity").cast("double"), F.lit(1.0)).alias("m")))
    level = roots.select("root", F.col("root").alias("node"), F.lit(1.0).alias("times"))
    total = level
    for _ in range(most):
        level = cut(level.join(steps, "node").groupBy("root", F.col("dst").alias("node")).agg(F.sum(F.col("times") * F.col("m")).alias("times")))
        if level.isEmpty():
            break
        total = total.unionByName(level)
    return total.join(values, "node").groupBy("root").agg(F.sum(F.col("times") * F.col("value")).alias("total"))
