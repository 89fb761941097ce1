"""Values that exercise a query: read off the graph, not invented.

The root of a rollup example is the element with the most numbers below it, its attribute the most frequent one there. All candidates are compared at once: counts below an
element are differences of prefix sums on the interval index, one for each attribute in place of a unit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grapheon.operators import intervals, traverse
from grapheon.plans.lineage import cut

#: Kinds of elements that a rollup starts from.
ROOT_KINDS = ("part", "item", "package", "action")


def richest(elements: DataFrame, cross: DataFrame) -> DataFrame:
    """root, attribute, valued, size: of the elements of ROOT_KINDS that own several the one with the most numbers below it (then the most elements, then the least key), and
    the most frequent attribute of these numbers, ties to the smaller name. No row if there is none.

    elements: key, kind, owner, attribute, num; cross: edges (src, dst) that a composition crosses besides ownership.
    """
    owned = elements.filter("owner is not null").select(F.col("owner").alias("src"), F.col("key").alias("dst"))
    children = owned.groupBy(F.col("src").alias("key")).agg(F.count(F.lit(1)).alias("children"))
    valued = F.col("num").isNotNull() & F.col("attribute").isNotNull()
    able = cut(elements.filter(F.col("kind").isin(*ROOT_KINDS)).join(children.filter("children > 1"), "key").select("key", "owner", valued.alias("own")))
    # what a candidate with a number reaches, an owner that is a candidate without one reaches too, and counts more of it: the owner comes first, also on circles
    better = able.filter("not own").select(F.col("key").alias("owner"))
    roots = cut(able.filter("not own").select("key").unionByName(able.filter("own").join(better, "owner", "left_anti").select("key")).withColumnRenamed("key", "root"))
    few = traverse.marks(roots, owned.unionByName(cross.select("src", "dst")), 64)
    if few:
        return _richest_marked(elements, *few)
    numbered = intervals.intervals(elements)
    ranges = cut(intervals.reach(roots, numbered, cross))
    numbers = elements.filter("num is not null and attribute is not null").select("key", F.col("attribute").alias("unit"), "num")
    held = intervals.below(ranges.select("entry", "pre", "post").distinct(), numbered, numbers)
    each = ranges.select("root", "entry").join(held, "entry").select("root", F.col("unit").alias("attribute"), "n")
    own = numbers.join(roots.select(F.col("root").alias("key")), "key").select(F.col("key").alias("root"), F.col("unit").alias("attribute"), F.lit(-1).cast("long").alias("n"))
    counts = each.unionByName(own).groupBy("root", "attribute").agg(F.sum("n").alias("n")).filter("n > 0")
    sizes = ranges.groupBy("root").agg((F.sum(F.col("post") - F.col("pre") + 1) - 1).alias("size"))
    return _best(counts, sizes)


def _richest_marked(elements: DataFrame, seen: DataFrame, names: DataFrame) -> DataFrame:
    """The same of few roots, whose bits the nodes have."""
    numbers = elements.filter("num is not null and attribute is not null").select(F.col("key").alias("node"), "attribute")
    counts = traverse.marked(numbers.join(seen, "node"), names).filter("node <> root").groupBy("root", "attribute").agg(F.count(F.lit(1)).alias("n"))
    sizes = traverse.marked(seen, names).groupBy("root").agg((F.count(F.lit(1)) - 1).alias("size"))
    return _best(counts, sizes)


def _best(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    total = counts.groupBy("root").agg(F.sum("n").alias("valued"), F.min(F.struct((-F.col("n")).alias("m"), "attribute")).alias("x"))
    best = total.join(sizes, "root").orderBy(F.desc("valued"), F.desc("size"), "root").limit(1)
    return best.select("root", F.col("x.attribute").alias("attribute"), "valued", "size")


def first(rows: DataFrame, value: str, name: str) -> DataFrame:
    """One row: the least value; null if there is none."""
    return rows.agg(F.min(value).alias(name))


def bind_values(elements: DataFrame, edges: DataFrame, cross: DataFrame) -> DataFrame:
    """One row of values, each null where the graph has none: start, name, attribute, valued and size of the richest element; kind, the most frequent one; requirement;
    state and element, ends of a transition and of a connection; label; word, the beginning of a long name."""
    best = richest(elements, cross).join(elements.select(F.col("key").alias("root"), "name"), "root").select(F.col("root").alias("start"), "name", "attribute", "valued", "size")
    most = elements.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).agg(F.min(F.struct((-F.col("n")).alias("m"), "kind")).alias("x")).select(F.col("x.kind").alias("kind"))
    starts = lambda label, name: first(edges.filter(F.col("label") == label), "src", name)
    word = first(elements.filter(F.length("name") > 4).select(F.substring("name", 1, 4).alias("w")), "w", "word")
    rows = [most, first(elements.filter("kind = 'requirement'"), "key", "requirement"), starts("transitionsTo", "state"), starts("connectedTo", "element"), word]
    one = reduce(DataFrame.crossJoin, rows)  # one row each
    known = one.withColumn("label", F.lit("owns"))
    return known.join(best, F.lit(True), "left")
