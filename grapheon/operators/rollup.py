"""Rollups: totals by unit, totals with their parts, formula siblings, most frequent attributes, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grapheon.operators import intervals, traverse
from grapheon.plans.lineage import cut

MONEY = "decimal(18,2)"


def exact_sum(c: Column | str) -> Column:
    """A sum that doesn't depend on the order of rows: over decimals; 0 for nothing."""
    return F.coalesce(F.sum(F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)), F.lit(0).cast(MONEY)).cast("double")


def by_unit(reached: DataFrame, elements: DataFrame, *by: str) -> DataFrame:
    """unit, total, n: numeric attributes of the reached nodes; units are never mixed. reached: node, and the columns `by`, which totals are kept apart by."""
    numeric = elements.filter("num is not null").select(F.col("key").alias("node"), "unit", "num")
    return reached.join(numeric, "node").groupBy(*by, "unit").agg(exact_sum("num").alias("total"), F.count(F.lit(1)).alias("n"))


def by_unit_reached(roots: DataFrame, elements: DataFrame, edges: DataFrame) -> DataFrame:
    """root, unit, total, n of all that each root reaches. Few roots are bits of a node, which are told apart only after the join with its values."""
    found = traverse.marks(roots, edges)
    if not found:
        return by_unit(traverse.walk(roots, edges), elements, "root")
    numeric = elements.filter("num is not null").select(F.col("key").alias("node"), "unit", "num")
    return traverse.marked(numeric.join(found[0], "node").select("seen", "unit", "num"), found[1]).groupBy("root", "unit").agg(exact_sum("num").alias("total"), F.count(F.lit(1)).alias("n"))


def by_unit_below(roots: DataFrame, elements: DataFrame, cross: DataFrame) -> DataFrame:
    """root, unit, total, n of all that each root reaches over ownership and the edges `cross`: prefix differences of ranges, no row for each element below a root. elements: key, owner, unit, num."""
    numbered = intervals.intervals(elements)
    ranges = cut(intervals.reach(roots, numbered, cross))
    held = intervals.below(ranges.select("entry", "pre", "post").distinct(), numbered, elements.filter("num is not null").select("key", "unit", "num"))
    sums = ranges.select("root", "entry").join(held, "entry").groupBy("root", "unit").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return sums.select("root", "unit", F.col("total").cast("double").alias("total"), "n")


def sizes_below(roots: DataFrame, elements: DataFrame, cross: DataFrame) -> DataFrame:
    """root, size: how many elements each root reaches over ownership and the edges `cross`, itself left out."""
    numbered = intervals.intervals(elements)
    ranges = intervals.reach(roots, numbered, cross)
    return ranges.groupBy("root").agg((F.sum(F.col("post") - F.col("pre") + 1) - 1).alias("size")).filter("size > 0")


def with_parts(reached: DataFrame, elements: DataFrame, *by: str) -> DataFrame:
    """unit, total and the parts that make it (value, name), largest first; apart for the columns `by`. A total's parts are one row: meant for totals that a reader looks through."""
    numeric = elements.filter("num is not null").select(F.col("key").alias("node"), "name", "unit", "num")
    rows = reached.join(numeric, "node")
    return rows.groupBy(*by, "unit").agg(exact_sum("num").alias("total"), F.sort_array(F.collect_list(F.struct(F.col("num").alias("value"), "name")), asc=False).alias("parts"))


def formula_siblings(formulas: DataFrame, siblings: DataFrame) -> DataFrame:
    """owner, field, total: of each formula the sum of the siblings whose name its expression contains.

    formulas: owner, field, expression; siblings: owner, name, num. Joined on the owner, then tested, so work grows with an owner's siblings.
    """
    used = formulas.join(siblings, "owner").filter(F.col("expression").contains(F.col("name")))
    return used.groupBy("owner", "field").agg(exact_sum("num").alias("total"), F.count(F.lit(1)).alias("n"))


def top_attribute(reached: DataFrame, attributes: DataFrame) -> DataFrame:
    """root, attribute, n: the most frequent attribute below each root, ties to the smaller name. reached: root, node; attributes: node, attribute."""
    counts = reached.join(attributes, "node").groupBy("root", "attribute").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("root").agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("attribute").alias("attribute"))).alias("x"))
    return best.select("root", F.col("x.attribute").alias("attribute"), (-F.col("x.m")).alias("n"))


def coverage(required: DataFrame, edges: DataFrame, label: str = "satisfies") -> DataFrame:
    """n, covered, uncovered over required elements (key): a semi-join's mark, summed conditionally."""
    hit = edges.filter(F.col("label") == label).select(F.col("dst").alias("key")).distinct().withColumn("hit", F.lit(True))
    marked = required.select("key").join(hit, "key", "left")
    return marked.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("hit")).alias("covered"), F.count_if(F.col("hit").isNull()).alias("uncovered"))


def uncovered(required: DataFrame, edges: DataFrame, label: str = "satisfies") -> DataFrame:
    return required.join(edges.filter(F.col("label") == label).select(F.col("dst").alias("key")), "key", "left_anti")


def first_wins(edges: DataFrame, order: list[str]) -> DataFrame:
    """One edge for each (label, src, dst), the first in `order`; self-loops go. A min of a struct, so it combines before the shuffle."""
    rest = [c for c in edges.columns if c not in ("label", "src", "dst")]
    kept = edges.filter("src <> dst").groupBy("label", "src", "dst").agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("x"))
    return kept.select("label", "src", "dst", *[F.col(f"x.{c}").alias(c) for c in rest])


def vocabulary_differences(edges: DataFrame, declared: DataFrame) -> DataFrame:
    """label, fault: labels that are declared but not produced, and produced but not declared. declared: label."""
    made = edges.select("label").distinct()
    return declared.join(made, "label", "left_anti").select("label", F.lit("unproduced").alias("fault")).unionByName(made.join(declared, "label", "left_anti").select("label", F.lit("undeclared").alias("fault")))


def largest(rows: DataFrame, by: str) -> DataFrame:
    """by, n: the group with the most rows, ties to the smaller name."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by).limit(1)
