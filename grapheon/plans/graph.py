"""The property graph: elements and typed, directed edges as two DataFrames, and a graph view of relational tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Edges that a composition walk crosses; never specializes.
COMPOSITION = ("owns", "typedBy", "subsets", "redefines")


@dataclass
class Graph:
    """elements: key, kind, name, owner, depth, attribute, num, unit. edges: src, dst, label, and what else they carry."""

    elements: DataFrame
    edges: DataFrame

    def labelled(self, *labels: str) -> DataFrame:
        """Edges of these labels: filtered before any walk, so a path never leaves them."""
        return self.edges.filter(F.col("label").isin(*labels)) if labels else self.edges


def _key(kind: str, column: str) -> Column:
    return F.concat(F.lit(kind + "/"), F.col(column).cast("string"))


def table_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """Region owns nation owns customer and supplier; customer owns order; order is typed by parts; supplier satisfies order."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    none = F.lit(None)

    def rows(table: str, key: Column, kind: str, name: Column, owner: Column, depth: int, attribute: str | None = None, num: str | None = None, unit: str | None = None) -> DataFrame:
        return read(table).select(
            key.alias("key"), F.lit(kind).alias("kind"), name.alias("name"), owner.cast("string").alias("owner"), F.lit(depth).alias("depth"),
            F.lit(attribute).cast("string").alias("attribute"), (F.col(num) if num else none).cast("double").alias("num"), F.lit(unit).cast("string").alias("unit"),
        )

    parts = [
        rows("region", _key("region", "r_regionkey"), "package", F.col("r_name"), none, 0),
        rows("nation", _key("nation", "n_nationkey"), "package", F.col("n_name"), _key("region", "n_regionkey"), 1),
        rows("customer", _key("customer", "c_custkey"), "part", F.col("c_name"), _key("nation", "c_nationkey"), 2, "acctbal", "c_acctbal", "usd"),
        rows("supplier", _key("supplier", "s_suppkey"), "part", F.col("s_name"), _key("nation", "s_nationkey"), 2, "acctbal", "s_acctbal", "usd"),
        rows("part", _key("part", "p_partkey"), "part_definition", F.col("p_name"), none, 0, "retailprice", "p_retailprice", "eur"),
        rows("orders", _key("order", "o_orderkey"), "requirement", _key("Order", "o_orderkey"), _key("customer", "o_custkey"), 3, "totalprice", "o_totalprice", "chf"),
    ]
    elements = parts[0]
    for p in parts[1:]:
        elements = elements.unionByName(p)
    line = read("lineitem")
    edges = (
        elements.filter("owner is not null").select(F.col("owner").alias("src"), F.col("key").alias("dst"), F.lit("owns").alias("label"))
        .unionByName(line.select(_key("order", "l_orderkey").alias("src"), _key("part", "l_partkey").alias("dst"), F.lit("typedBy").alias("label")).distinct())
        .unionByName(line.select(_key("supplier", "l_suppkey").alias("src"), _key("order", "l_orderkey").alias("dst"), F.lit("satisfies").alias("label")).distinct())
    )
    return Graph(elements, edges)
