"""Changes as new DataFrames: upsert, partial update, scoped delete, pruning of inferred edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: str = "key") -> DataFrame:
    """new replaces old rows of the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def update(old: DataFrame, new: DataFrame, key: str = "key") -> DataFrame:
    """Columns of new that aren't null win; rows that only new has are not added."""
    both = old.alias("o").join(new.alias("n"), key, "left")
    return both.select(*(F.col(key) if c == key else F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) if c in new.columns else F.col(f"o.{c}").alias(c) for c in old.columns))


def keep_labels(edges: DataFrame, labels: list[str]) -> DataFrame:
    """A scoped delete: everything but these labels goes."""
    return edges.filter(F.col("label").isin(labels))


def without_dangling(edges: DataFrame, elements: DataFrame, end: str = "src") -> DataFrame:
    return edges.join(elements.select(F.col("key").alias(end)), end, "left_semi")


def prune(inferred: DataFrame, stated: DataFrame, structural: list[str]) -> DataFrame:
    """Inferred edges without structural relations, reflexive ones, and twins of stated edges (either way round)."""
    kept = inferred.filter(~F.lower("label").isin([x.lower() for x in structural])).filter("src <> dst")
    ends = lambda df: df.withColumn("_a", F.least("src", "dst")).withColumn("_b", F.greatest("src", "dst"))  # noqa: E731  a twin either way round has the same two ends
    return ends(kept).join(ends(stated.select("src", "dst")).select("_a", "_b"), ["_a", "_b"], "left_anti").drop("_a", "_b")


def replace_type(edges: DataFrame, label: str, new: DataFrame) -> DataFrame:
    return edges.filter(F.col("label") != label).unionByName(new)


def stamp(chunks: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Provenance over two hops: links (node, chunk) joined with chunks (chunk, value) to a sorted set of values on each node."""
    return links.join(chunks, "chunk").groupBy("node").agg(F.sort_array(F.collect_set("value")).alias(name))
