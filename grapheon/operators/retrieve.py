"""Retrieval: relations by meaning, and the three scopes of a question (entities, reports, both with the text).

A scope gives rows, not an answer: key, what (entity, relation, report or chunk) and score. Rankings are top-ks of scans; what is fused and expanded afterwards is short.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grapheon.operators import similarity
from grapheon.operators.search import bm25, cosine, cosine_top, fuse
from grapheon.plans.lineage import cut

#: Reports less similar to the question than this say nothing about it; calls of the embedding service take so many texts.
FLOOR, BATCH = 0.25, 64


def search_relations(edges: DataFrame, query: Sequence[float], k: int = 8, relation: str | int | None = None) -> DataFrame:
    """key, relation, score: the k relations nearest to a vector, of one type if given. edges: key, relation, embedding; those without a vector take no part."""
    rows = edges.filter("embedding is not null")
    if relation is not None:
        rows = rows.filter(F.col("relation") == relation)
    q = F.array(*(F.lit(float(x)) for x in query))
    return rows.select("key", "relation", cosine(F.col("embedding"), q).alias("score")).orderBy(F.desc("score"), "key").limit(k)


def hybrid(rows: DataFrame, query: Sequence[float], words: Sequence[str], k: int, window: int = 20) -> DataFrame:
    """key, rrf: vector and lexical rankings of rows (key, text, embedding), fused."""
    near = cosine_top(rows.filter("embedding is not null"), query, window, key="key")
    return fuse([near, bm25(rows, words, window, key="key")], k, key="key")


def local(entities: DataFrame, relations: DataFrame, query: Sequence[float], words: Sequence[str], k: int = 5) -> DataFrame:
    """The k entities that match, and the relations (key, src, dst) that touch them; a relation has the score of its best end."""
    return _with_relations(cut(hybrid(entities, query, words, k)), relations)


def _with_relations(found: DataFrame, relations: DataFrame) -> DataFrame:
    hits = found.select(F.col("key").alias("end"), "rrf")
    ends = relations.select("key", F.explode(F.array_distinct(F.array("src", "dst"))).alias("end"))
    touched = ends.join(F.broadcast(hits), "end").groupBy("key").agg(F.max("rrf").alias("rrf"))  # k rows
    named = lambda df, what: df.select(F.lit(what).alias("what"), F.col("key").cast("string").alias("key"), F.col("rrf").alias("score"))
    return named(found, "entity").unionByName(named(touched, "relation"))


def reports(rows: DataFrame, query: Sequence[float], k: int = 5, floor: float = FLOOR) -> DataFrame:
    """The global scope: the k reports (key, embedding) nearest to the question that aren't under the floor; none for a question off the topic."""
    return cosine_top(rows, query, k, key="key").filter(F.col("score") >= floor).select(F.lit("report").alias("what"), F.col("key").cast("string").alias("key"), "score")


def unified(entities: DataFrame, relations: DataFrame, chunks: DataFrame, query: Sequence[float], words: Sequence[str], k: int = 5) -> DataFrame:
    """Chunks of text and the entity graph, searched side by side: a fact that no entity's name resembles is found in the text."""
    found = cut(hybrid(entities, query, words, k))  # k rows
    read = found if chunks is entities else hybrid(chunks, query, words, k)
    text = read.select(F.lit("chunk").alias("what"), F.col("key").cast("string").alias("key"), F.col("rrf").alias("score"))
    return _with_relations(found, relations).unionByName(text)


def similar_within(rows: DataFrame, k: int = 3, counter=None) -> DataFrame:
    """src, dst, score: the k nearest rows of the same module. rows: key (each once), module, embedding. The module is compared before anything is ranked, so no foreign row takes a place."""
    return similarity.nearest(rows.select("key", F.col("key").alias("avoid"), F.lit(3).alias("side"), "module", "embedding"), k, "module", counter)


def attach(rows: DataFrame, vectors: DataFrame, key: str = "key") -> DataFrame:
    """rows with the embedding of their id, never of their position; null where there is none."""
    return rows.join(vectors.select(key, "embedding"), key, "left")


def embedded(rows: DataFrame, service: Callable[[list[str]], list[list[float]]], batch: int = BATCH) -> DataFrame:
    """key, embedding of rows (key, text): the caller's service, `batch` texts a call. A null text is an empty one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), batch):
                part = f.iloc[at : at + batch]
                yield pd.DataFrame({"key": part["key"], "embedding": service([t or "" for t in part["text"]])})

    given = rows.select("key", F.col("text").cast("string").alias("text"))
    return given.mapInPandas(run, f"key {given.schema['key'].dataType.simpleString()}, embedding array<double>")
