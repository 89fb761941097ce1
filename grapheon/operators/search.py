"""Search: cosine top-k, BM25, reciprocal-rank fusion, analogies across models, greedy matching, clusters."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grapheon.operators import similarity
from grapheon.plans.lineage import cut

K1, B, RRF = 1.2, 0.75, 60


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def cosine_top(rows: DataFrame, query: Sequence[float], k: int, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The k rows nearest to one vector: a scan with a literal and a top-k, no join."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return rows.select(key, cosine(F.col(vector), q).alias("score")).orderBy(F.desc("score"), key).limit(k)


def postings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, term, tf, length: the inverted index."""
    terms = docs.select(key, F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda t: t != "").alias("terms")).withColumn("length", F.size("terms"))
    return terms.select(key, "length", F.explode("terms").alias("term")).groupBy(key, "term", "length").agg(F.count(F.lit(1)).alias("tf"))


def bm25(docs: DataFrame, words: Sequence[str], k: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The k best documents for a few query words. The words' counts are taken in the scan; nothing else of the index is built."""
    words = sorted({w.lower() for w in words})
    split = docs.select(key, F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda t: t != "").alias("_terms"))  # once for all words
    terms = F.col("_terms")
    counts = cut(split.select(key, F.size(terms).alias("length"), *((F.size(terms) - F.size(F.array_remove(terms, w))).alias(f"tf{i}") for i, w in enumerate(words))))  # a few numbers a row, read twice
    stats = counts.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"), *(F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(words))))
    joined = counts.crossJoin(F.broadcast(stats))  # one row of statistics
    score = F.lit(0.0)
    for i in range(len(words)):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        idf = F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    return joined.select(key, score.alias("score")).filter("score > 0").orderBy(F.desc("score"), key).limit(k)


def bm25_postings(index: DataFrame, words: Sequence[str], k: int, documents: int, mean: float, key: str = "doc_id") -> DataFrame:
    """The same from the inverted index (of `postings`): only the words' rows are read. documents, mean: how many there are, and their mean length."""
    rows = index.filter(F.col("term").isin(sorted({w.lower() for w in words})))
    df = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))  # a row a word
    idf = F.log(1 + (F.lit(documents) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    score = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(mean)))
    return rows.join(F.broadcast(df), "term").groupBy(key).agg(F.sum(score).alias("score")).orderBy(F.desc("score"), key).limit(k)


def fuse(rankings: Sequence[DataFrame], k: int, key: str = "doc_id") -> DataFrame:
    """Reciprocal-rank fusion of short rankings (key, score)."""
    ranks = None
    for r in rankings:
        part = r.select(key, F.row_number().over(Window.orderBy(F.desc("score"), key)).alias("rank"))
        ranks = part if ranks is None else ranks.unionByName(part)
    return ranks.groupBy(key).agg(F.sum(1.0 / (RRF + F.col("rank"))).alias("rrf")).orderBy(F.desc("rrf"), key).limit(k)


def analogies(rows: DataFrame, floor: float = 0.55, window: int = 50, counter=None) -> DataFrame:
    """src, dst, score: for rows of all models but the largest, the `window` nearest rows of the same role in other models.

    rows: key, model, role, embedding. A similarity join with bounds from pivots; see operators/similarity.py.
    """
    largest = rows.groupBy("model").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "model").limit(1).select(F.col("model").alias("_largest"))
    sided = rows.join(F.broadcast(largest), F.col("model") == F.col("_largest"), "left").select("key", F.col("model").alias("avoid"), "role", "embedding", F.when(F.col("_largest").isNull(), 3).otherwise(2).alias("side"))
    return similarity.pairs_over(sided, floor, window, "role", counter)


def reciprocal_once(pairs: DataFrame) -> DataFrame:
    """Each unordered pair once, with its best score."""
    return pairs.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.max("score").alias("score"))


def greedy(pairs: DataFrame, per_src: int = 3, per_dst: int = 2) -> DataFrame:
    """Pairs taken best first while neither end is full; ties go to the smaller src, then dst.

    In rounds, with the same result as one pass over all pairs: a pair that is among the best of its src and of its dst, as many as each has room for, can't
    be crowded out, so all such pairs are taken at once; then pairs with a full end go. The best pair of all is always one, so the rounds end. A checkpoint ends each.
    """
    best = [F.desc("score"), "src", "dst"]
    left = cut(pairs.withColumn("_s", F.lit(per_src)).withColumn("_d", F.lit(per_dst)))
    taken = left.select(*pairs.columns).limit(0)
    while not left.isEmpty():
        src, dst = Window.partitionBy("src"), Window.partitionBy("dst")
        take = (F.row_number().over(src.orderBy(*best)) <= F.col("_s")) & (F.row_number().over(dst.orderBy(*best)) <= F.col("_d"))
        marked = left.withColumn("_take", take.cast("int"))
        marked = cut(marked.withColumn("_s", F.col("_s") - F.sum("_take").over(src)).withColumn("_d", F.col("_d") - F.sum("_take").over(dst)))
        taken = taken.unionByName(marked.filter("_take = 1").select(*pairs.columns))
        left = marked.filter("_take = 0 and _s > 0 and _d > 0").drop("_take")
    return taken


def clusters(nodes: DataFrame, edges: DataFrame, rounds: int = 10) -> DataFrame:
    """module, node, cluster: label propagation inside each module, deterministic. nodes: module, node; edges: module, a, b, weight. A module is one task."""

    def run(key: tuple, n: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        label = {x: x for x in sorted(n["node"])}
        near: dict = {x: [] for x in label}
        for a, b, w in zip(e["a"], e["b"], e["weight"], strict=True):
            near[a].append((b, w))
            near[b].append((a, w))
        for _ in range(rounds):
            moved = False
            for x in label:
                votes: dict = {}
                for y, w in near[x]:
                    votes[label[y]] = votes.get(label[y], 0.0) + w
                if votes:
                    best = min(votes, key=lambda c: (-votes[c], c))
                    if votes[best] > votes.get(label[x], 0.0):
                        label[x], moved = best, True
            if not moved:
                break
        return pd.DataFrame({"module": key[0], "node": list(label), "cluster": list(label.values())})

    edges = edges.select(*(F.col(c).alias(c) for c in ("module", "a", "b", "weight")))  # columns of their own, not those of nodes
    return nodes.groupBy("module").cogroup(edges.groupBy("module")).applyInPandas(run, "module string, node string, cluster string")
