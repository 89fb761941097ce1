"""Approximate nearest neighbours by cosine: balanced posting lists under a centroid graph.

Fit: spherical k-means with a size penalty on a bounded sample (`sample` rows, those with the least hash of
their id) gives centroids, one for `list_rows` rows, or, in small tables, as many as the square root of the rows; the driver holds at most `sample` vectors and
`most_centroids` centroids. A neighbour graph over the centroids is searched best-first, from fixed entries, for rows and queries alike, in
batches, each row with a beam of bounded width. Every row is indexed: in its nearest list, and, if it lies near a boundary, in up to `copies` lists
whose distance is at most (1 + `closure`) times the nearest one. A query first reads the lists within
`ratio` times the distance of its nearest centroid, `probes` of them at most. Then it reads on: every row has one home
list, and a list that is still unread is left out only if the angle to its centroid, less the largest angle of a row at
home there, is more than the angle of the k-th row found. So no nearer row is lost, however many lists there are. Where
vectors are spread evenly the bound rules out little, and nearly all home lists are read.

Lists longer than `chunk` rows are split into chunks by a hash of the id, each chunk a group of its own, and
a query reads all chunks of a list, so no list is cut off. When it reads on, home lists are grouped to blocks of about
`block_rows` rows (a longer list is dealt over several), so a query goes once to each block it needs. Beyond most_centroids * list_rows rows, lists and the work of a query grow with the table. Rows with equal vectors are kept once with the k + 1 smallest ids,
for no more of them can be among a query's k nearest.

Scores are the cosines of the original vectors in double precision. Nulls and odd values: vectors that are null, empty, zero,
or hold null or non-finite components take no part, nor do rows with a null id. Only vectors of the query's length are its candidates; each length has an index. Rows with the query's id are not its candidates; repeated rows count
once. Ties go to the smaller id; a pair's score is summed in one order, so it is the same wherever the pair is met. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grapheon.llm.common import cut
from grapheon.llm.topk import ranked

FOUND_SCHEMA = "query_id long, vec_id long, score double"


def kmeans(x: np.ndarray, k: int, rounds: int = 12, penalty: float = 0.15, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit vectors; lists that are too long get a handicap, so sizes even out."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    handicap = np.zeros(k, np.float32)
    for _ in range(rounds):
        near = np.concatenate([np.argmax(x[a : a + 4096] @ c.T - handicap, axis=1) for a in range(0, len(x), 4096)])
        size = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        empty = size == 0
        total[empty] = x[rng.choice(len(x), int(empty.sum()))]
        c = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-12)
        handicap = (penalty * np.log1p(size * k / len(x)) / np.log(2)).astype(np.float32) * 0.2
    return c.astype(np.float32)


class CentroidGraph:
    """Neighbour graph over unit centroids: nearest neighbours and a few far links; best-first search in batches."""

    def __init__(self, centroids: np.ndarray, degree: int = 24, far: int = 4, entries: int = 16, seed: int = 3):
        self.c = centroids
        n = len(centroids)
        rng = np.random.default_rng(seed)
        near = []
        for a in range(0, n, 1024):
            s = centroids[a : a + 1024] @ centroids.T
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -2
            near.append(np.argsort(-s, axis=1, kind="stable")[:, : min(degree, max(1, n - 1))])
        self.links = np.concatenate([np.concatenate(near), rng.integers(0, n, (n, far))], axis=1)
        chosen = [0]
        for _ in range(min(entries, n) - 1):  # far apart from each other
            chosen.append(int(np.argmin((centroids @ centroids[chosen].T).max(axis=1))))
        self.entries = np.unique(chosen)

    def search(self, x: np.ndarray, want: int, beam: int = 48) -> tuple[np.ndarray, np.ndarray]:
        """The `want` nearest centroids found for each row of x, nearest first, and their cosines; -1 and -2 where there are fewer.

        Each row holds the `beam` best centroids that it has met. A step opens the best one not opened yet and meets its links; work and memory don't grow with the number of centroids.
        """
        m, n = len(x), len(self.c)
        beam = min(max(beam, want), n)
        ids = np.full((m, beam), -1, np.int64)
        score = np.full((m, beam), -2, np.float32)
        opened = np.zeros((m, beam), bool)

        def meet(rows: np.ndarray, near: np.ndarray) -> None:
            near = np.sort(near, axis=1)
            cos = np.einsum("ijk,ik->ij", self.c[near], x[rows], optimize=True).astype(np.float32)
            twice = np.zeros(near.shape, bool)
            twice[:, 1:] = near[:, 1:] == near[:, :-1]
            cos[twice | (near[:, :, None] == ids[rows][:, None, :]).any(axis=2)] = -3
            both = np.concatenate([score[rows], cos], axis=1)
            top = np.argsort(-both, axis=1, kind="stable")[:, :beam]
            score[rows] = np.maximum(np.take_along_axis(both, top, 1), -2)
            ids[rows] = np.where(np.take_along_axis(both, top, 1) > -2, np.take_along_axis(np.concatenate([ids[rows], near], axis=1), top, 1), -1)
            opened[rows] = np.take_along_axis(np.concatenate([opened[rows], np.zeros(near.shape, bool)], axis=1), top, 1)

        meet(np.arange(m), np.tile(self.entries, (m, 1)))
        for _ in range(2 * beam):
            ready = np.where(opened | (ids < 0), -3, score)
            top = np.argmax(ready, axis=1)
            go = np.flatnonzero(ready[np.arange(m), top] > -2)
            if not len(go):
                break
            opened[go, top[go]] = True
            meet(go, self.links[ids[go, top[go]]])
        return ids[:, :want], score[:, :want]


def _unit(column: pd.Series) -> np.ndarray:
    x = np.stack(column.to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def finite_vectors(df: DataFrame) -> DataFrame:
    ok = F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).filter(ok)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of all rows of a with all rows of b, but for the last digits, which depend on how products are summed. Scaled first, so that large components don't overflow."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a @ b.T) / (np.sqrt((a * a).sum(axis=1))[:, None] * np.sqrt((b * b).sum(axis=1))[None, :])


def exact_cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the vector a with all rows of b: sums from the first component to the last, so a pair has one score wherever it is met. Components whose squares could leave a double are scaled by a power of two."""
    a, b = _scaled(a[None])[0], _scaled(b)
    dot, aa, bb = (np.add.accumulate(x, axis=-1)[..., -1] for x in (a * b, a * a, b * b))
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def _scaled(x: np.ndarray) -> np.ndarray:
    top = np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]
    return np.where(np.abs(top) > 400, np.ldexp(x, -top), x)


def _angles(column: pd.Series, c: np.ndarray) -> np.ndarray:
    """Angles of all vectors with all rows of c, which are of length 1, in double precision."""
    x = np.stack(column.to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return np.arccos(np.clip((x / np.linalg.norm(x, axis=1, keepdims=True)) @ c.T, -1, 1))


def _extents(c: np.ndarray):
    """Batches of (v, ids, lists) to the count of each home list and its largest angle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), 1024):
                part = pdf.iloc[a : a + 1024]
                home = part["lists"].map(lambda x: x[0]).to_numpy()
                angle = _angles(part["v"], c)[np.arange(len(part)), home]
                yield pd.DataFrame({"list": home, "angle": angle}).groupby("list", as_index=False).agg(n=("angle", "size"), angle=("angle", "max"))

    return run


def _blocks(size: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The first block of each list and the number of its blocks; short lists share one."""
    first, parts = np.zeros(len(size), np.int64), np.ones(len(size), np.int64)
    block = held = 0
    for at, rows in enumerate(size.tolist()):
        if held and held + rows > block_rows:
            block, held = block + 1, 0
        first[at], parts[at] = block, max(1, -(-rows // block_rows))
        held += rows
        if parts[at] > 1:
            block, held = block + int(parts[at]), 0
    return first, parts


def _unread(c: np.ndarray, size: np.ndarray, extent: np.ndarray, first: np.ndarray, parts: np.ndarray):
    """Batches of (vec_id, v, lists, least) to a row for each block with home lists that aren't among `lists` and may hold a score of `least` or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), 1024):
                part = pdf.iloc[a : a + 1024]
                least = part["least"].to_numpy(np.float64)
                bound = np.where(np.isnan(least), np.inf, np.arccos(np.clip(least, -1, 1)))
                need = (_angles(part["v"], c) - extent <= bound[:, None] + 1e-6) & (size > 0)
                out: list[tuple] = []
                for row, x in zip(part.itertuples(index=False), need, strict=True):
                    x[row.lists] = False
                    lists = np.flatnonzero(x)
                    for b in np.unique(first[lists]).tolist():
                        held = lists[first[lists] == b]
                        out.extend((row.vec_id, row.v, row.least, b + p, held.tolist()) for p in range(int(parts[held].max())))
                yield pd.DataFrame(out, columns=["vec_id", "v", "least", "block", "lists"])

    return run


def _best(a: pd.DataFrame, b: pd.DataFrame, k: int, found: tuple[list, list, list]) -> None:
    """Adds the k best rows of a for each row of b."""
    data, ids = np.stack(a["v"].to_numpy()), a["ids"].to_list()
    for at in range(0, len(b), 256):
        part = b.iloc[at : at + 256]
        cos = cosines(np.stack(part["v"].to_numpy()), data)
        some = min(k + 1, cos.shape[1])
        bound = -np.partition(-cos, some - 1, axis=1)[:, some - 1]
        bound = np.maximum(bound, part["least"].fillna(-2.0).to_numpy() - 1e-9)
        for q, given, c, least in zip(part["vec_id"].to_list(), np.stack(part["v"].to_numpy()), cos, bound, strict=True):
            held = np.flatnonzero(c >= least - 1e-9)
            best = sorted((-s, int(i)) for h, s in zip(held, exact_cosines(given, data[held]).tolist(), strict=True) for i in ids[h] if i != q)[:k]
            found[0].extend([q] * len(best))
            found[1].extend(i for _, i in best)
            found[2].extend(-s for s, _ in best)


def _frame(found: tuple[list, list, list]) -> pd.DataFrame:
    return pd.DataFrame({"query_id": found[0], "vec_id": found[1], "score": found[2]}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def _assign(graph: CentroidGraph, most: int, ratio: float, beam: int):
    """Batches of (…, v) to the same rows with `lists`: centroids within `ratio` of the nearest distance."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), 256):
                part = pdf.iloc[a : a + 256]
                found, cos = graph.search(_unit(part["v"]), most, beam)
                dist = np.sqrt(np.maximum(0, 2 - 2 * cos))
                keep = (dist <= ratio * dist[:, :1] + 1e-6) & (found >= 0)
                yield part.assign(lists=[f[k].tolist() for f, k in zip(found, keep, strict=True)])

    return run


def _nearest(
    rows: DataFrame,
    asked: DataFrame,
    n: int,
    k: int,
    list_rows: int,
    sample: int,
    most_centroids: int,
    copies: int,
    closure: float,
    probes: int,
    ratio: float,
    chunk: int,
    block_rows: int,
) -> DataFrame:
    """The k nearest of the n rows for each row of asked; all vectors are of one length."""
    ids = rows.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)  # ids first, then their vectors: both are bounded
    fitted = rows.join(F.broadcast(ids), "vec_id").groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").toPandas()["v"]
    x = _unit(fitted)
    lists = max(1, min(max(n // list_rows, isqrt(n)), most_centroids, len(x) // 4))
    graph = CentroidGraph(kmeans(x, lists))

    first = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.distinct().withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    kept = kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    posted = cut(kept.mapInPandas(_assign(graph, copies, 1 + closure, 16), "v array<double>, ids array<long>, lists array<long>"))
    probed = cut(asked.mapInPandas(_assign(graph, probes, ratio, probes), "vec_id long, v array<double>, lists array<long>"))
    chunks = max(1, -(-n * copies // (lists * chunk)))  # a list of average length is one chunk; a longer one is spread evenly over all of its chunks
    spread = max(chunks, -(-n // (64 * chunk)))
    left = posted.select("v", "ids", F.explode("lists").alias("list"), F.pmod(F.xxhash64("ids"), F.lit(spread)).alias("chunk"))
    right = probed.select("vec_id", "v", F.explode("lists").alias("list")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))).withColumn("chunk", F.col("chunk").cast("long"))

    def search(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found: tuple[list, list, list] = ([], [], [])
        if len(a) and len(b):
            _best(a, b.assign(least=np.nan), k, found)
        return _frame(found)

    near = left.groupBy("list", "chunk").cogroup(right.groupBy("list", "chunk")).applyInPandas(search, FOUND_SCHEMA)
    near = cut(ranked(near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k))
    if lists == 1:
        return near

    c = graph.c.astype(np.float64)
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    held, extent = np.zeros(lists, np.int64), np.zeros(lists)
    home = posted.mapInPandas(_extents(c), "list long, n long, angle double").groupBy("list").agg(F.sum("n").alias("n"), F.max("angle").alias("angle")).toPandas()  # a row a centroid
    held[home["list"]], extent[home["list"]] = home["n"], home["angle"]
    first_block, parts = _blocks(held, block_rows)
    places = rows.sparkSession.createDataFrame([(i, int(b), int(p)) for i, (b, p) in enumerate(zip(first_block, parts, strict=True))], "list long, first long, parts long")
    least = near.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    wanted = probed.join(least, "vec_id", "left").select("vec_id", "v", "lists", "least")
    wanted = wanted.mapInPandas(_unread(c, held, extent, first_block, parts), "vec_id long, v array<double>, least double, block long, lists array<long>")
    at_home = posted.select("v", "ids", F.col("lists")[0].alias("list")).join(F.broadcast(places), "list")
    at_home = at_home.select("v", "ids", "list", (F.col("first") + F.pmod(F.xxhash64("ids"), F.col("parts"))).alias("block"))

    def search_on(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found: tuple[list, list, list] = ([], [], [])
        if len(a) and len(b):
            asking: dict[int, list[int]] = {}
            for at, some in enumerate(b["lists"]):
                for i in some:
                    asking.setdefault(int(i), []).append(at)
            for i, some in a.groupby("list"):
                if i in asking:
                    _best(some, b.iloc[asking[i]], k, found)
        return _frame(found)

    far = at_home.groupBy("block").cogroup(wanted.groupBy("block")).applyInPandas(search_on, FOUND_SCHEMA)
    found = near.select("query_id", "vec_id", "score").unionByName(far)
    return ranked(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k)


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int = 5,
    list_rows: int = 256,
    sample: int = 32_768,
    most_centroids: int = 8192,
    copies: int = 4,
    closure: float = 0.12,
    probes: int = 48,
    ratio: float = 1.6,
    chunk: int = 1024,
    block_rows: int = 8192,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of df for each row of queries. Each vector length has an index of its own."""
    rows, asked = finite_vectors(df), finite_vectors(queries).distinct()
    sizes = {r["size"]: r["n"] for r in rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).collect()}  # a row a length
    out = None
    for size in sorted(sizes):
        of = lambda part, size=size: part.filter(F.size("v") == size)
        found = _nearest(of(rows), of(asked), sizes[size], k, list_rows, sample, most_centroids, copies, closure, probes, ratio, chunk, block_rows)
        out = found if out is None else out.unionByName(found)
    return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double") if out is None else out
