"""Exact top-k by integer inner product over a bit-sliced index.

Components are scaled to integers. For a block of rows, slice b of an attribute is a bitmap of
the rows whose value (less the attribute's least value) has bit b. A query adds up its weighted attributes
with bitmap adders: bit j of a weight adds the attribute's slices at position j; a negative weight adds the complemented
slices, which differ by a constant. The lowest `drop` bits of the attributes are left out of
the index, so sums are lower bounds with a known error. The k-th largest sum is found from the most significant
slice downward, all rows whose sum is within the error of it are kept, and these boundary
rows are scored exactly.

Rows with equal integer vectors are kept once with the k + 1 smallest ids, for no more of them can be among
the k best of any query. Every query meets every block of rows; the k best of each block are merged.

Sums that could leave 62 bits are taken with unbounded integers instead of int64, in an index of their own that keeps the upper 32 bits of the attributes;
everything else is the same. A score that doesn't fit a long shows as the largest or smallest long; rows are ranked by the exact one, which `exact_score` spells out.

Nulls and odd values: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a null id.
Only vectors of the query's length are its candidates.
Rows with the query's id are not its candidates; repeated rows (same id and vector) count once. Ties go to
the smaller id. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_SCHEMA = "query_id long, vec_id long, score long, beyond string"
LEAST, MOST = -(1 << 63), (1 << 63) - 1
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


class BitSliced:
    """Index of one block: rows is a matrix of int64 or, where sums could leave it, of Python integers."""

    def __init__(self, rows: np.ndarray, drop: int = 1):
        self.n, self.d = rows.shape
        self.least = rows.min(axis=0)
        if rows.dtype == object:
            drop = max(drop, int((rows - self.least).max()).bit_length() - 32)
        self.rows, self.drop = rows, drop
        shifted = (rows - self.least) >> drop
        self.bits = max(1, int(shifted.max()).bit_length())
        self.words = -(-self.n // 64)
        packed = np.zeros((self.d, self.bits, self.words * 8), np.uint8)
        for b in range(self.bits):
            packed[:, b, : -(-self.n // 8)] = np.packbits(((shifted >> b) & 1).T.astype(np.uint8), axis=1, bitorder="little")
        self.slices = packed.view(np.uint64)
        live = np.zeros(self.words * 8, np.uint8)
        live[: -(-self.n // 8)] = np.packbits(np.ones(self.n, np.uint8), bitorder="little")
        self.live = live.view(np.uint64)

    def sums(self, weights: np.ndarray) -> list[np.ndarray]:
        """Slices, least significant first, of the sums of |weight| * (attribute or its complement), for each query."""
        q = len(weights)
        size = np.abs(weights)
        flip = np.where(weights < 0, FULL, np.uint64(0))
        total: list[np.ndarray] = []
        for j in range(int(size.max()).bit_length()):
            on = np.where(((size >> j) & 1).astype(bool), FULL, np.uint64(0))
            part: list[np.ndarray] = []
            for a in np.flatnonzero(on.any(axis=0)):
                mask, turn = on[:, a, None], flip[:, a, None]
                _add(part, [(self.slices[a, b][None, :] ^ turn) & mask for b in range(self.bits)], 0)
            _add(total, part, j)
        return total or [np.zeros((q, self.words), np.uint64)]

    def top(self, weights: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query: rows that hold its k best (all ties at the boundary among them) and their exact scores."""
        sums = self.sums(weights)
        size = np.abs(weights)
        slack = size.sum(axis=1) * ((1 << self.drop) - 1)  # in units of the score
        slack = (slack >> self.drop) + 1  # in units of the sums
        out = []
        for i in range(len(weights)):
            own = [s[i] for s in sums]
            bound = int(_kth(own, self.live, k, self.n)) - int(slack[i])
            held = np.flatnonzero(np.unpackbits(_at_least(own, bound, self.live).view(np.uint8), bitorder="little")[: self.n])
            out.append((held, self.rows[held] @ weights[i]))
        return out


def _add(to: list[np.ndarray], more: list[np.ndarray], at: int) -> None:
    """to += more << at, slice by slice with full adders."""
    if not more:
        return
    while len(to) < at:
        to.append(np.zeros_like(more[0]))
    carry = None
    for b, x in enumerate(more):
        if at + b == len(to):
            to.append(x if carry is None else x ^ carry)
            carry = None if carry is None else x & carry
            continue
        y = to[at + b]
        half = x ^ y
        if carry is None:
            to[at + b], carry = half, x & y
        else:
            to[at + b], carry = half ^ carry, (x & y) | (half & carry)
    b = at + len(more)
    while carry is not None and carry.any():
        if b == len(to):
            to.append(carry)
            break
        y = to[b]
        to[b], carry = y ^ carry, y & carry
        b += 1


def _kth(slices: list[np.ndarray], live: np.ndarray, k: int, n: int) -> int:
    """The k-th largest value, or the least if there are fewer."""
    k = min(k, n)
    left, value = live, 0
    for b in range(len(slices) - 1, -1, -1):
        upper = left & slices[b]
        c = int(np.bitwise_count(upper).sum())
        if c >= k:
            left, value = upper, value | (1 << b)
        else:
            left, k = left & ~slices[b], k - c
    return value


def _at_least(slices: list[np.ndarray], bound: int, live: np.ndarray) -> np.ndarray:
    """Bitmap of the rows whose value is bound or more."""
    if bound <= 0:
        return live
    more, same = np.zeros_like(live), live
    for b in range(len(slices) - 1, -1, -1):
        if bound >> b & 1:
            same = same & slices[b]
        else:
            more, same = more | (same & slices[b]), same & ~slices[b]
    return more | same


def whole_vectors(df: DataFrame, scale: int) -> DataFrame:
    """vec_id and the vector, with components rounded down to multiples of 1 / scale, of the rows that take part. scale: a power of two, so that these are exact.

    From 2 ** 52 / scale on all doubles are such multiples.
    """
    if scale < 1 or scale & (scale - 1):
        raise ValueError("scale isn't a power of two")
    x = F.col("x")
    ok = F.col("vec_id").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")).filter(ok)
    return rows.select("vec_id", F.transform(x, lambda v: F.when(F.abs(v) < float((1 << 52) // scale), F.floor(v * scale) / F.lit(float(scale))).otherwise(v)).alias("v"))


def _matrices(column: pd.Series, scale: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, integer rows) of vectors: those of up to 24 bits, whose products int64 can sum, and the others."""
    x = np.stack(column.to_numpy()).astype(np.float64)
    small = np.abs(x).max(axis=1) < (1 << 24) / scale
    out = []
    if small.any():
        out.append((np.flatnonzero(small), (x[small] * scale).astype(np.int64)))
    if not small.all():
        whole = [[int(v) * scale if abs(v) >= 1 << 52 else int(v * scale) for v in row] for row in x[~small].tolist()]
        rows = np.empty((len(whole), x.shape[1]), object)
        rows[:] = whole
        out.append((np.flatnonzero(~small), rows))
    return out


def top_k(df: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, block_rows: int = 8192, block_queries: int = 2048, drop: int = 1) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of df with the largest integer inner product for each row of queries.

    df, queries: vec_id and embedding. Blocks bound what a task holds, whatever the tables' sizes.
    """
    rows, asked = whole_vectors(df, scale), whole_vectors(queries, scale).distinct()
    n, nq = rows.count(), asked.count()
    nr, nb = max(1, -(-n // block_rows)), max(1, -(-nq // block_queries))
    first = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.distinct().withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    kept = kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    left = kept.select("v", "ids", F.pmod(F.xxhash64("v"), F.lit(nr)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("part"))
    right = asked.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(nb)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nr - 1).cast("long"))).alias("block"))

    def search(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found: tuple[list, list, list, list] = ([], [], [], [])
        lengths_a, lengths_b = a["v"].map(len), b["v"].map(len)
        for size in sorted(set(lengths_b)):
            some, few = a[lengths_a == size], b[lengths_b == size]
            if some.empty:
                continue
            ids, own = some["ids"].to_list(), few["vec_id"].to_list()
            best: dict[int, list[tuple[int, int]]] = {i: [] for i in range(len(own))}
            for places, rows in _matrices(some["v"], scale):
                indexes: dict[bool, BitSliced] = {}
                for asking, weights in _matrices(few["v"], scale):
                    wide = rows.dtype == object or weights.dtype == object or size >= 1 << 14  # int64 holds sums of fewer than 2 ** 14 products of 48 bits
                    if wide not in indexes:
                        indexes[wide] = BitSliced(rows.astype(object) if wide else rows, drop)
                    given = weights.astype(object) if wide else weights
                    for at in range(0, len(asking), 64):
                        for q, (held, scores) in zip(asking[at : at + 64].tolist(), indexes[wide].top(given[at : at + 64], k + 1), strict=True):
                            best[q].extend((-int(s), int(i)) for h, s in zip(held, scores, strict=True) for i in ids[places[h]] if i != own[q])
            for q, rows in best.items():
                for s, i in sorted(rows)[:k]:
                    found[0].append(own[q])
                    found[1].append(i)
                    found[2].append(min(max(-s, LEAST), MOST))
                    found[3].append(None if LEAST <= -s <= MOST else str(-s))
        return pd.DataFrame({"query_id": found[0], "vec_id": found[1], "score": found[2]}, dtype="int64").assign(beyond=pd.Series(found[3], dtype=object))

    best = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(search, TOP_SCHEMA)
    rest = F.length("beyond")
    order = [F.desc("score"), F.when(F.col("score") > 0, rest).otherwise(-rest).desc_nulls_last(), F.when(F.col("score") > 0, F.col("beyond")).desc_nulls_last(), F.col("beyond").asc_nulls_first()]
    return ranked(best, k, order).withColumn("exact_score", F.coalesce("beyond", F.col("score").cast("string"))).drop("beyond")


def ranked(found: DataFrame, k: int, order: list | None = None) -> DataFrame:
    """query_id, rank, vec_id, score (and what else there is) of the k first rows of each query; ties go to the smaller vec_id."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*(order or [F.desc("score")]), "vec_id"))
    rest = [c for c in found.columns if c not in ("query_id", "vec_id", "score")]
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", *rest)
