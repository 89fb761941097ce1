"""Similarity joins that don't score what can't be near: pivots, and the triangle inequality.

Rows of a group (a role, a module) lie on the unit sphere. Some of the group's rows are its pivots, and a row's home is the cell of its nearest pivot. A row y can
be within r of a row x of cell c only if y is within r of the plane that parts c from y's own cell, so y is sent to these cells and no others. Where two blocks of a
cell meet, the left one is split around rows that lie far from each other, and a right row is scored with a part only if the triangle inequality lets it come near
one of the part's rows. What is left is scored as products of matrices, and what passes once more in a fixed order.

Groups are dealt to tasks in chunks, cells in parts of bounded size, and pairs of blocks are rows of a join, so neither a large group nor a large cell is one task.
Where vectors are spread evenly over many dimensions, no bound excludes much, and all pairs of a group are scored, in blocks.

Rows: null or zero vectors, and those with null or non-finite components, take no part; vectors of different lengths aren't compared; equal rows count each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grapheon.plans.lineage import cut

#: Rows of a group for one pivot, most pivots of a group; rows of a chunk, and of a part of a cell; what rounding may take from a bound.
PIVOT_ROWS, MOST_PIVOTS, CHUNK, PART, SLACK = 1024, 512, 8192, 2048, 1e-6


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _prepared(rows: DataFrame, by: str, floor: float = -1.0) -> DataFrame:
    """key, avoid, side, g (group), x, least: rows that can be compared. side: 1 looks for partners, 2 is found, 3 both; least: the cosine that a partner has to have."""
    good = (F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf)) & F.exists("x", lambda v: v != 0)
    given = rows.select("key", "avoid", "side", F.col(by).cast("string").alias("by"), F.col("embedding").cast("array<double>").alias("x")).filter(F.col("x").isNotNull() & F.col("by").isNotNull()).filter(good)
    return given.withColumns({"g": F.concat_ws(":", F.size("x").cast("string"), "by"), "least": F.lit(float(floor))}).drop("by")


def _home(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of unit rows from each pivot, and each row's cell."""
    d2 = np.maximum(2.0 - 2.0 * (x @ pivots.T), 0.0)
    return d2, d2.argmin(1)


def _packed(kinds: str) -> str:
    return f"g string, cell int, side int, n int, {kinds}, x binary, least binary"


def _dealt(rows: DataFrame, pivots: DataFrame, kinds: str, radius: DataFrame | None, r: float) -> DataFrame:
    """Packed blocks of rows: side 1 at home; side 2 at each cell that they could have a partner in, or only at home where r is 0.

    pivots: g, parts, pivots (array of vectors). radius: g, cells (cell), radii, in place of r.
    """
    asked = pivots if radius is None else pivots.join(radius, "g", "left")
    chunks = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    own = rows.join(pivots.select("g", "parts"), "g").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts"))).drop("parts")
    chunks = chunks.select(*(F.col(c).alias(c) for c in chunks.columns))  # columns of their own, not those of rows
    schema = _packed(kinds)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        if not left.num_rows or not right.num_rows:
            return pa.table({n: [] for n in names}).cast(empty)
        x = _matrix(left.column("x").combine_chunks())
        u = _unit(x)
        p = _unit(_matrix(right.column("pivots").combine_chunks().flatten()))
        d2, home = _home(u, p)
        own = d2[np.arange(len(u)), home]
        side, least = left.column("side").to_numpy(), left.column("least").to_numpy()
        limit = np.full(len(p), r)
        if "radii" in right.column_names and right.column("cells")[0].as_py():
            limit[right.column("cells").combine_chunks().flatten().to_numpy()] = right.column("radii").combine_chunks().flatten().to_numpy()
        apart = np.sqrt(np.maximum(2.0 - 2.0 * (p @ p.T), 0.0))
        out: dict = {n: [] for n in names}
        g = left.column("g")[0].as_py()

        def add(cell: int, which: int, at: np.ndarray) -> None:
            for start in range(0, len(at), PART):
                i = at[start : start + PART]
                taken = left.take(pa.array(i))
                for n, v in zip(names, (g, cell, which, len(i), taken.column("key"), taken.column("avoid"), x[i].tobytes(), least[i].tobytes())):
                    out[n].append(v.to_pylist() if isinstance(v, pa.ChunkedArray) else v)

        for cell in range(len(p)):
            here = home == cell
            add(cell, 1, np.flatnonzero(here & (side & 1 > 0)))
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (d2[:, cell] - own) / (2.0 * apart[cell, home])
            near = here if limit[cell] <= 0 else here | ~(plane > limit[cell] + SLACK)
            add(cell, 2, np.flatnonzero(near & (side & 2 > 0)))
        return pa.table({n: pa.array(out[n], empty.field(n).type) for n in names})

    fields = {f.name: f for f in rows.schema}
    arrow = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    names = ["g", "cell", "side", "n", "key", "avoid", "x", "least"]
    kind = lambda c: pa.list_(arrow[fields[c].dataType.simpleString()])
    empty = pa.schema([("g", pa.string()), ("cell", pa.int32()), ("side", pa.int32()), ("n", pa.int32()), ("key", kind("key")), ("avoid", kind("avoid")), ("x", pa.binary()), ("least", pa.binary())])
    return own.groupBy("g", "part").cogroup(chunks.groupBy("g", "part")).applyInArrow(run, schema)


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows side by side, each summed from its first component to its last: the same wherever a pair is scored."""
    xy, xx, yy = np.zeros(len(x)), np.zeros(len(x)), np.zeros(len(x))
    for d in range(x.shape[1]):
        xy += x[:, d] * y[:, d]
        xx += x[:, d] * x[:, d]
        yy += y[:, d] * y[:, d]
    return xy / (np.sqrt(xx) * np.sqrt(yy))


def _parts(x: np.ndarray, enough: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that lie far from each other, the part of each row, and its distance from the part's row: the farthest row becomes one until none is farther than `enough`, or there are a sixteenth as many as rows."""
    chosen, part, d2 = [0], np.zeros(len(x), int), np.maximum(2.0 - 2.0 * (x @ x[0]), 0.0)
    while len(chosen) < max(1, len(x) // 16) and d2.max() > enough * enough:
        chosen.append(int(d2.argmax()))
        new = np.maximum(2.0 - 2.0 * (x @ x[chosen[-1]]), 0.0)
        part[new < d2] = len(chosen) - 1
        d2 = np.minimum(d2, new)
    return np.array(chosen), part, np.sqrt(d2)


def _scored(blocks: DataFrame, kinds: dict[str, str], k: int, counter) -> DataFrame:
    """src, dst, score: the k best partners that each row of a left block has in a right one, at or over its `least`. The rest can't be among its k best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = {c: batch.column(c)[row] for c in batch.schema.names}
                keys, others = np.array(at["key"].as_py(), object), np.array(at["other"].as_py(), object)
                x, y = (np.frombuffer(at[c].as_py()).reshape(at[n].as_py(), -1) for c, n in (("x", "n"), ("y", "m")))
                least = np.frombuffer(at["least"].as_py())
                _, code = np.unique(np.concatenate([at["avoid"].values.to_numpy(zero_copy_only=False), at["shun"].values.to_numpy(zero_copy_only=False)]), return_inverse=True)
                cx, cy = code[: len(x)], code[len(x) :]
                ux, uy = _unit(x), _unit(y)
                reach = np.sqrt(np.maximum(2.0 - 2.0 * least, 0.0)) + SLACK
                far, part, away = _parts(ux, reach.min() / 2)
                distance = np.sqrt(np.maximum(2.0 - 2.0 * (uy @ ux[far].T), 0.0))
                found = []
                for c in range(len(far)):
                    i = np.flatnonzero(part == c)
                    j = np.flatnonzero(distance[:, c] <= (away[i] + reach[i]).max() + SLACK)
                    if not len(j):
                        continue
                    if counter is not None:
                        counter.add(len(i) * len(j))
                    s = ux[i] @ uy[j].T
                    s[cx[i, None] == cy[None, j]] = -2.0
                    bar = least[i] - SLACK
                    if s.shape[1] > k:  # partners a little under the k-th are kept, so that rounding drops none
                        bar = np.maximum(bar, np.partition(s, -k, axis=1)[:, -k] - 1e-9)
                    a, b = np.nonzero((s >= bar[:, None]) & (s > -1.5))
                    found.append((i[a], j[b]))
                if not found:
                    continue
                i, j = (np.concatenate(z) for z in zip(*found))
                score = _exact(x[i], y[j])
                over = score >= least[i]
                yield pa.RecordBatch.from_arrays([pa.array(list(keys[i[over]]), kind), pa.array(list(others[j[over]]), kind), pa.array(score[over])], ["src", "dst", "score"])

    kind = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kinds["key"]]
    return blocks.mapInArrow(run, f"src {kinds['key']}, dst {kinds['key']}, score double")


def _pairs(dealt: DataFrame, kinds: dict[str, str], k: int, counter=None) -> DataFrame:
    left = dealt.filter("side = 1").select("g", "cell", "key", "avoid", "n", "x", "least", F.xxhash64("x", "key").alias("block"))
    # each left block is a key of its own, so a cell's blocks are dealt apart; right blocks go to each left block of their cell
    right = dealt.filter("side = 2").select("g", "cell", F.col("key").alias("other"), F.col("avoid").alias("shun"), F.col("n").alias("m"), F.col("x").alias("y"))
    wanted = right.join(left.select("g", "cell", "block").distinct(), ["g", "cell"])
    both = left.join(wanted, ["g", "cell", "block"])
    found = _scored(both.select("key", "avoid", "n", "x", "least", "other", "shun", "m", "y"), kinds, k, counter)
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("score"), "dst"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def _pivots(rows: DataFrame) -> DataFrame:
    """g, n, parts, pivots: of each group some rows, those of the smallest hashes, so the same on each run."""
    count = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    many = F.least(F.ceil(F.col("n") / PIVOT_ROWS), F.lit(MOST_PIVOTS))
    # a sample that is several times too large by hash alone, then the first of it
    drawn = rows.join(count, "g").filter(F.pmod(F.xxhash64("key", F.lit(7)), F.col("n")) < 4 * many + 16)
    nth = F.row_number().over(Window.partitionBy("g").orderBy(F.xxhash64("key", F.lit(8)), "key"))
    some = drawn.withColumn("nth", nth).filter(F.col("nth") <= many).groupBy("g").agg(F.collect_list("x").alias("pivots"))
    least = rows.groupBy("g").agg(F.min_by("x", F.xxhash64("key", F.lit(8))).alias("one"))  # a group whose draw is empty
    whole = count.join(least, "g").join(some, "g", "left").withColumn("pivots", F.coalesce("pivots", F.array("one")))
    return whole.select("g", "n", F.ceil(F.col("n") / CHUNK).cast("long").alias("parts"), "pivots")


def _kinds(rows: DataFrame) -> tuple[dict[str, str], str]:
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("key", "avoid")}
    return kinds, f"key array<{kinds['key']}>, avoid array<{kinds['avoid']}>"


def pairs_over(rows: DataFrame, floor: float, k: int, by: str, counter=None) -> DataFrame:
    """src, dst, score: for each row that looks (side 1 or 3) the k nearest rows that are found (side 2 or 3) of the same group, with a cosine at or over floor; ties to the smaller dst.

    rows: key, avoid, side, embedding and the column `by`. Rows of equal `avoid` are no pair. counter: an accumulator of the pairs that are scored.
    """
    given = cut(_prepared(rows, by, floor))
    kinds, packed = _kinds(given)
    pivots = cut(_pivots(given))
    return _pairs(cut(_dealt(given, pivots, packed, None, math.sqrt(max(0.0, 2.0 - 2.0 * floor)) + SLACK)), kinds, k, counter)


def nearest(rows: DataFrame, k: int, by: str, counter=None) -> DataFrame:
    """The same without a floor, for keys that occur once: a first pass inside the cells gives each row k partners, the k-th of which bounds its second pass, and a cell's farthest one what is sent to it."""
    given = cut(_prepared(rows, by))
    kinds, packed = _kinds(given)
    pivots = cut(_pivots(given))
    inner = cut(_dealt(given, pivots, packed, None, 0.0))
    first = cut(_pairs(inner, kinds, k, counter))
    kth = first.groupBy("src").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).select(F.col("src").alias("key"), (F.col("kth") - 1e-9).alias("kth"))
    bounded = cut(given.join(kth, "key", "left").withColumn("least", F.greatest(F.lit(-1.0), F.coalesce("kth", F.lit(-1.0)))).select(given.columns))
    cells = inner.filter("side = 1").select("g", "cell", F.explode("key").alias("key")).join(bounded.select("key", "least"), "key")
    far = F.max(F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * F.col("least"))) + SLACK)
    radius = cells.groupBy("g", "cell").agg(far.alias("r")).groupBy("g").agg(F.collect_list("cell").alias("cells"), F.collect_list("r").alias("radii"))  # as many as pivots
    return _pairs(cut(_dealt(bounded, pivots, packed, cut(radius), 0.0)), kinds, k, counter)
