import random

import pytest
from pyspark.sql import functions as F

from grapheon.operators import intervals, rollup


def forest(seed, n=400):
    """key, owner: a forest with a chain, an owner of many, and keys in an order of their own."""
    rng = random.Random(seed)
    names = [f"k{rng.randrange(10**6):06d}_{i}" for i in range(n)]
    owner = {names[0]: None}
    for i in range(1, n):
        owner[names[i]] = None if rng.random() < 0.02 else names[i - 1] if i < 30 else names[7] if rng.random() < 0.4 else names[rng.randrange(i)]
    return owner


def children(owner):
    out = {}
    for k, o in owner.items():
        out.setdefault(o, []).append(k)
    return out


def subtree(key, kids):
    todo, out = [key], []
    while todo:
        k = todo.pop()
        out.append(k)
        todo += kids.get(k, [])
    return out


def test_a_subtree_is_a_range(spark):
    owner = forest(1)
    rows = [*owner.items(), ("orphan", "nobody"), ("circle_a", "circle_b"), ("circle_b", "circle_a"), ("under", "circle_a")]
    got = {r.key: r for r in intervals.intervals(spark.createDataFrame(rows, "key string, owner string").repartition(4)).collect()}
    assert set(got) == {*owner, "orphan"} and sorted(r.pre for r in got.values()) == list(range(len(got)))
    kids = children(owner)
    for k in owner:
        below = subtree(k, kids)
        assert {x for x, r in got.items() if got[k].pre <= r.pre <= got[k].post} == set(below)
        assert got[k].depth == (0 if owner[k] is None else got[owner[k]].depth + 1)


def test_too_deep_is_an_error(spark):
    with pytest.raises(RuntimeError):
        intervals.intervals(spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(6)], "key string, owner string"), most=4)
    assert intervals.intervals(spark.createDataFrame([], "key string, owner string")).count() == 0


@pytest.mark.parametrize("few", [0, 100])
@pytest.mark.parametrize("top", [0, 31, 32, 1500, 40_000])
def test_covering_gives_each_pair_once(spark, top, few):
    rng = random.Random(top)
    ranges = [tuple(sorted((rng.randint(0, top), rng.randint(0, top)))) for _ in range(60)] + [(0, top), (top, top), (0, 0)]
    points = [rng.randint(0, top) for _ in range(80)] + [0, top]
    got = intervals.covering(spark.createDataFrame(list(enumerate(points)), "node int, pre long"), spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(ranges)], "entry int, pre long, post long"), top, few)
    assert sorted((r.entry, r.node) for r in got.collect()) == sorted((i, j) for i, (a, b) in enumerate(ranges) for j, p in enumerate(points) if a <= p <= b)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_totals_and_sizes_equal_a_walk(spark, seed):
    owner, rng = forest(seed), random.Random(seed)
    names = list(owner)
    cross = [(rng.choice(names), rng.choice(names)) for _ in range(60)] + [(names[3], "outside"), (names[40], names[20]), (names[20], names[40])]
    values = {k: (rng.choice(["kg", "m", None]), round(rng.uniform(-50, 50), 2)) for k in names if rng.random() < 0.6}
    kids = children(owner)
    for a, b in cross:
        kids.setdefault(a, []).append(b)
    roots = rng.sample(names, 25)
    want, sizes = {}, {}
    for root in roots:
        seen, todo = set(), [root]
        while todo:
            k = todo.pop()
            if k not in seen:
                seen.add(k)
                todo += kids.get(k, [])
        if len(seen) > 1:
            sizes[root] = len(seen) - 1
        for k in seen & values.keys():
            unit, num = values[k]
            t, n = want.get((root, unit), (0, 0))
            want[root, unit] = (round(t + num, 2), n + 1)
    elements = spark.createDataFrame([(k, o, *values.get(k, (None, None))) for k, o in owner.items()], "key string, owner string, unit string, num double")
    start, edges = spark.createDataFrame([(r,) for r in roots], "root string"), spark.createDataFrame(cross, "src string, dst string")
    got = {(r.root, r.unit): (round(r.total, 2), r.n) for r in rollup.by_unit_below(start, elements, edges).collect()}
    assert got == want
    assert {r.root: r["size"] for r in rollup.sizes_below(start, elements, edges).collect()} == sizes
    ranges = intervals.reach(start, intervals.intervals(elements), edges)
    assert ranges.join(ranges.select("root", F.col("entry").alias("e"), F.col("pre").alias("p"), F.col("post").alias("q")), "root").filter("entry <> e and pre >= 0 and pre <= p and q <= post").count() == 0
