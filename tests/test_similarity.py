import math

import numpy as np
import pytest

from grapheon.operators import search, similarity
from grapheon.operators.retrieve import similar_within

SCHEMA = "key long, model int, role string, embedding array<double>"


def clustered(rng, n, dims=16, clusters=40, spread=0.05):
    centres = rng.normal(size=(clusters, dims))
    return centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dims))


def frame(spark, x, model, role, more=()):
    return spark.createDataFrame([(i, int(model[i]), str(role[i]), [float(v) for v in x[i]]) for i in range(len(x))] + list(more), SCHEMA).repartition(5)


def best(score, allowed, k, floor=-2.0):
    """src, dst, score of the k best allowed partners of each row."""
    out = set()
    for i in range(len(score)):
        at = np.flatnonzero(allowed[i] & (score[i] >= floor))
        for j in at[np.lexsort((at, -score[i][at]))][:k]:
            out.add((i, int(j), round(float(score[i, j]), 6)))
    return out


def cosines(x):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.round(u @ u.T, 12)  # equal vectors tie


@pytest.mark.parametrize("floor", [0.9, 0.3])
def test_analogies_equal_all_pairs(spark, floor):
    rng = np.random.default_rng(1)
    x = clustered(rng, 1500)
    x[700:760] = x[3]
    model, role = rng.integers(0, 3, 1500), np.where(np.arange(1500) < 800, "hot", "r" + (np.arange(1500) % 3).astype("U1"))
    odd = [(5000, 0, "hot", None), (5001, 1, "hot", [0.0] * 16), (5002, 1, "hot", [math.nan] * 16), (5003, 2, "hot", [1.0, 2.0]), (5004, 1, None, [1.0] * 16), (5005, 1, "lone", [1.0] * 16)]
    got = {(r.src, r.dst, round(r.score, 6)) for r in search.analogies(frame(spark, x, model, role, odd), floor, 7).collect()}
    sizes = np.bincount(np.concatenate([model, [0, 1, 1, 2, 1, 1]]))
    allowed = (role[:, None] == role) & (model[:, None] != model) & (model != sizes.argmax())[:, None]
    want = best(cosines(x), allowed, 7, floor)
    assert got == want and len(want) > 1000


def test_few_pairs_are_scored_and_a_large_role_is_split(spark):
    rng = np.random.default_rng(2)
    n = 18_000
    x = clustered(rng, n, clusters=60)
    model, role = np.arange(n) % 2, np.where(rng.random(n) < 0.5, "half", "r" + (np.arange(n) % 7).astype("U1"))
    counter = spark.sparkContext.accumulator(0)
    rows = frame(spark, x, model, role)
    found = search.analogies(rows, 0.95, 3, counter).collect()
    possible = sum(int(((role == r) & (model == 1)).sum()) * int((role == r).sum()) for r in np.unique(role))
    assert 0 < counter.value < possible / 10
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    by_src = {}
    for r in found:
        by_src.setdefault(r.src, []).append(r.score)
    for i in range(1, n, 602):
        s = (u @ u[i])[(role == role[i]) & (model == 0)]
        assert np.allclose(sorted(by_src.get(i, []), reverse=True), sorted(s[s >= 0.95], reverse=True)[:3])
    deal = similarity._pivots(similarity._prepared(rows.selectExpr("key", "model as avoid", "3 as side", "role", "embedding"), "role"))
    assert {r.g: r.parts for r in deal.collect()}["16:half"] > 1


@pytest.mark.parametrize("even", [False, True])
def test_nearest_of_a_module_equal_all_pairs(spark, even):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1300, 12)) if even else clustered(rng, 1300, dims=12)
    x[100:140] = x[5]
    role = np.where(np.arange(1300) < 1290, "m" + (np.arange(1300) % 2).astype("U1"), "few")
    rows = frame(spark, x, np.zeros(1300), role, [(9000, 0, "alone", [1.0] * 12)]).withColumnRenamed("role", "module")
    counter = spark.sparkContext.accumulator(0)
    got = {(r.src, r.dst, round(r.score, 6)) for r in similar_within(rows, 3, counter).collect()}
    allowed = (role[:, None] == role) & ~np.eye(1300, dtype=bool)
    assert got == best(cosines(x), allowed, 3)
    assert similar_within(rows.limit(0)).count() == 0
