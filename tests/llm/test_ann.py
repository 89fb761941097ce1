import math

import numpy as np
import pytest

from grapheon.llm import ann


def brute(rows, k=5):
    whole = {}
    for i, x in rows:
        if i is not None and x and all(v is not None and math.isfinite(v) for v in x) and any(x):
            whole.setdefault(i, set()).add(tuple(x))
    out = {}
    for q in whole:
        for x in whole[q] if q % 50 == 0 else ():
            best = {}
            for i, ys in whole.items():
                for y in ys:
                    if i != q and len(x) == len(y):
                        s = float(ann.exact_cosines(np.array(x), np.array([y]))[0])
                        best[i] = max(s, best.get(i, -2))
            out[q] = sorted((-s, i) for i, s in best.items())[:k]
    return {q: [(i, -s) for s, i in found] for q, found in out.items()}


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest(df, df.filter("vec_id % 50 = 0"), **more).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return found


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_where_lists_outnumber_probes(spark, clustered):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 16))
    if clustered:
        x = rng.normal(size=(40, 16))[rng.integers(0, 40, 4000)] * 4 + x
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found, want = got(spark, rows, list_rows=32, probes=6), brute(rows)
    hits = [len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(hits) / (5 * len(want)) >= 0.99
    assert all(dict(found[q])[i] == s for q in want for i, s in want[q] if i in dict(found[q]))


def test_lengths_ties_and_odd_vectors(spark):
    x = [0.5, -0.25, 0.125]
    rows = [(i, x) for i in range(40)] + [(50, [2 * v for v in x]), (0, x), (100, [1.0, 2.0]), (101, [2.0, 4.0]), (102, [-1.0, 0.0]), (150, [1.0, 2.0, 3.0, 4.0])]
    rows += [(None, x), (200, None), (250, []), (300, [0.0, 0.0, 0.0]), (61, [1.0, None, 2.0]), (62, [float("nan")] * 3), (63, [float("inf")] * 3), (350, [1e300, -1e300, 1e-300]), (64, [1e-300, 1e-310, 0.0])]
    assert got(spark, rows) == {q: v for q, v in brute(rows).items() if v}
    assert got(spark, []) == {}


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(6)
    c = rng.normal(size=(500, 12)).astype(np.float32)
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    x = rng.normal(size=(50, 12)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, cos = ann.CentroidGraph(c).search(x, 8)
    want = np.argsort(-(x @ c.T), axis=1)[:, :8]
    assert np.mean([len(set(a) & set(b)) / 8 for a, b in zip(ids.tolist(), want.tolist(), strict=True)]) > 0.95
    assert (np.diff(cos, axis=1) <= 0).all()
