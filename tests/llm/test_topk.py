import random

from grapheon.llm import topk


def brute(rows, k=5):
    whole = {}
    for i, x in rows:
        if i is None or not x or any(v is None or v != v or abs(v) == float("inf") for v in x):
            continue
        whole.setdefault(i, set()).add(tuple(int(v) * 256 if abs(v) >= 2**52 else int((v * 256) // 1) for v in x))
    out = []
    for q, xs in whole.items():
        if q % 50:
            continue
        for x in xs:
            best = {}
            for i, ys in whole.items():
                for y in ys:
                    if i != q and len(y) == len(x):
                        s = sum(a * b for a, b in zip(x, y, strict=True))
                        best[i] = max(s, best.get(i, s))
            for r, (s, i) in enumerate(sorted((-s, i) for i, s in best.items())[:k], 1):
                out.append((q, r, i, min(max(-s, -(2**63)), 2**63 - 1), str(-s)))
    return sorted(out)


def check(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = topk.top_k(df, df.filter("vec_id % 50 = 0"), k=5, scale=256, **more)
    assert got.columns == ["query_id", "rank", "vec_id", "score", "exact_score"]
    assert sorted(map(tuple, got.collect())) == brute([r[:2] for r in rows])


def test_components_of_any_size(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1, -1]) * rng.random() * rng.choice([1, 1, 1, 8e6, 1e10, 1e300]) for _ in range(8)], "x") for i in range(140)]
    rows += [(300, [8e6] * 8, "x"), (301, [8e6] * 8, "x"), (302, [-8e6] * 8, "x"), (350, [1.7e308, -1.7e308], "x"), (351, [1.7e308, 0.0], "x"), (352, [5e-324, -5e-324], "x")]
    check(spark, rows, block_rows=40, block_queries=2)


def test_odd_vectors_ties_and_an_empty_table(spark):
    x = [0.5, -0.25, 0.125]
    rows = [(i, x, "x") for i in range(60)] + [(0, x, "x"), (None, x, "x"), (61, None, "x"), (62, [], "x"), (63, [0.1, None, 0.2], "x"), (64, [float("nan")] * 3, "x"), (65, [float("inf")] * 3, "x"), (66, [0.5], "x"), (100, [0.5], "x")]
    check(spark, rows)
    check(spark, [])
