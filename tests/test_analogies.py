import math
import random

from grapheon import queries


def cosine(x, y):
    def dot(a, b):
        return sum(p * q for p, q in zip(a, b, strict=True))

    return dot(x, y) / (math.sqrt(dot(x, x)) * math.sqrt(dot(y, y)))


def plain(rows, floor=0.3, window=50, per_src=3, per_dst=2):
    """One pass over all pairs. Of two models of the same size, 0 counts as the largest."""
    pairs = []
    for s, x, role in rows:
        if s % 2:
            near = sorted((-cosine(x, y), d) for d, y, other in rows if d % 2 == 0 and other == role)
            pairs += [(c, s, d) for c, d in near if -c >= floor][:window]
    out, n_src, n_dst = [], {}, {}
    for c, s, d in sorted(pairs):
        if n_src.get(s, 0) < per_src and n_dst.get(d, 0) < per_dst:
            n_src[s], n_dst[d] = n_src.get(s, 0) + 1, n_dst.get(d, 0) + 1
            out.append((s, d, round(-c, 6)))
    return sorted(out)


def test_matching_equals_a_plain_loop(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, [rng.randint(-8, 8) + 4.0 for _ in range(6)], i % 3) for i in range(360)]
    for i in (0, 2, 4, 6, 8, 10):
        rows[i] = (i, [4.0 + i / 64] * 6, i % 3)  # hubs: near the mean of all
    for i in range(301, 360, 2):
        rows[i] = (i, rows[301][1], i % 3)  # equal sources
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted((r.src, r.dst, r.score) for r in queries.QUERIES["analogy_matching"](spark, str(tmp_path)).collect())
    want = plain(rows)
    assert [g[:2] for g in got] == [w[:2] for w in want] and len(want) > 100
    assert all(abs(g[2] - w[2]) < 2e-6 for g, w in zip(got, want, strict=True))
