import hashlib
import itertools
import math

import numpy as np

from grapheon.llm import ann, pieces, quality, secrets, topk, toxicity, urls
from grapheon.llm.queries import URL_RULES, tokenizer_path


def test_secrets(spark):
    key = "AKIA" + "Z9" * 8
    text = f'é password = "abc/def1" PASSWD:short1 tokenx {key} ' + "0f" * 12
    df = spark.createDataFrame([(1, text), (2, None), (None, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in secrets.secret_spans(df).collect()}
    a, k, h = text.index("password"), text.index(key), text.index("0f0f")
    want = f"assign:{a}:{text.index('1') + 1},assign:{text.index('PASSWD')}:{text.index('short1') + 6},access:{k}:{k + 20},hex:{h}:{h + 24}"
    assert (rows[1].n_assign, rows[1].n_access, rows[1].n_hex) == (2, 1, 1)
    assert rows[1].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert rows[2].base_sha256 == hashlib.sha256(b"").hexdigest() and rows[None].spans == ""
    assert "abc/def1" not in secrets.redacted(text) and key not in secrets.redacted(text)


def test_entropy_windows_match_direct_counts():
    s = "aaaaaaaaaaq8Zr4Tb1Xw9Lc3Vn7Kd2aaaaaaaaaaaa"
    hit = set()
    for i in range(len(s) - 19):
        w = s[i : i + 20]
        if -sum(w.count(c) / 20 * math.log2(w.count(c) / 20) for c in set(w)) >= 3.5:
            hit.update(range(i, i + 20))
    assert hit == {i for a, b in secrets.windows(s, 20, 3.5) for i in range(a, b)} and hit


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    e, chain, start = rng.normal(size=7), rng.normal(size=(2, 2)), rng.normal(size=2)
    first = np.array([True, False, False, True, False, False, False])
    want = []
    for a, b in ((0, 3), (3, 7)):
        total = np.zeros(b - a)
        z = 0.0
        for y in itertools.product((0, 1), repeat=b - a):
            w = math.exp(start[y[0]] + sum(e[a + i] for i in range(b - a) if y[i]) + sum(chain[y[i], y[i + 1]] for i in range(b - a - 1)))
            z += w
            total += w * np.array(y)
        want += list(total / z)
    assert np.allclose(toxicity.marginals(e, first, chain, start)[0], want)
    long = np.tile(e, 2000)
    assert np.isfinite(toxicity.marginals(long, np.arange(len(long)) == 0, chain, start)[0]).all()


def test_toxicity_learns(spark):
    docs = [(i, ("you idiot scum " if i % 4 == 0 else "") + f"some plain words here {i} and more") for i in range(400)]
    model = toxicity.train([t for _, t in docs], [i % 4 == 0 for i, _ in docs])
    df = spark.createDataFrame([(1, "what an idiot"), (2, "plain words"), (3, None), (4, "")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.score_documents(df, model).collect()}
    assert score[1] >= 0.7 > max(score[2], score[3], score[4])
    assert toxicity.score_documents(df.limit(0), model).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")


def test_top_k_and_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)).round(2).astype(np.float32)
    x[100:200] = x[0]
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(300)]
    odd = [(900, None, 0), (901, [float("nan")] * 8, 0), (902, [None] * 8, 0), (903, [0.0] * 8, 0), (None, rows[0][1], 0), (5, rows[5][1], 0), (950, [1.0, 2.0], 0)]
    df = vectors(spark, rows + odd)
    asked = df.filter("vec_id % 50 = 0")
    q = np.floor(256 * x.astype(float)).astype(np.int64)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, asked, block_rows=64).collect()}
    for i in range(0, 300, 50):
        best = sorted([(-int(q[j] @ q[i]), j) for j in range(300) if j != i] + [(0, 903)])[:5]
        assert [got[i, r + 1] for r in range(5)] == [(j, -s) for s, j in best]
    near = {(r.query_id, r.rank): r.vec_id for r in ann.nearest(df, asked).collect()}
    u = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for i in range(0, 300, 50):
        best = sorted((-round(float(u[j] @ u[i]), 9), j) for j in range(300) if j != i)[:5]
        assert {near[i, r + 1] for r in range(5)} == {j for _, j in best}
    assert topk.top_k(df.limit(0), asked.limit(0)).count() == 0 and ann.nearest(df.limit(0), asked.limit(0)).count() == 0


def test_neighbours_are_exact_where_lists_far_outnumber_probes(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[1000:] = x[1000:] / 50 + np.eye(16)[np.arange(500) % 8]  # some in clusters, one of many near copies
    x[1400:] = x[0] + x[1400:] / 1000
    df = vectors(spark, [(i, [float(v) for v in x[i]], 0) for i in range(1500)])
    got = {(r.query_id, r.rank): r.score for r in ann.nearest(df, df.filter("vec_id % 25 = 0"), list_rows=20, probes=3, block_rows=60).collect()}
    u = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for i in range(0, 1500, 25):
        best = sorted((float(s) for j, s in enumerate(u @ u[i]) if j != i), reverse=True)[:5]
        assert np.allclose([got[i, r + 1] for r in range(5)], best, atol=1e-9)


def test_urls(spark):
    given = [(1, "http://A.com/x"), (2, "https://www.example.com/en/1?q"), (3, "http://example.com/en/2#t"), (4, "http://x.net/es/"), (5, None), (6, "no scheme"), (7, "http://net?x"), (8, "http://o.org/es/9/")]
    df = spark.createDataFrame([(i, u, "h") for i, u in given], "page_id long, url string, host string")
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, URL_RULES).collect()}
    assert rows[1] == ("a.com", "/x", "com/", "allow") and rows[2][2:] == ("www.example.com/en/", "allow")
    assert rows[3] == ("example.com", "/en/2", "example.com/en/", "block") and rows[4][2] == "net/es/"
    assert rows[5][:3] == ("", "", None) and rows[6][:3] == ("", "", None) and rows[7][:3] == ("net", "", None) and rows[8][2] is None
    assert len(rows) == 8 and urls.judge(df.limit(0), URL_RULES).count() == 0


def test_pieces_and_quality(spark):
    texts = [None, "", "  two  spaces \n", "naïve ▁ mark 日本 👍", "x" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    path = tokenizer_path("piece_bpe_32k.model")
    assert all(r.exact for r in pieces.round_trip(df, path).collect())
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(df, path), path).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    assert quality.quality_scores(df).count() == 5 and quality.quality_scores(df.limit(0)).count() == 0
