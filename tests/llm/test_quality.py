import math

import numpy as np

from grapheon.llm import quality


def plain_em(votes, rounds=100):
    """EM document by document, all products written out."""
    post = [min(max((v.count(1) + 1.0) / (len(v) - v.count(2) + 1.5), 0.02), 0.98) for v in votes]
    for _ in range(rounds):
        share = min(max(sum(post) / len(post), 0.01), 0.99)
        new = []
        tables = []
        for k in range(7):
            good = [1.0 + sum(p for v, p in zip(votes, post) if v[k] == x) for x in range(3)]
            bad = [1.0 + sum(1 - p for v, p in zip(votes, post) if v[k] == x) for x in range(3)]
            tables.append(([g / sum(good) for g in good], [b / sum(bad) for b in bad]))
        for v in votes:
            good, bad = share, 1 - share
            for k in range(7):
                good, bad = good * tables[k][0][v[k]], bad * tables[k][1][v[k]]
            new.append(good / (good + bad))
        moved = max(abs(a - b) for a, b in zip(new, post))
        if moved < 1e-6:
            break
        post = new
    return post


def drawn(seed, n=3000, share=0.7):
    """Votes of labellers of known accuracies."""
    rng = np.random.default_rng(seed)
    right = [(0.95, 0.9), (0.9, 0.85), (0.85, 0.7), (0.8, 0.9), (0.75, 0.8), (0.9, 0.6), (0.7, 0.75)]
    often = [1.0, 0.9, 0.8, 0.9, 0.7, 0.6, 0.95]
    truth = rng.random(n) < share
    votes = []
    for t in truth:
        v = []
        for (g, b), o in zip(right, often):
            correct = rng.random() < (g if t else b)
            v.append(2 if rng.random() > o else int(t) if correct else 1 - int(t))
        votes.append(v)
    return truth, votes, right, often


def code(v):
    out = 0
    for x in v:
        out = 3 * out + x
    return out


def test_em_by_patterns_equals_em_by_documents():
    _, votes, _, _ = drawn(1, 400)
    counts = {}
    for v in votes:
        counts[code(v)] = counts.get(code(v), 0) + 1
    post = quality.label_model(counts)
    assert np.allclose([post[code(v)] for v in votes], plain_em(votes), atol=1e-9)


def test_accuracies_are_those_that_the_votes_were_drawn_with():
    truth, votes, right, often = drawn(2, 8000)
    counts = {}
    for v in votes:
        counts[code(v)] = counts.get(code(v), 0) + 1
    post = quality.label_model(counts)
    for found, (good, bad), o in zip(quality.accuracies(counts, post), right, often):
        assert abs(found["on_good"] - good) < 0.04 and abs(found["on_bad"] - bad) < 0.06 and abs(found["votes"] - o) < 0.03
    assert np.mean([(post[code(v)] > 0.5) == t for v, t in zip(votes, truth)]) > 0.93
    flipped = {code([1 - x if x < 2 else 2 for x in v]): 0 for v in votes}
    for v in votes:
        flipped[code([1 - x if x < 2 else 2 for x in v])] += 1
    assert sum(n * quality.label_model(flipped)[c] for c, n in flipped.items()) / len(votes) < 0.5  # good is what most vote good on
    assert quality.label_model({}) == {}


ROWS = [(1, "a fine sentence of plain words follows another one. " * 4, "x", 1.0), (2, "BUY NOW BUY NOW $$$ ### !!! BUY", "x", 1.0), (3, None, "x", 1.0), (4, "", "x", 1.0), (None, "no id here at all", "x", 1.0), (5, "twice", "x", 1.0), (5, "twice", "x", 1.0), (6, "word " * 60_000, "x", 1.0), (7, " \n\t", "x", 1.0), (8, "é日 \U0001f44d", "x", 1.0)]


def test_scores_equal_a_plain_scorer(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, keep string, score double")
    model = quality.fit(df)
    got = sorted(((str(r.doc_id), round(r.weak_label, 9), round(r.score, 9), r.keep) for r in quality.score(df, model).collect()))
    want = []
    for i, t, _, _ in ROWS:
        words = (t or "").split()
        z = model.bias + sum(model.weights[f] for f in quality.vote_features(quality.pattern(t or "")))
        z += sum(model.weights[f] for w in words for f in quality.features(w)) / max(len(words), 1)
        p = 1 / (1 + math.exp(-z)) if words else 0.0
        want.append((str(i), round(model.posteriors.get(quality.pattern(t or ""), 0.5), 9), round(p, 9), p >= 0.5))
    assert got == sorted(want)
    assert [r.labeller for r in model.table(spark).collect()] == list(quality.LABELLERS) and 0 <= model.share <= 1
    assert not any(r.keep for r in quality.score(df, model).collect() if r.doc_id in (3, 4, 7))


def test_empty_tables_and_tables_without_words(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, keep string, score double")
    assert quality.quality_scores(df.limit(0)).count() == 0
    assert [r.keep for r in quality.quality_scores(df.filter("doc_id in (3, 4, 7)")).collect()] == [False] * 3


def test_training_follows_soft_labels():
    texts = [f"good calm words number {i}" for i in range(60)] + [f"$$$ WIN {i} WIN" for i in range(60)]
    weights, bias = quality.train(texts, np.array([0.9] * 60 + [0.1] * 60))
    def p(t):
        words = t.split()
        return 1 / (1 + math.exp(-(bias + sum(weights[f] for f in quality.vote_features(quality.pattern(t))) + sum(weights[f] for w in words for f in quality.features(w)) / len(words))))
    assert abs(np.mean([p(t) for t in texts[:60]]) - 0.9) < 0.08 and abs(np.mean([p(t) for t in texts[60:]]) - 0.1) < 0.08
