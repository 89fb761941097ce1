import os
import zlib

import numpy as np
import pytest

from grapheon.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def by_enumeration(e, chain, start):
    """P(toxic) of each word, over all taggings."""
    n, total, out = len(e), 0.0, np.zeros(len(e))
    for code in range(1 << n):
        y = [code >> i & 1 for i in range(n)]
        weight = np.exp(start[y[0]] + sum(e[i] * y[i] for i in range(n)) + sum(chain[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += weight
        out += weight * np.array(y)
    return out / total


def test_marginals_are_those_of_all_taggings():
    rng = np.random.default_rng(2)
    sizes = [1, 7, 9, 3]
    e, chain, start = rng.normal(size=sum(sizes)) * 3, rng.normal(size=(2, 2)), rng.normal(size=2)
    ends = np.cumsum([0, *sizes])
    first = np.zeros(len(e), bool)
    first[ends[:-1]] = True
    p, _ = toxicity.marginals(e, first, chain, start)
    for a, b in zip(ends, ends[1:], strict=False):
        want = by_enumeration(e[a:b], chain, start)
        assert np.allclose(p[a:b], want)
        for width in (1, 2, 4, 100):
            assert np.allclose(toxicity.long_marginals(e[a:b], chain, start, width), want)


def model():
    bad = [f"you are an idiot {i}" for i in range(40)] + ["what a stupid loser thing"] * 20
    good = [f"you are a friend of the house {i} what an old thing" for i in range(60)]
    return toxicity.train(bad + good, [True] * 60 + [False] * 60)


def test_offsets_stand_where_letters_grow_and_in_long_texts():
    m = model()
    texts = ["İ what an idiot", "idiot İİ idiot", None, "", "fine house", "friend of the house " * 100_000 + "idiot", "!?"]
    score, found = toxicity.scored(texts, m, toxicity.Emissions(m), True)
    assert [[t[a:b] for a, b in where] for t, (_, where) in zip(texts, found, strict=True) if t] == [["idiot"], ["idiot", "idiot"], [], ["idiot"], []]
    assert [n for n, _ in found] == [1, 2, 0, 0, 0, 1, 0]
    assert score[2] == score[3] and score[0] > 0.7 > score[4]


def test_repeated_rows_clashing_columns_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, "idiot", 5.0), (1, "idiot", 5.0), (None, None, None)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    empty = toxicity.fit(docs, labels)
    rows = toxicity.score_documents(docs, empty).collect()
    assert sorted((r.doc_id or 0, round(r.score, 6), r.n_toxic, r.spans) for r in rows) == [(0, 0.0, 0, ""), (1, 0.0, 0, ""), (1, 0.0, 0, "")]
    kept = toxicity.drop_toxic(docs, model())
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [None]
    assert toxicity.score_documents(docs.limit(0), empty).count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")
def test_held_out_recall(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    rows = [r for r in queries.op2_toxicity(spark, SF).collect() if r.doc_id in labels]
    assert all(r.held_out for r in rows)
    caught = np.mean([r.predicted for r in rows if labels[r.doc_id] == 1])
    alarms = np.mean([r.predicted for r in rows if labels[r.doc_id] == 0])
    assert caught >= 0.9 and alarms <= 0.02, (caught, alarms)
