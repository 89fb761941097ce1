import random
import re

import pytest

from grapheon.llm import jaccard


def brute(rows, percent=80):
    sets, parent = [], list(range(len(rows)))
    for _, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    big = 1 << 63
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), big), big if d is None else d)
    return sorted(((d, len(sets[i]), None if least[find(i)] == big else least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def got(spark, rows, **more):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, set_key int")
    return sorted(map(tuple, jaccard.near_duplicates(df, **more).collect()), key=str)


def near_copies(seed, groups, size, words, edits):
    rng = random.Random(seed)
    rows, vocabulary = [], [f"w{i}" for i in range(60)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(words)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_sets", [1024, 8])
def test_matches_brute_force(spark, block_sets):
    rows = near_copies(1, 4, 25, 120, 6) + [(500 + i, t) for i, (_, t) in enumerate(near_copies(2, 10, 3, 40, 2))]
    assert got(spark, rows, block_sets=block_sets) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (5, "A  B\tc"), (6, "a b c d e"), (7, "a b c d e f"), (8, "a b c d e f g h"),
        (9, "a b c d e f g h i"), (10, "one word"), (None, "a b c"), (None, "x y"), (12, "x y"), (12, "x y"), (13, "a b c d e f g h i"), (13, "p q"),
        (14, " ".join(map(str, range(30_000)))), (15, " ".join(map(str, range(29_000)))), (16, "ÄÖ a b c d e"), (17, "äÖ a b c d e"),
    ]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


@pytest.mark.parametrize("percent", [50, 75, 80, 100])
def test_other_thresholds(spark, percent):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f"), (3, "a b c d e"), (4, "a b c d e f g h"), (5, "x a b c d e"), ((1 << 63) - 1, "p q r"), (None, "p q r"), ((1 << 63) - 1, "z z z")]
    rows += [(100 + i, t) for i, (_, t) in enumerate(near_copies(3, 5, 6, 12, 2))]
    assert got(spark, rows, percent=percent) == brute(rows, percent)


def test_hot_classes_and_many_empty_rows(spark):
    rows = [(i, "a b c d e f") for i in range(300)] + [(1000 + i, None) for i in range(300)] + [(5000, "a b c d e f g"), (5001, "q w e r t y")]
    assert got(spark, rows) == brute(rows)


def test_keep_one_with_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, "k l m"), (None, "n o p"), (None, "k l m"), (9, "u v"), (9, "x y"), (8, ""), (8, "")]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(5, "a b c d e f"), (None, "k l m"), (None, "n o p"), (9, "u v"), (9, "x y"), (8, ""), (8, "")], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.keep_one(empty).collect() == []


def test_keep_one_keeps_columns_and_one_of_each_group(spark):
    df = spark.createDataFrame([(2, "a b c d e f", "x", 1), (1, "a b c d e f", "y", 2), (3, "", "z", 3)], "doc_id long, text string, root string, n_shingles int")
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_tree_skips_subtrees_of_the_own_component():
    import numpy as np

    sets = [np.unique(np.array([*range(100), 1000 + i], np.uint64)) for i in range(300)]
    tree = jaccard.PrefixTree(sets, [101] * 300)
    assert len(set(tree.join())) == 1
    assert tree.compared < 3 * 300
