import hashlib
import random

import numpy as np
import pytest

from grapheon.llm import substrings
from grapheon.llm.fingerprints import batch_rows, bucket_bits
from grapheon.llm.suffixes import permuted_prefixes, suffix_array


def brute(rows, length):
    """By (doc_id, start) of the first occurrence of each string."""
    big = 1 << 63
    data = [((big if d is None else d), (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in data:
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            first[s] = min(first.get(s, (big + 1, 0)), (d, i))
    out = []
    for (d, t), (raw, _) in zip(data, rows, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < (d, i):
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (gone[0] and len(t) > 0))
        out.append((raw, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, length=100):
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, bucket int")
    return sorted(map(tuple, substrings.remove_repeats(df, length).collect()), key=str)


def words(rng, n):
    return " ".join(rng.choice(["über", "the", "a", "naïve", "of", "x1", "lorem", "日本"]) for _ in range(n))


def test_matches_brute_force(spark):
    rng = random.Random(5)
    passages = [words(rng, 40) for _ in range(4)]
    rows = []
    for d in range(120):
        text = words(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 30)
            text += p[a : a + rng.randint(60, 200)] + words(rng, rng.randint(0, 10))
        rows.append((d, text))
    rows += [(200 + i, rows[i % 7][1]) for i in range(40)]
    assert got(spark, rows) == brute(rows, 100)


def test_odd_rows(spark):
    rng = random.Random(6)
    text = words(rng, 80)
    rows = [(1, None), (2, ""), (3, "a" * 99), (4, "a" * 100), (5, "a" * 1000), (6, "ab" * 300), (7, text), (7, text), (7, text[3:]), (None, text), (None, "z" * 150), ((1 << 63) - 1, text + "!"), ((1 << 63) - 1, "z" * 150), (8, text + "\0" + text), (9, "\0" * 250), (10, words(rng, 30_000))]
    assert got(spark, rows) == brute(rows, 100)
    assert got(spark, []) == []


@pytest.mark.parametrize("bits", [4, 10, 20])
def test_rows_of_a_batch(bits):
    found = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 5000, np.int64).astype(np.uint64) << np.uint64(1))
    rows = batch_rows(7, (b"", b"", b"", b""), found, None, bits)
    assert rows.num_rows - 1 <= min(5000, 1 << bits)
    low = np.frombuffer(b"".join(rows.column(3).to_pylist()[1:]), "<u4")
    bucket = np.repeat(rows.column(2).to_numpy()[1:], [len(x) // 4 for x in rows.column(3).to_pylist()[1:]])
    assert np.array_equal(bucket.astype(np.uint64) << np.uint64(32) | low, found >> np.uint64(32 - bits))
    assert [bucket_bits(int(g * 1e9), 16 << 20) for g in (0.1, 0.5, 30, 1e5)] == [4, 5, 11, 23]


def test_lengths_that_anchors_dont_fit_are_refused(spark):
    for length in (31, 1 << 15):
        with pytest.raises(ValueError):
            substrings.remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), length)


def test_stripped_texts_keep_columns_and_whole_characters(spark):
    rng = random.Random(7)
    text = "".join(rng.choice("äöüßé") for _ in range(300))
    df = spark.createDataFrame([(1, text, "l1", 300), (2, "x" + text + "end", "l2", 304), (3, None, None, None)], "doc_id long, text string, kind string, n_chars long")
    out = {r.doc_id: r for r in substrings.strip_repeats(df).collect()}
    assert substrings.strip_repeats(df).columns == df.columns
    assert out[1].text == text and out[2].text == "xend" and out[2].kind == "l2" and out[3].text == ""


@pytest.mark.parametrize("few", [2, 512])
def test_suffix_arrays(few):
    rng = random.Random(8)
    for _ in range(300):
        s = [rng.randrange(rng.choice([1, 2, 3, 30])) + 1 for _ in range(rng.randint(0, 60))] + [0]
        want = sorted(range(len(s)), key=lambda i: s[i:])
        assert suffix_array(np.array(s), few).tolist() == want
        shared = permuted_prefixes(np.array(s), np.array(want), 10)
        for i, j in zip(want[1:], want[:-1], strict=True):
            k = 0
            while k < 10 and i + k < len(s) and j + k < len(s) and s[i + k] == s[j + k]:
                k += 1
            assert shared[i] == k


def shared_symbols(s, a, b):
    n = 0
    while a + n < len(s) and b + n < len(s) and s[a + n] == s[b + n]:
        n += 1
    return n


@pytest.mark.parametrize(("symbols", "period"), [(3, 0), (3, 37), (200, 0), (200, 150), (1, 0)])
def test_many_names_and_prefixes_by_the_recurrence(symbols, period):
    """Few names at a time, so that each level has many; long repeats, so that prefixes reach the bound."""
    rng = np.random.default_rng(symbols + period)
    s = rng.integers(1, symbols + 1, 900)
    if period:
        s = np.tile(s[:period], 900 // period + 1)
        s[rng.integers(0, len(s), 3)] = 1
    s = np.append(s, 0)
    want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
    for few in (1, 4, 512):
        assert suffix_array(s, few).tolist() == want
    for most in (5, 64, 250):
        got = permuted_prefixes(s.astype(np.uint8), np.array(want), most)
        expected = np.zeros(len(s), int)
        for a, b in zip(want[1:], want[:-1]):
            expected[a] = min(shared_symbols(s, a, b), most)
        assert got.tolist() == expected.tolist()
