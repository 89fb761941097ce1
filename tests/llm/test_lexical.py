import math
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from grapheon.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    found = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    df = Counter(w for _, c in found for w in c)
    out = []
    for item, text in items:
        ranked = []
        for i, c in found:
            n = sum(c.values())
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * (75 + 25 * n * n_docs // total))) for w in terms(text) if w in c)
            if score > 0:
                ranked.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(ranked)[:k])]
    return sorted(out, key=str)


def cases():
    rng = np.random.default_rng(3)
    words = ["alpha", "Beta", "gamma", "delta9", "Ünï", "ünï", "日本", "ß", "x_y", "a'b"]
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(1, 30)))) for i in rng.permutation(300)]
    docs += [(1000 + i, "alpha beta") for i in range(40)]  # ties beyond k
    docs += [(None, "alpha beta"), (None, "alpha gamma"), (5, docs[0][1]), (5, docs[0][1]), (2000, None), (2001, ""), (2002, " .,;\x00 "), (2003, "alpha " * 20_000 + "rare"), (2004, "z" * 9000 + " alpha")]
    items = [(0, "Alpha beta beta rare"), (1, "日本 ünï ÜNÏ nothing"), (2, None), (3, ""), (4, "absent"), (5, "alpha"), (5, "alpha"), (None, "x y A B"), (6, "z" * 9000)]
    return docs, items


@pytest.mark.parametrize(("piece", "shard", "wave"), [(lexical.PIECE_BYTES, lexical.SHARD_BYTES, lexical.WAVE_TERMS), (1000, 3000, 4)])
def test_ranks_equal_a_plain_search(spark, piece, shard, wave, tmp_path):
    docs, items = cases()
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string")
    lexical.write_index(d, str(tmp_path / "index"), shard_bytes=shard)
    index = spark.read.schema(lexical.INDEX).parquet(str(tmp_path / "index"))
    got = sorted((tuple(r) for r in lexical.search(index, q, 20, wave_terms=wave).collect()), key=str)
    want = plain(docs, items, 20)
    assert got == want and len(want) > 80


def test_pieces_cut_no_term():
    text = ("Word, other;word " * 50 + "y" * 700 + " end").encode()
    for most in (1, 7, 64, 500, 10_000):
        assert [w for p in lexical.pieces(text, most) for w in p] == [w.encode() for w in terms(text.decode())]


def test_a_document_in_lists_that_were_added_apart():
    texts = ["a b a c", "b b", ""]
    whole = lexical.shard([1, 2, 3], iter(t.encode() for t in texts), 2, 6)
    assert list(whole["places"]) == [0, 0, 1, 0] and whole["words"].to_pylist() == ["a", "b", "c"] and whole["documents"] == 2 and whole["terms"] == 6
    assert list(whole["offsets"]) == [0, 1, 3, 4]


def test_ties_at_the_cut():
    score = np.array([5, 0, 7, 5, 5, 9, 5], np.int64)
    ids = np.array([40, 1, 3, 10, 30, 7, 20], np.int64)
    assert list(ids[lexical.best_places(score, ids, 4)]) == [7, 3, 10, 20]
    assert list(lexical.best_places(np.zeros(3, np.int64), ids[:3], 4)) == []


def test_rank_documents_leaves_no_index_and_takes_empty_tables(spark):
    docs, items = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in lexical.rank_documents(d, q, 3).collect()), key=str) == plain(docs, items, 3)
    for a, b in ((d.limit(0), q), (d, q.limit(0)), (d.limit(0), q.limit(0)), (d.filter("doc_id = 2000"), q)):
        assert lexical.rank_documents(a, b, 3).count() == 0


def test_a_row_group_holds_few_shards(spark, tmp_path):
    """A writer that counts bytes every 100 rows, and a reader that takes a whole row group, held all shards of a task."""
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(12_000))) for i in range(150)]
    lexical.write_index(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), str(tmp_path / "index"), shard_bytes=1)
    groups = [pq.ParquetFile(p).metadata.row_group(g) for p in (tmp_path / "index").glob("*.parquet") for g in range(pq.ParquetFile(p).metadata.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 150
    assert max(g.num_rows for g in groups) < 100, [(g.num_rows, g.total_byte_size) for g in groups]
