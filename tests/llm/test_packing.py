import random
import zlib

import numpy as np
import pytest

from grapheon.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def direct(text):
    from tokenizers import Tokenizer

    if not hasattr(direct, "tokenizer"):
        direct.tokenizer = Tokenizer.from_file(PATH)
    return [*direct.tokenizer.encode(text, add_special_tokens=False).ids, 0]


TEXTS = [
    None, "", "   ", "Hello, WORLD! don't 'S ''s x's. 12½ ²3", "a\x1cb c\x85d\xa0e　f", "İstanbul ΣΑΣ ς Straße ǅ",
    "é ́x <|startoftext|>a <|endoftext|> <|x", "日本語 текст 👍🏽", "x" * 5000, "\0 ​", "long " * 6000,
]


def test_pieces_hold_the_tokenizers_ids_and_fill_sequences(spark):
    docs = spark.createDataFrame([(i % 9, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, row int")
    rows = packing.pack(docs, PATH).collect()
    want = []
    for i, t in enumerate(TEXTS):
        ids = direct(t or "")
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            want.append((i % 9, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_search_never_loses_pieces_and_saves_bins():
    rng = random.Random(3)
    for _ in range(30):
        lengths = [rng.randint(1, 2048) for _ in range(rng.randint(0, 120))]
        bins = packing.pack_lengths(lengths, 2048)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 2048 for b in bins)
        assert len(bins) <= len(packing.best_fit(lengths, 2048))


def test_swap_finds_what_best_fit_misses():
    lengths = [6, 5, 5, 4, 4, 3, 3]  # best fit decreasing: 6+4, 5+5, 4+3+3
    assert len(packing.pack_lengths(lengths, 10)) == 3
    assert len(packing.improve([[0], [1, 3], [2, 4], [5, 6]], lengths, 10)) == 3


def test_search_ends_only_when_no_underfull_bin_can_give():
    rng = random.Random(8)
    for least, most, n in ((350, 1100, 800), (300, 700, 700), (20, 900, 300)):
        lengths = [rng.randint(least, most) for _ in range(n)]
        bins = packing.pack_lengths(lengths, 2048)
        assert sorted(i for b in bins for i in b) == list(range(n)) and all(sum(lengths[i] for i in b) <= 2048 for b in bins)
        if len(bins) == -(-sum(lengths) // 2048):
            continue
        held = sorted(([lengths[i] for i in b] for b in bins), key=sum)
        held = [(sum(b), set(b), {0, *b, *(x + y for i, x in enumerate(b) for y in b[:i])}) for b in held if sum(b) < 2048]
        for g, (fill, sizes, _) in enumerate(held):
            for room, backs in ((2048 - f, backs) for k, (f, _, backs) in enumerate(held) if k != g and f >= fill):
                assert not any(s < x <= s + room for x in sizes for s in backs)


def test_a_table_of_unknown_size_reaches_the_bound(spark):
    docs = spark.createDataFrame([(i, "one two three four five six seven eight nine") for i in range(200)], "doc_id long, text string")
    got = packing.pack(docs, PATH)
    assert got.select("sequence_id").distinct().count() == -(-got.agg({"length": "sum"}).head()[0] // 2048)


def test_other_tokenizers_encode_whole_texts():
    from tokenizers import Tokenizer

    texts = ["One  two, three.\nFour's 12½ İstanbul", "", " x", "<|endoftext|> a<|b"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = str(public_tokenizers.path(name))
        ids = packing.Ids(path)
        assert ids.by_words == (name == "word_bpe_49k.json")
        assert [np.frombuffer(x, "<u4").tolist() for x in ids(texts)] == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
