import math

import numpy as np
import pytest

from grapheon.llm import pieces
from grapheon.llm.queries import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    "a    b", " ", "  ", " " * 40, "   lead", "trail   ", "one two  three   four", "naïve ▁ mark ▁▁ 日本 👍", "x" * 300, "Hello, world! 123 " * 3, "\n\t \n", "a▁b  ▁  c", "ﬁ", "\x00\x01", "supercalifragilisticexpialidocious antidisestablishmentarianism",
    "      def f(x):\n        return  x" + " " * 17 + "end",
]


@pytest.fixture(scope="module")
def vocabulary():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    usable = {sp.id_to_piece(i): (sp.get_score(i), i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
    return usable, byte, min(s for s, _ in usable.values()) - 10.0


def plain(text, vocabulary):
    """Viterbi over the whole text at once, all pieces at each place; marks of the text's own match nothing."""
    usable, byte, rare = vocabulary
    s = " " + text
    longest = max(map(len, usable))
    best, link = [0.0], [None]
    for end in range(1, len(s) + 1):
        score, back = -math.inf, None
        for start in range(max(0, end - longest), end):
            part = s[start:end]
            found = None if "▁" in part else usable.get(part.replace(" ", "▁"))
            if found and best[start] + found[0] > score:
                score, back = best[start] + found[0], (start, [found[1]])
        data = s[end - 1].encode()
        if best[end - 1] + rare * len(data) > score:
            score, back = best[end - 1] + rare * len(data), (end - 1, [byte[x] for x in data])
        best.append(score)
        link.append(back)
    at, out = len(s), []
    while at:
        at, ids = link[at]
        out = ids + out
    return out, best[-1]


def test_ids_equal_a_plain_viterbi(vocabulary):
    found = pieces.Pieces(MODEL)
    for text, (_, ids) in zip(TEXTS, found.encode(TEXTS), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text, vocabulary)[0], text
        assert found.decode(ids) == text


def test_documents_equal_a_plain_viterbi(spark, vocabulary):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(30).collect()
    got = pieces.Pieces(MODEL).encode([r.text or "" for r in rows])
    for r, (_, ids) in zip(rows, got, strict=True):
        if r.text and len(r.text) < 4000:
            assert np.frombuffer(ids, "<u4").tolist() == plain(r.text, vocabulary)[0]


def test_a_run_of_spaces_is_a_piece(vocabulary):
    usable, _, _ = vocabulary
    runs = [p for p in usable if set(p) == {"▁"}]
    assert max(map(len, runs)) == 16
    _, ids = pieces.Pieces(MODEL).encode(["a" + " " * 17 + "b"])[0]
    assert {usable[p][1] for p in runs if len(p) > 1} & set(np.frombuffer(ids, "<u4").tolist())


def test_shared_prefixes_change_nothing():
    words = [f" pre{a}{b}" for a in ("", "fix", "fixed", "sent") for b in ("", "s", "ed ", "日")]
    together = pieces.Pieces(MODEL)
    together.learn(words)
    for w in words:
        alone = pieces.Pieces(MODEL)
        alone.learn([w])
        assert alone.held[w] == together.held[w]


def test_odd_rows(spark):
    rows = [(1, None, "c"), (2, "", "c"), (None, "no id", "c"), (3, "twice", "c"), (3, "twice", "c"), (4, " ", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, r.n_ids, r.exact) for r in pieces.round_trip(df, MODEL).collect()), key=str)
    assert len(got) == 6 and all(g[2] for g in got) and [g[1] for g in got if g[0] in (1, 2)] == [0, 0]
    twice = [r for r in pieces.encode(df, MODEL).collect() if r.doc_id == 3]
    assert twice[0] == twice[1]
    assert pieces.round_trip(df.limit(0), MODEL).count() == 0 and pieces.encode(df.limit(0), MODEL).count() == 0 and pieces.decode(pieces.encode(df.limit(0), MODEL), MODEL).count() == 0
