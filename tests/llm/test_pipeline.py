"""The pipeline's stages one by one against plain versions, on a small table."""

import random

import corpus_pipeline
import pytest

from grapheon.llm import secrets
from tests.llm.test_jaccard import brute as near
from tests.llm.test_substrings import words

pytest.importorskip("public_tokenizers")


def gone_bytes(rows, length=100):
    first = {}
    for d, t in sorted(rows):
        t = t.encode()
        for i in range(len(t) - length + 1):
            first.setdefault(t[i : i + length], (d, i))
    out = {}
    for d, t in rows:
        t, gone = t.encode(), set()
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < (d, i):
                gone.update(range(i, i + length))
        out[d] = bytes(b for i, b in enumerate(t) if i not in gone)
    return out


def test_stages(spark, tmp_path):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(180))
    rows = [(i, " ".join(f"{rng.choice('bcdfghklmn')}{rng.randint(0, 4000)}" for _ in range(60))) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(10)] + [(300 + i, rows[20 + i][1] + " tail") for i in range(5)]
    rows += [(400 + i, words(rng, 30) + f" u{i} " + passage) for i in range(8)]
    rows += [(500 + i, f"you idiot number {i} " + " ".join(f"z{rng.randint(0, 4000)}" for _ in range(20))) for i in range(30)]
    rows += [(600, 'password = "abcdef123456"'), (601, None), (602, "")]
    full = [(d, t, "en", f"s{d % 3}", len(t or "")) for d, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, 1, int(500 <= d < 530)) for d, _ in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "secrets", "packing"]
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
        seen[name] = docs
        assert name == "packing" or docs.columns == columns
    texts = {n: {r.doc_id: r.text for r in seen[n].collect()} for n in ("toxicity", "near_duplicates", "repeated_passages", "secrets")}
    assert set(texts["toxicity"]) == {d for d, _ in rows if not 500 <= d < 530}
    kept = {c for _, _, c in near(list(texts["toxicity"].items()))}
    assert set(texts["near_duplicates"]) == kept and not kept & set(range(200, 210)) and not kept & set(range(300, 305))
    before = [(d, t or "") for d, t in texts["near_duplicates"].items()]
    assert {d: t.encode() for d, t in texts["repeated_passages"].items() if t.isascii()} == {d: b for d, b in gone_bytes(before).items() if texts["repeated_passages"][d].isascii()}
    assert texts["secrets"] == {d: secrets.redacted(t) for d, t in texts["repeated_passages"].items()} and texts["secrets"][600] == 'password = "[SECRET]"'
    assert all(r.n_chars == len(r.text) for r in seen["secrets"].collect())
    packed = seen["packing"].groupBy("sequence_id").sum("length").collect()
    assert all(r["sum(length)"] <= 2048 for r in packed) and {r.doc_id for r in seen["packing"].collect()} == kept
