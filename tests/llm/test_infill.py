import hashlib

from pyspark.sql import functions as F

from grapheon.llm import infill

ODD = ["", None, "a", "é日👍", "with \x1e and \x1f and \x1ed\x1ee\x1f\x1f in it", "holds <P> itself", "ends in <", "S> starts", " <S", "\n\r\t ", "x" * 50_000 + "👍", "<M", "$0 \\1"]


def plain(doc_id, text, seed=1):
    t = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "plain" if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90 else "spm" if h4 % 100 < 20 else "psm"
    pre, mid, suf = t[:a], t[a:b], t[b:]
    out = {"plain": t, "psm": f"<P>{pre}<S>{suf}<M>{mid}", "spm": f"<S>{suf}<P>{pre}<M>{mid}"}[form]
    return n, form, None if form == "plain" else a, None if form == "plain" else b - a, out


def test_outputs_equal_the_plain_form(spark):
    rows = [(i, ODD[i % len(ODD)]) for i in range(40 * len(ODD))] + [(None, "no id"), (7, "twice"), (7, "twice"), (-3, "below")]
    df = spark.createDataFrame([(i, t, 9, "x") for i, t in rows], "doc_id long, text string, n int, form string")
    done = infill.fill_in_middle(df)
    got = sorted((str(r.doc_id), r.text or "", r.n, r.form, None if r.prefix is None else len(r.prefix), None if r.middle is None else len(r.middle), r.output) for r in done.collect())
    assert got == sorted((str(i), t or "", *plain(i, t)) for i, t in rows)
    assert {g[3] for g in got} == {"plain", "psm", "spm"}
    short = infill.digests(df)
    want = sorted((str(i), hashlib.sha256(plain(i, t)[4].encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), r.output_sha256, r.restored_sha256) for r in short.collect()) == want
    assert infill.digests(df.limit(0)).count() == 0


def test_units_markers_and_rates(spark):
    texts = ["one two  three\nfour", "lone", "tail  ", "a\x1fb \x1e c", ""] * 12
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    rows = infill.fill_in_middle(df, seed=5, plain=0, spm=50, unit=r"\S+\s*", markers=marks).withColumn("back", infill.rebuilt(F.col("output"), F.col("form"), marks)).collect()
    assert all(r.back == r.text for r in rows) and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        if r.text.startswith("one"):
            assert r.n == 4 and all(part in ("", "one ", "two  ", "three\n", "four") or part.strip().count(" ") + part.strip().count("\n") for part in (r.prefix, r.middle, r.suffix))
    assert all(r.form == "plain" for r in infill.fill_in_middle(df, plain=100).collect())
    assert all(r.form != "psm" for r in infill.fill_in_middle(df, plain=0, spm=100).collect())


def test_no_python_and_no_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = infill.digests(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
