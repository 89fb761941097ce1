import pytest
from pyspark.sql import functions as F

from grapheon.notation import model as notation
from grapheon.sources.versions import ConcurrentWrite, Table
from grapheon.streaming.incremental import Store


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_stopped_write_leaves_the_old_rows(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    with pytest.raises(LookupError):
        t.read()
    old = spark.createDataFrame([(1, "a"), (2, "b")], "key long, name string")
    assert t.write(old).number == 1
    broken = spark.range(100).select(F.col("id").alias("key"), F.when(F.col("id") == 77, F.raise_error(F.lit("stopped"))).otherwise(F.lit("x")).cast("string").alias("name"))
    with pytest.raises(Exception, match="stopped"):
        t.upsert(broken)
    assert rows(t.read()) == [(1, "a"), (2, "b")] and t.current().number == 1
    (tmp_path / "t" / "versions" / "2").write_text("")  # a manifest that was never finished
    assert rows(t.read()) == [(1, "a"), (2, "b")]
    new = spark.createDataFrame([(2, "B"), (3, "c")], "key long, name string")
    for _ in range(2):  # run again: the same rows
        t.upsert(new)
        assert rows(t.read()) == [(1, "a"), (2, "B"), (3, "c")]
    assert t.current().number == 4
    t.update(spark.createDataFrame([(1, "A"), (9, "no")], "key long, name string"))
    assert rows(t.read()) == [(1, "A"), (2, "B"), (3, "c")] and rows(t.read(1)) == [(1, "a"), (2, "b")]


def test_of_two_writes_one_is_refused(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    base = t.write(spark.createDataFrame([(1,)], "key long"))
    held = t.read()  # a reader stays on its version
    t.write(spark.createDataFrame([(2,)], "key long"), base)
    with pytest.raises(ConcurrentWrite):
        t.write(spark.createDataFrame([(3,)], "key long"), base)
    with pytest.raises(ConcurrentWrite):
        t._commit(t.current())
    assert rows(held) == [(1,)] and rows(t.read()) == [(2,)]
    assert t.vacuum(keep=1) == 2 and rows(t.read()) == [(2,)]
    with pytest.raises(LookupError):
        t.read(1)


def test_partitions_that_are_not_replaced_keep_their_folders(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([("a", 1), ("b/x y", 2), ("c", 3)], "m string, n int")
    first = t.replace(df, "m", ["a", "b/x y", "c"])
    second = t.replace(df.filter("m = 'a'").withColumn("n", F.lit(9)), "m", ["a", "c"])
    assert rows(t.read()) == [("a", 9), ("b/x y", 2)] and second.folders["b/x y"] == first.folders["b/x y"] and second.folders["a"] != first.folders["a"]
    assert rows(t.read(only=["b/x y"])) == [("b/x y", 2)] and rows(t.read(1)) == rows(df)
    assert t.vacuum(keep=1) == 0 and rows(t.read()) == [("a", 9), ("b/x y", 2)]


FILES = {
    "m1/a.sysml": "package A { part def P; part p : P; }",
    "m1/b.sysml": "package B { import A::*; part q : P; }",
    "m2/c.sysml": "package C { part def R; part r : R; }",
    "m3/d.sysml": "package D { requirement x; }",
}


def batch_result(spark, files):
    parsed = notation.declarations(spark.createDataFrame(list(files.items()), "path string, text string"))
    found, related = notation.elements(parsed), notation.relations(parsed)
    return rows(found.select("module", "identity", "kind", "display")), rows(related.select("module", "src", "label", "dst", "written"))


def stored(store):
    return rows(store.elements.read().select("module", "identity", "kind", "display")), rows(store.relations.read().select("module", "src", "label", "dst", "written"))


def test_batches_give_what_all_files_give(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    frame = lambda d: spark.createDataFrame(list(d.items()), "path string, text string")
    assert store.take(frame(FILES)) == ["m1", "m2", "m3"]
    assert stored(store) == batch_result(spark, FILES)
    before = store.elements.current()
    assert store.take(frame(FILES), 0) == [] and store.elements.current() == before  # a batch that comes again
    change = {"m1/b.sysml": "package B { import A::*; part q : P; part q2 : P; }", "m3/d.sysml": FILES["m3/d.sysml"]}
    assert store.take(frame(change), 1) == ["m1"]
    after = store.elements.current()
    assert stored(store) == batch_result(spark, FILES | change)
    assert after.folders["m2"] == before.folders["m2"] and after.folders["m3"] == before.folders["m3"] and after.folders["m1"] != before.folders["m1"]
    assert store.take(spark.createDataFrame([("m3/d.sysml", None)], "path string, text string"), 2) == ["m3"]
    assert stored(store) == batch_result(spark, {p: t for p, t in (FILES | change).items() if p != "m3/d.sysml"})


def test_a_batch_that_was_stopped_is_run_again(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    df = spark.createDataFrame(list(FILES.items()), "path string, text string")
    monkeypatch.setattr(store.files, "write", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError, match="stopped"):
        store.take(df)
    monkeypatch.undo()
    again = Store(spark, store.path)
    assert again.take(df) == ["m1", "m2", "m3"] and stored(again) == batch_result(spark, FILES)


def test_a_stream_of_files(spark, tmp_path):
    source, store = tmp_path / "in", Store(spark, str(tmp_path / "store"))
    source.mkdir()

    def put(name, files):
        spark.createDataFrame(list(files.items()), "path string, text string").coalesce(1).write.mode("append").json(str(source))

    stream = lambda: spark.readStream.schema("path string, text string").json(str(source))
    put("one", dict(list(FILES.items())[:2]))
    store.follow(stream(), str(tmp_path / "cp")).awaitTermination()
    put("two", dict(list(FILES.items())[2:]))
    store.follow(stream(), str(tmp_path / "cp")).awaitTermination()
    assert stored(store) == batch_result(spark, FILES)
