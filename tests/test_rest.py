"""Operators that no query's SQL covers: the gate, lint, sources and sinks, streams, clusters, survey and embedding."""

import json

import pytest
from pyspark.errors import AnalysisException

from grapheon.operators import mutate, retrieve, search
from grapheon.plans import guard, survey
from grapheon.queries_survey import model
from grapheon.sources import files
from grapheon.streaming import transitions as streams

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sql", ["DROP TABLE t", "INSERT INTO t SELECT 1", "CREATE TABLE t (a int)", "DELETE FROM t WHERE a = 1", "UPDATE t SET a = 1", "TRUNCATE TABLE t", "CREATE DATABASE x", "ALTER TABLE t RENAME TO u", "SET a = 1"])
def test_the_gate_refuses_what_writes(spark, sql):
    with pytest.raises(PermissionError):
        guard.read_only(spark, sql)


def test_the_gate_lets_queries_through(spark):
    assert guard.read_only(spark, "SELECT 'drop table t' AS a WHERE 1 = :one", {"one": 1}).head().a == "drop table t"
    assert guard.writes(spark, "WITH d AS (SELECT 1 AS delete) SELECT * FROM d") is None
    with pytest.raises(AnalysisException):
        guard.read_only(spark, "SELECT * FROM no_such_table")


@pytest.mark.parametrize(
    "sql, name",
    [
        ("SELECT 1 WHERE a = :x", "bind parameter"), ("SELECT count(*) FROM entities", "aggregate over inferred entities"), ("SELECT 1 WHERE qualified LIKE '%a'", "substring as scope"),
        ("SELECT attributes.mass.value FROM e", "sparse attribute by path"), ("SELECT 1 WHERE key = 'pump_0123456789'", "literal element key"), ("SELECT entities.x, attributes FROM e", "attributes of entities"),
    ],
)
def test_lint(sql, name):
    assert [f.name for f in guard.lint(sql)] == [name]
    assert guard.lint("SELECT a::int FROM elements WHERE name = 'x'") == []


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "m" / "deep").mkdir(parents=True)
    (tmp_path / "m" / "a.sysml").write_text("package A {\n import B::*;\n}")
    (tmp_path / "m" / "deep" / "b.sysml").write_text("package B {\n import A::*;\n import A::*;\n}")
    (tmp_path / "n.sysml").write_text("//")
    (tmp_path / "empty.sysml").write_text("")
    (tmp_path / "m" / "c.txt").write_text("no")
    found = files.read_sources(spark, str(tmp_path))
    assert sorted((r.path, r.text) for r in found.collect())[0] == ("m/a.sysml", "package A {\n import B::*;\n}")
    assert sorted((r.module, r.files) for r in files.modules(found).collect()) == [("m", ["m/a.sysml", "m/deep/b.sysml"]), ("n", ["n.sysml"])]
    stats = {r.path: (r.module, r.lines, r.characters) for r in files.source_stats(found).collect()}
    assert stats == {"m/a.sysml": ("m", 3, 27), "m/deep/b.sysml": ("m", 4, 41), "n.sysml": ("n", 1, 2)}
    imports = files.import_edges(found)
    declared = spark.createDataFrame([("A", "m/a.sysml"), ("B", "m/deep/b.sysml")], "namespace string, path string")
    assert sorted(r.path for r in files.import_cycles(imports, declared).collect()) == ["m/a.sysml", "m/deep/b.sysml"]
    files.write_partitioned(spark.createDataFrame([("x", "owns", 1), ("y", "owns", 2)], "module string, label string, n int"), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("module=*")) == ["module=x", "module=y"]
    files.write_report(imports, str(tmp_path / "report"))
    assert files.read_inferred(spark, str(tmp_path / "report")).count() == 2
    text = files.rendered(spark.range(1000), 100, "id")
    assert len(text) <= 104 and text.endswith("...") and json.loads(text.split("\n")[0]) == {"id": 0}
    elements = spark.createDataFrame([("part",), ("part",), ("port",)], "kind string")
    related = spark.createDataFrame([("owns", "a"), ("owns", None)], "label string, dst string")
    assert sorted(map(tuple, files.report(elements, related).collect())) == [("elements", "part", 2), ("elements", "port", 1), ("relations", "owns", 1), ("unresolved", "owns", 1)]


def test_databases_vector_index_and_search_view(spark):
    files.create_database(spark, "model_graph")
    rows = spark.createDataFrame([(1, "a", [3.0, 4.0]), (2, "b", [0.0, 0.0]), (3, "a", None)], "key long, module string, embedding array<double>")
    files.create_vector_index(rows, "model_graph.vectors")
    assert [(r.key, r.embedding) for r in spark.table("model_graph.vectors").collect()] == [(1, [0.6, 0.8])]
    files.drop_vector_index(spark, "model_graph.vectors")
    docs = spark.createDataFrame([(1, "the thing the"), (2, "other")], "doc_id long, text string")
    files.write_search_view(search.postings(docs), "model_graph.postings")
    assert [r.doc_id for r in search.bm25_postings(spark.table("model_graph.postings"), ["the"], 5, 2, 2.0).collect()] == [1]
    files.drop_database(spark, "model_graph")
    assert "model_graph" not in [r.namespace for r in spark.sql("SHOW DATABASES").collect()]


def test_a_stream_gives_the_batch_result(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").orderBy("ts", "event_id").coalesce(1)
    events.write.parquet(str(tmp_path / "events"))
    given = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    query = streams.stream_transitions(given).writeStream.format("memory").queryName("steps").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    want = streams.transitions(events).select("user_id", "src", "dst", "event_id")
    assert sorted(map(tuple, spark.table("steps").collect())) == sorted(map(tuple, want.collect()))
    counts = streams.windowed_counts(given).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    counts.awaitTermination()
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, streams.windowed_counts(events).collect()))


def test_clusters_are_cliques(spark):
    nodes = [("m", f"n{i}") for i in range(9)] + [("k", "lone")]
    near = [("m", f"n{3 * g + a}", f"n{3 * g + b}", 1.0) for g in range(3) for a in range(3) for b in range(a)] + [("m", "n0", "n3", 0.1)]
    found = search.clusters(spark.createDataFrame(nodes, "module string, node string"), spark.createDataFrame(near, "module string, a string, b string, weight double")).collect()
    groups = {}
    for r in found:
        groups.setdefault((r.module, r.cluster), []).append(r.node)
    assert sorted(sorted(g) for g in groups.values()) == [["lone"], ["n0", "n1", "n2"], ["n3", "n4", "n5"], ["n6", "n7", "n8"]]


def test_survey_renders_every_probe(spark):
    found = survey.survey(model(spark, SF), most=500)
    assert list(found) == list(survey.PROBES) and len(found) == 24
    assert all(text and json.loads(text.split("\n")[0]) for text in found.values())
    assert all(len(text) <= 504 for text in found.values())


def test_vectors_come_from_a_service_in_batches(spark):
    rows = spark.createDataFrame([(i, "x" * i if i else None) for i in range(150)], "key long, text string").coalesce(1)
    found = {r.key: r.embedding for r in retrieve.embedded(rows, lambda texts: [[float(len(t)), float(len(texts))] for t in texts]).collect()}
    assert found[0] == [0.0, 64.0] and found[149] == [149.0, 22.0]
    assert retrieve.attach(rows.limit(0), spark.createDataFrame([(1, [0.0])], "key long, embedding array<double>")).count() == 0


def test_an_off_topic_question_gets_no_report(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.8, 0.6])], "key long, embedding array<double>")
    assert [r.key for r in retrieve.reports(rows, [1.0, 0.0]).collect()] == ["1", "2"]
    assert retrieve.reports(rows, [-1.0, 0.1]).count() == 0


def test_prune_drops_twins_either_way_round(spark):
    inferred = spark.createDataFrame([("a", "b", "R"), ("b", "a", "R"), ("c", "c", "R"), ("c", "d", "Owns"), ("c", "d", "R")], "src string, dst string, label string")
    stated = spark.createDataFrame([("b", "a", "owns")], "src string, dst string, label string")
    assert [tuple(r) for r in mutate.prune(inferred, stated, ["owns"]).collect()] == [("c", "d", "R")]
