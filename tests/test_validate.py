import time

import pytest
from pyspark.sql import functions as F

from grapheon.operators import traverse
from grapheon.plans import binds, validate


def test_blocks_and_parameters():
    text = "# a\n```sql\nSELECT 1\n```\n```python\nx\n```\n```sql\nSELECT ':no', \":no\", a::int, :yes -- :no\n/* :no */ , :yes, `:no`\n```\n```sql\nopen"
    assert validate.blocks(text) == ["SELECT 1", "SELECT ':no', \":no\", a::int, :yes -- :no\n/* :no */ , :yes, `:no`"]
    assert validate.parameters(validate.blocks(text)[1]) == ["yes"]
    values = {"name": "n", "start": "s", "state": None, "attribute": "a", "word": "w", "short": None, "module": "m", "kind": "k", "label": "l", "file": "f", "requirement": "r"}
    names = ["root_id", "state_from", "someState", "attributeName", "searchTerm", "modelName", "edge_label", "requirement_ref", "other", "kindly", "shortName", "element"]
    assert validate.guess(names, values) == {
        "root_id": "s", "state_from": "s", "someState": "s", "attributeName": "a", "searchTerm": "w", "modelName": "m", "edge_label": "l", "requirement_ref": "r", "other": "n", "kindly": "k", "shortName": None, "element": "s",
    }
    assert validate.substitute("'<NAME>' <WORD> <STATE>", {"name": "O'Neil", "word": "w"}) == "'O''Neil' w "


def test_each_block_has_a_row(spark):
    spark.range(7).createOrReplaceTempView("project_numbers")
    blocks = ["SELECT * FROM project_numbers WHERE id >= :least", "INSERT INTO project_numbers SELECT 1", "SELECT (", "SELECT missing FROM project_numbers", "SELECT raise_error('late') FROM project_numbers", "SELECT 1 AS a, 2 AS a WHERE false"]
    text = "See project_numbers and project_unknown.\n" + "".join(f"```sql\n{b}\n```\n" for b in blocks)
    rows = validate.checked(spark, text, {"name": 3}).collect()
    assert [(r.n, r.parses, r.runs, r["rows"]) for r in rows] == [(1, True, True, 4), (2, False, False, 0), (3, False, False, 0), (4, False, False, 0), (5, True, False, 0), (6, True, True, 0)]
    assert rows[0].binds == ["least"] and rows[0].error is None and "InsertInto" in rows[1].error and rows[1].error.startswith("PermissionError")
    assert rows[2].error.startswith("ParseException") and rows[3].error.startswith("AnalysisException") and "late" in rows[4].error
    assert validate.invented(spark, text, "project") == ["project_unknown"]
    assert spark.table("project_numbers").count() == 7
    assert validate.checked(spark, "no blocks", {}).count() == 0


def test_a_slow_block_is_cancelled_and_the_next_one_runs(spark):
    slow = "SELECT count_if(sha2(cast(a.id * b.id AS string), 512) < 'f') FROM range(3000000) a CROSS JOIN range(3000000) b"
    began = time.time()
    rows = validate.check(spark, f"```sql\n{slow}\n```\n```sql\nSELECT 1\n```", {}, seconds=3)
    assert time.time() - began < 60
    assert rows[0].parses and not rows[0].runs and rows[0].error.startswith("TimeoutError") and rows[1].runs
    tracker = spark.sparkContext.statusTracker()
    deadline = time.time() + 30
    while tracker.getActiveJobsIds() and time.time() < deadline:
        time.sleep(0.2)
    assert not tracker.getActiveJobsIds()  # ended in the executors, too
    assert not list(spark.sparkContext.getJobTags())


def test_the_richest_element_by_hand(spark):
    rows = [
        ("p", "package", None, None, None), ("a", "part", "p", None, None), ("b", "part", "p", "mass", 1.0), ("r", "requirement", "p", None, None),
        ("a1", "part", "a", "mass", 2.0), ("a2", "part", "a", "mass", 3.0), ("a3", "attribute", "a", "length", 4.0), ("d", "definition", None, "width", 5.0), ("lone", "part", None, "mass", 9.0),
        ("req1", "requirement", "r", "mass", 1.0), ("req2", "requirement", "r", "mass", 1.0),
    ]
    e = spark.createDataFrame(rows, "key string, kind string, owner string, attribute string, num double").withColumn("name", F.concat(F.lit("name of "), "key"))
    cross = spark.createDataFrame([("a1", "d"), ("b", "d"), ("d", "d")], "src string, dst string")
    assert [tuple(r) for r in binds.richest(e, cross).collect()] == [("p", "mass", 7, 9)]
    inner = e.filter("key <> 'p'").withColumn("owner", F.when(F.col("owner") != "p", F.col("owner")))
    assert [tuple(r) for r in binds.richest(inner, cross).collect()] == [("a", "mass", 4, 4)]
    assert binds.richest(e.filter("key = 'lone'"), cross.limit(0)).count() == 0
    edges = spark.createDataFrame([("x", "y", "transitionsTo"), ("w", "y", "transitionsTo")], "src string, dst string, label string")
    row = binds.bind_values(e, edges, cross).head()
    assert (row.start, row.name, row.attribute, row.kind, row.requirement, row.state, row.element, row.word) == ("p", "name of p", "mass", "part", "r", "w", None, "name")
    empty = binds.bind_values(e.limit(0), edges.limit(0), cross.limit(0)).collect()
    assert len(empty) == 1 and empty[0].start is None and empty[0].kind is None


@pytest.mark.parametrize("most", [2, 8])
@pytest.mark.parametrize("direction", ["out", "in"])
def test_recursive_relation_equals_the_walk(spark, most, direction):
    edges = [(f"n{i // 3}", f"n{i}") for i in range(1, 60)] + [("n1", "n50"), ("n2", "n50"), ("n50", "n51")]
    e = spark.createDataFrame(edges, "src string, dst string")
    roots = spark.createDataFrame([("n0",), ("n1",), ("n59",), ("none",)], "root string")
    for least in (0, 1):
        want = sorted(map(tuple, traverse.walk(roots, e, most, least, direction).collect()))
        assert sorted(map(tuple, traverse.walk_recursive(roots, e, most, least, direction).collect())) == want
    plan = traverse.walk_recursive(roots, e, most)._jdf.queryExecution().optimizedPlan().toString()
    assert "UnionLoop" in plan


def test_what_is_a_forest(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "b")], "src string, dst string")
    assert traverse.forest(e) and not traverse.forest(e, "in") and not traverse.forest(e, "any")
    assert not traverse.forest(e.unionByName(spark.createDataFrame([("c", "b")], "src string, dst string")))
