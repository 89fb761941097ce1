import random

import pytest

from grapheon import queries
from grapheon.operators import traverse
from grapheon.plans import binds
from tests.test_queries import SF


def below(edges, root):
    seen, todo = set(), [root]
    while todo:
        k = todo.pop()
        if k not in seen:
            seen.add(k)
            todo += [b for a, b in edges if a == k]
    return seen


def test_few_roots_are_bits_and_a_node_is_one_row(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for _ in range(60)] * 2
    roots = [f"n{i}" for i in range(12)] + ["alone"]
    start = spark.createDataFrame([(r,) for r in roots * 2], "root string")
    seen, names = traverse.marks(start, spark.createDataFrame(edges, "src string, dst string"), 64)
    assert seen.count() == len({k for r in roots for k in below(edges, r)})
    assert sorted((r.root, r.node) for r in traverse.marked(seen, names).collect()) == sorted((r, k) for r in roots for k in below(edges, r))
    many = spark.createDataFrame([(f"n{i}",) for i in range(traverse.MARKS + 1)], "root string")
    assert traverse.marks(many, spark.createDataFrame(edges, "src string, dst string")) is None
    sizes = {r: len(below(edges, r)) - 1 for r in roots if len(below(edges, r)) > 1}
    assert {r.root: r["size"] for r in traverse.subtree_sizes(start, spark.createDataFrame(edges, "src string, dst string"), 64).collect()} == sizes


@pytest.mark.parametrize("seed", [1, 2])
def test_richest_leaves_out_owned_candidates(spark, seed, monkeypatch):
    """A candidate with a number is never richer than its owner without one: such roots were all walked from."""
    rng, asked, real = random.Random(seed), [], traverse.marks
    monkeypatch.setattr(traverse, "marks", lambda roots, *rest: asked.append(roots.count()) or real(roots, *rest))
    rows = [("e0", "package", None, None, None)]
    for i in range(1, 40):
        num = rng.choice([None, 1.0])
        rows.append((f"e{i}", rng.choice(["part", "package", "other"]), f"e{rng.randrange(i)}", num and rng.choice("ab"), num))
    cross = [(f"e{rng.randrange(40)}", f"e{rng.randrange(40)}") for _ in range(6)]
    edges = [(r[2], r[0]) for r in rows if r[2]] + cross
    value = {r[0]: r[3] for r in rows if r[3]}
    able = [r for r in rows if r[1] != "other" and sum(x[2] == r[0] for x in rows) > 1]
    found = []
    for r in able:
        held = [value[k] for k in below(edges, r[0]) - {r[0]} if k in value]
        if held:
            found.append((-len(held), 1 - len(below(edges, r[0])), r[0], min((-held.count(a), a) for a in set(held))[1]))
    least = min(found)
    got = binds.richest(spark.createDataFrame(rows, "key string, kind string, owner string, attribute string, num double"), spark.createDataFrame(cross, "src string, dst string")).collect()
    assert [(-g.valued, -g["size"], g.root, g.attribute) for g in got] == [least]
    bare = {r[0] for r in able if r[0] not in value}
    assert asked == [len([r for r in able if not (r[0] in value and r[2] in bare)])]


def test_satisfied_requirements_are_made_distinct_once(spark):
    assert "count(distinct" not in queries.QUERIES["unsatisfied_all"](spark, SF)._jdf.queryExecution().executedPlan().toString()
