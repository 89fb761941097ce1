import pytest

from grapheon.plans import lint, survey
from grapheon.queries_survey import model
from tests.test_rest import SF


@pytest.fixture(scope="module")
def views(spark):
    spark.sql("""SELECT 'pump_0123456789' AS key, 'A::Pump' AS qualified, 'A::Pump' AS identity, 'pump' AS name, map('mass', named_struct('num', 1.0, 'unit', 'kg')) AS attributes, named_struct('text', '1', 'lower', 1) AS multiplicity""").createOrReplaceTempView("elements")
    spark.sql("SELECT 'a' AS key, 'thing' AS type, 2.0 AS weight, map('mass', 1.0) AS attributes, 'pump_0123456789' AS element").createOrReplaceTempView("entities")
    spark.sql("SELECT 'a_0123456789' AS src, 'b' AS dst, 'owns' AS label").createOrReplaceTempView("edges")
    spark.sql("CREATE OR REPLACE TEMP VIEW seen AS SELECT key AS k, qualified AS place, attributes AS held FROM elements")
    spark.sql("CREATE OR REPLACE TEMP VIEW guessed AS SELECT key AS g, weight AS w, attributes AS traits FROM entities")
    yield
    for v in ("elements", "entities", "edges", "seen", "guessed"):
        spark.catalog.dropTempView(v)


@pytest.mark.parametrize(
    "sql, name",
    [
        ("SELECT * FROM elements WHERE name = :wanted", "bind parameter"),
        ("SELECT sum(w) FROM guessed", "aggregate over inferred entities"),
        ("WITH x AS (SELECT g AS a FROM guessed) SELECT count(*) FROM x", "aggregate over inferred entities"),
        ("SELECT e.name, count(t.g) FROM elements e JOIN guessed t ON t.w > 1 GROUP BY e.name", "aggregate over inferred entities"),
        ("SELECT (SELECT max(w) FROM guessed) AS most FROM elements", "aggregate over inferred entities"),
        ("SELECT * FROM seen WHERE place LIKE '%Pump'", "substring as scope"),
        ("SELECT * FROM (SELECT upper(place) AS p FROM seen) WHERE contains(p, 'PUMP')", "substring as scope"),
        ("SELECT * FROM (SELECT place AS p FROM seen UNION ALL SELECT identity FROM elements) WHERE instr(p, 'x') > 0", "substring as scope"),
        ("SELECT held.mass.num FROM seen", "sparse attribute by path"),
        ("SELECT m.num FROM (SELECT held['mass'] AS m FROM seen)", "sparse attribute by path"),
        ("SELECT element_at(a, 'mass').unit FROM (SELECT attributes AS a FROM elements)", "sparse attribute by path"),
        ("SELECT * FROM seen WHERE 'pump_0123456789' = k", "literal element key"),
        ("SELECT * FROM seen s JOIN edges e ON e.dst = s.k AND e.src IN ('x', 'a_0123456789')", "literal element key"),
        ("SELECT traits FROM guessed", "attributes of entities"),
        ("SELECT size(t) FROM (SELECT traits AS t FROM guessed) WHERE true", "attributes of entities"),
    ],
)
def test_faults_behind_aliases_and_views(spark, views, sql, name):
    assert [f.name for f in lint.lint_query(spark, sql)] == [name]


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT name AS qualified FROM elements WHERE name LIKE '%p'",
        "SELECT * FROM seen WHERE place LIKE 'A::%' OR place = 'x' OR place RLIKE '^A'",
        "SELECT count(*) AS n, max(held['mass'].num) IS NULL AS none FROM (SELECT map('mass', named_struct('num', 1)) AS held FROM elements) AS entities",
        "SELECT a, v.num FROM elements LATERAL VIEW explode(attributes) t AS a, v WHERE a = 'mass'",
        "SELECT multiplicity.lower FROM elements WHERE name = 'pump_0123456789' OR key LIKE 'x'",
        "SELECT g, w + 1 FROM guessed WHERE w > 1",
        "SELECT e.name, count(*) FROM elements e JOIN guessed t ON t.g = e.name GROUP BY e.name",
        "SELECT count(*) FROM elements WHERE key IN (SELECT element FROM entities)",
    ],
)
def test_no_false_alarms(spark, views, sql):
    assert lint.lint_query(spark, sql) == []


def test_no_false_alarm_on_the_probes(spark):
    m = model(spark, SF)
    for name in ("elements", "edges", "entities", "inferred"):
        getattr(m, name).createOrReplaceTempView(name)
    named = survey.Model(*(spark.table(n) if n in ("elements", "edges", "entities", "inferred") else getattr(m, n) for n in ("elements", "edges", "sources", "entities", "inferred", "labels")))
    found = {name: [f.name for f in lint.lint_frame(probe(named))] for name, probe in survey.PROBES.items()}
    assert len(found) == 24
    inferred = {n for n, f in found.items() if f}  # these are about what is inferred, and count it
    assert all(f in ([], ["aggregate over inferred entities"]) for f in found.values()), found
    assert inferred <= {"sizes", "inferred_types", "link_coverage", "layers"}, found
    for name in ("elements", "edges", "entities", "inferred"):
        spark.catalog.dropTempView(name)
