"""Named queries over the driver's tables, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grapheon.functions import scalar
from grapheon.notation import model as notation
from grapheon.operators import intervals, mutate, names, rollup, search, traverse
from grapheon.plans.graph import COMPOSITION, Graph
from grapheon.registry import BM25_SQL, ORACLE_SQL, QUERIES, TOTAL, _graph, _read, query  # noqa: F401  the dicts are read from here
from grapheon.streaming.transitions import transitions


def _roots(g: Graph, kind: str = "region/") -> DataFrame:
    return g.elements.filter(F.col("key").startswith(kind)).select(F.col("key").alias("root"))


@query("WITH RECURSIVE {graph}, walk AS (SELECT key AS root, key AS node FROM elements WHERE kind = 'package' UNION SELECT w.root, e.dst FROM walk w JOIN edges e ON e.src = w.node AND e.label IN ('owns', 'typedBy'))"
       " SELECT root, unit, " + TOTAL.format(c="num") + " AS total, COUNT(*) AS n FROM walk JOIN elements ON key = node WHERE num IS NOT NULL GROUP BY root, unit")  # fmt: skip
def composition_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by unit of everything below each package."""
    g = _graph(spark, sf_dir)
    roots = g.elements.filter("kind = 'package'").select(F.col("key").alias("root"))
    return rollup.by_unit_reached(roots, g.elements, g.labelled(*COMPOSITION))


@query("WITH RECURSIVE {graph}, walk AS (SELECT key AS root, key AS node FROM elements UNION SELECT w.root, e.dst FROM walk w JOIN edges e ON e.src = w.node AND e.label = 'owns'), s AS (SELECT root, COUNT(*) - 1 AS size FROM walk GROUP BY root HAVING COUNT(*) > 1)"
       " SELECT root, size, unit, " + TOTAL.format(c="num") + " AS total, COUNT(*) AS n FROM walk JOIN s USING (root) JOIN elements ON key = node WHERE num IS NOT NULL GROUP BY root, size, unit")  # fmt: skip
def owned_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every element that owns any: how many it owns over all levels, and their totals with its own, by unit, from the interval index."""
    g = _graph(spark, sf_dir)
    numbered = intervals.intervals(g.elements)
    ranges = numbered.filter("post > pre").select(F.col("key").alias("entry"), "pre", "post")
    totals = intervals.below(ranges, numbered, g.elements.filter("num is not null").select("key", "unit", "num"))
    return totals.join(ranges, "entry").select(F.col("entry").alias("root"), (F.col("post") - F.col("pre")).alias("size"), "unit", F.col("total").cast("double").alias("total"), "n")


@query("WITH RECURSIVE {graph}, walk AS (SELECT key AS root, key AS node, 0 AS depth FROM elements WHERE key LIKE 'region/%' UNION SELECT w.root, e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.node AND e.label = 'owns')"
       " SELECT root, node, MIN(depth) AS depth FROM walk WHERE depth <= 2 GROUP BY root, node")  # fmt: skip
def walk_least_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return traverse.walk(_roots(g), g.labelled("owns"), most=2)


@query("WITH RECURSIVE {graph}, walk AS (SELECT key AS root, key AS node, 0 AS depth FROM elements WHERE kind = 'package' UNION SELECT w.root, e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.node AND e.label = 'owns') SELECT * FROM walk WHERE depth > 0")
def walk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything below each package, by a recursive relation; ownership is a forest."""
    g = _graph(spark, sf_dir)
    return traverse.walk_recursive(g.elements.filter("kind = 'package'").select(F.col("key").alias("root")), g.labelled("owns"), least=1)


@query("WITH RECURSIVE {graph}, walk AS (SELECT key AS root, key AS node FROM elements WHERE key LIKE 'nation/%' UNION SELECT w.root, e.dst FROM walk w JOIN edges e ON e.src = w.node AND e.label IN ('owns', 'typedBy'))"
       " SELECT root, COUNT(*) - 1 AS size FROM walk GROUP BY root HAVING COUNT(*) > 1 ORDER BY size DESC, root LIMIT 10")  # fmt: skip
def subtree_size_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return traverse.subtree_sizes(_roots(g, "nation/"), g.labelled(*COMPOSITION)).orderBy(F.desc("size"), "root").limit(10)


@query("WITH RECURSIVE {graph}, up AS (SELECT key AS root, key AS node, 0 AS depth FROM elements WHERE kind = 'part' UNION SELECT root, e.src, depth + 1 FROM up JOIN edges e ON e.dst = node AND e.label = 'owns') SELECT root, node, depth FROM up WHERE depth > 0")
def walk_inbound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that each part lies in."""
    g = _graph(spark, sf_dir)
    parts = g.elements.filter("kind = 'part'").select(F.col("key").alias("root"))
    return traverse.walk(parts, g.labelled("owns"), least=1, direction="in")


@query("WITH {graph} SELECT DISTINCT src AS root, dst AS node FROM (SELECT src, dst FROM edges WHERE label = 'owns' UNION ALL SELECT dst, src FROM edges WHERE label = 'owns') WHERE src LIKE 'customer/%'")
def neighbours_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each customer is next to, either way round."""
    g = _graph(spark, sf_dir)
    return traverse.hop(_roots(g, "customer/"), g.labelled("owns"), "root", "any").select("root", F.col("dst").alias("node")).distinct()


@query("WITH {graph}, l AS (SELECT 'order/' || l_orderkey AS o, 'part/' || l_partkey AS p, SUM(CAST(l_quantity AS BIGINT)) AS m FROM lineitem GROUP BY 1, 2)"
       " SELECT 'customer/' || o_custkey AS root, CAST(SUM(m) AS DOUBLE) AS total FROM orders JOIN l ON o = 'order/' || o_orderkey GROUP BY 1")  # fmt: skip
def path_multiplicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts below each customer, each path counted with its quantity."""
    g = _graph(spark, sf_dir)
    owns = g.labelled("owns").filter(F.col("src").startswith("customer/")).select("src", "dst", F.lit(1.0).alias("multiplicity"))
    line = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("m"))
    typed = line.select(F.concat(F.lit("order/"), "l_orderkey").alias("src"), F.concat(F.lit("part/"), "l_partkey").alias("dst"), F.col("m").cast("double").alias("multiplicity"))
    values = g.elements.filter("kind = 'part_definition'").select(F.col("key").alias("node"), F.lit(1.0).alias("value"))
    return traverse.path_totals(_roots(g, "customer/"), owns.unionByName(typed), values, 2)


@query("WITH {graph} SELECT COUNT(*) AS n, COUNT(*) FILTER (key IN (SELECT dst FROM edges WHERE label = 'satisfies')) AS covered, COUNT(*) FILTER (key NOT IN (SELECT dst FROM edges WHERE label = 'satisfies')) AS uncovered FROM elements WHERE kind = 'requirement'")
def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return rollup.coverage(g.elements.filter("kind = 'requirement'"), g.edges)


@query("WITH {graph} SELECT key, name FROM elements WHERE kind = 'requirement' AND key NOT IN (SELECT dst FROM edges WHERE label = 'satisfies')")
def unsatisfied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requirements that nothing satisfies: an anti-join."""
    g = _graph(spark, sf_dir)
    return rollup.uncovered(g.elements.filter("kind = 'requirement'"), g.edges).select("key", "name")


@query("WITH RECURSIVE {graph}, walk AS (SELECT key AS root, key AS node FROM elements WHERE key LIKE 'region/%' UNION SELECT w.root, e.dst FROM walk w JOIN edges e ON e.src = w.node AND e.label IN ('owns', 'typedBy'))"
       " SELECT root, unit, " + TOTAL.format(c="num") + " AS total, COUNT(*) AS n FROM walk JOIN elements ON key = node WHERE num IS NOT NULL GROUP BY root, unit")  # fmt: skip
def composition_rollup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by unit of everything below each region."""
    g = _graph(spark, sf_dir)
    return rollup.by_unit_reached(_roots(g), g.elements, g.labelled(*COMPOSITION))


@query("WITH RECURSIVE {graph}, up AS (SELECT key AS root, key AS node, 0 AS depth FROM elements WHERE key LIKE 'order/%' UNION SELECT root, e.src, depth + 1 FROM up JOIN edges e ON e.dst = node AND e.label = 'owns') SELECT root, node, depth FROM up WHERE depth > 0")
def walk_inbound_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return traverse.walk(_roots(g, "order/"), g.labelled("owns"), least=1, direction="in")


@query("WITH {graph} SELECT DISTINCT src AS root, dst AS node FROM (SELECT src, dst FROM edges WHERE label = 'owns' UNION ALL SELECT dst, src FROM edges WHERE label = 'owns') WHERE src LIKE 'nation/%'")
def neighbours_any_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return traverse.hop(_roots(g, "nation/"), g.labelled("owns"), "root", "any").select("root", F.col("dst").alias("node")).distinct()


@query("WITH {graph}, r AS (SELECT key FROM elements WHERE kind = 'requirement'), c AS (SELECT src, COUNT(DISTINCT dst) AS n FROM edges JOIN r ON dst = key WHERE label = 'satisfies' GROUP BY src)"
       " SELECT e.key AS supplier, (SELECT COUNT(*) FROM r) - COALESCE(c.n, 0) AS n FROM elements e LEFT JOIN c ON c.src = e.key WHERE e.key LIKE 'supplier/%'")  # fmt: skip
def unsatisfied_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many requirements each supplier doesn't satisfy: all less the satisfied ones, for the pairs would be too many."""
    g = _graph(spark, sf_dir)
    required = g.elements.filter("kind = 'requirement'").select(F.col("key").alias("dst"))
    # edges of a label are distinct, so a semi-join's rows are counted as they are
    satisfied = g.labelled("satisfies").join(required, "dst", "left_semi").groupBy(F.col("src").alias("root")).agg(F.count(F.lit(1)).alias("satisfied"))
    every = F.broadcast(required.agg(F.count(F.lit(1)).alias("all")))  # one row
    return _roots(g, "supplier/").join(satisfied, "root", "left").crossJoin(every).select(F.col("root").alias("supplier"), (F.col("all") - F.coalesce("satisfied", F.lit(0))).alias("n"))


@query("WITH {graph} SELECT kind, SUM(CASE WHEN owner IS NULL THEN 1 ELSE 0 END) AS roots, SUM(CASE WHEN owner IS NOT NULL THEN 1 ELSE 0 END) AS owned FROM elements GROUP BY kind")
def kind_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return g.elements.groupBy("kind").agg(F.count_if(F.col("owner").isNull()).alias("roots"), F.count_if(F.col("owner").isNotNull()).alias("owned"))


@query("WITH {graph} SELECT label, COUNT(*) AS n FROM edges GROUP BY label")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _graph(spark, sf_dir).edges.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("WITH {graph} SELECT * FROM (VALUES ('owns'), ('typedBy'), ('subsets'), ('redefines'), ('satisfies')) v(label) WHERE label NOT IN (SELECT label FROM edges)")
def empty_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    known = spark.createDataFrame([(x,) for x in (*COMPOSITION, "satisfies")], "label string")
    return known.join(g.edges.select("label").distinct(), "label", "left_anti")


@query("WITH {graph} SELECT attribute, COUNT(*) AS n, COUNT(DISTINCT unit) AS units, MIN(num) AS least, MAX(num) AS most FROM elements WHERE attribute IS NOT NULL GROUP BY attribute")
def attribute_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return g.elements.filter("attribute is not null").groupBy("attribute").agg(F.count(F.lit(1)).alias("n"), F.size(F.collect_set("unit")).cast("long").alias("units"), F.min("num").alias("least"), F.max("num").alias("most"))


@query("WITH {graph} SELECT key, name, num FROM elements WHERE num IS NOT NULL AND unit = 'eur' ORDER BY num DESC, key LIMIT 5")
def extreme_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    return g.elements.filter("unit = 'eur' and num is not null").orderBy(F.desc("num"), "key").select("key", "name", "num").limit(5)


@query("WITH {graph}, f AS (SELECT key AS owner, 'total' AS field, 'sum of ' || name || ' Customer#' || RIGHT('000000000' || CAST(substr(key, 8) AS VARCHAR), 9) AS expression FROM elements WHERE key LIKE 'nation/%')"
       " SELECT f.owner, f.field, " + TOTAL.format(c="s.num") + " AS total, COUNT(*) AS n FROM f JOIN elements s ON s.owner = f.owner AND strpos(f.expression, s.name) > 0 GROUP BY 1, 2")  # fmt: skip
def formula_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    expression = F.concat(F.lit("sum of "), "name", F.lit(" Customer#"), F.lpad(F.substring("key", 8, 9), 9, "0"))
    formulas = g.elements.filter(F.col("key").startswith("nation/")).select(F.col("key").alias("owner"), F.lit("total").alias("field"), expression.alias("expression"))
    return rollup.formula_siblings(formulas, g.elements.filter("owner is not null").select("owner", "name", "num"))


@query("WITH {graph} SELECT owner AS root, unit, " + TOTAL.format(c="num") + " AS total, COUNT(*) AS parts, MAX(num) AS largest FROM elements WHERE owner LIKE 'nation/%' AND num IS NOT NULL GROUP BY 1, 2")
def total_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    rows = g.elements.filter(F.col("owner").startswith("nation/") & F.col("num").isNotNull())
    return rows.groupBy(F.col("owner").alias("root"), "unit").agg(rollup.exact_sum("num").alias("total"), F.count(F.lit(1)).alias("parts"), F.max("num").alias("largest"))


@query("WITH RECURSIVE {graph}, walk AS (SELECT key AS root, key AS node FROM elements WHERE key LIKE 'region/%' UNION SELECT w.root, e.dst FROM walk w JOIN edges e ON e.src = w.node AND e.label = 'owns'), c AS (SELECT root, attribute, COUNT(*) AS n FROM walk JOIN elements ON key = node WHERE attribute IS NOT NULL GROUP BY 1, 2)"
       " SELECT root, attribute, n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY root ORDER BY n DESC, attribute) AS r FROM c) WHERE r = 1")  # fmt: skip
def top_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    attributes = g.elements.filter("attribute is not null").select(F.col("key").alias("node"), "attribute")
    return rollup.top_attribute(traverse.walk(_roots(g), g.labelled("owns")), attributes)


@query("SELECT l_orderkey AS src, l_partkey AS dst, MIN(l_linenumber) AS line FROM lineitem WHERE l_orderkey <> l_partkey GROUP BY 1, 2", False)
def edges_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.lit("uses").alias("label"), F.col("l_linenumber").alias("line"))
    return rollup.first_wins(line, ["line"]).select("src", "dst", "line")


@query("SELECT n_name AS name, CASE WHEN s <> '' THEN s || '_' ELSE '_' END || substr(sha1(n_name || '::' || n_nationkey), 1, 10) AS key FROM (SELECT *, trim(regexp_replace(n_name || '::' || n_nationkey, '[^A-Za-z0-9_-]+', '_', 'g'), '_') AS s FROM nation)", False)
def element_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    identity = F.concat("n_name", F.lit("::"), F.col("n_nationkey").cast("string"))
    return _read(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), names.key_of(identity).alias("key"))


@query("""WITH e AS (SELECT 'n' || n_nationkey AS key, r_name AS module, r_name || '::' || n_name AS qualified, n_name AS s1 FROM nation JOIN region ON r_regionkey = n_regionkey
 UNION ALL SELECT 'c' || c_custkey, r_name, r_name || '::' || n_name || '::' || c_mktsegment, c_mktsegment FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
 s AS (SELECT key, module, qualified, 1 AS d, s1 AS suffix FROM e UNION ALL SELECT key, module, qualified, 2, array_to_string(list_slice(string_split(qualified, '::'), greatest(len(string_split(qualified, '::')) - 1, 1), len(string_split(qualified, '::'))), '_') FROM e
  UNION ALL SELECT key, module, qualified, 3, replace(qualified, '::', '_') FROM e),
 u AS (SELECT *, COUNT(*) OVER (PARTITION BY module, d, suffix) AS n FROM s), b AS (SELECT key, arg_min(suffix, d) AS lone FROM u WHERE n = 1 GROUP BY key),
 r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY module, qualified ORDER BY key) AS k FROM e)
 SELECT r.key, COALESCE(lone, replace(qualified, '::', '_') || CASE WHEN k = 1 THEN '' ELSE '_' || k END) AS display FROM r LEFT JOIN b USING (key)""", False)  # fmt: skip
def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    path = F.concat("r_name", F.lit("::"), "n_name")
    nations = n.select(F.concat(F.lit("n"), "n_nationkey").alias("key"), F.col("r_name").alias("module"), path.alias("qualified"))
    c = _read(spark, sf_dir, "customer").join(n, F.col("n_nationkey") == F.col("c_nationkey"))
    customers = c.select(F.concat(F.lit("c"), "c_custkey").alias("key"), F.col("r_name").alias("module"), F.concat(path, F.lit("::"), "c_mktsegment").alias("qualified"))
    return names.display_names(nations.unionByName(customers), depth=3).select("key", "display")


@query("SELECT 'n' || n_nationkey AS key, CASE WHEN n_name = 'NATION_7' THEN 1 WHEN upper(n_name) = upper('NATION_7') THEN 2 ELSE 5 END AS rung FROM nation WHERE upper(n_name) LIKE '%NATION\\_7%' ESCAPE '\\' ORDER BY rung, length(n_name), key LIMIT 1", False)
def name_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("key"), F.col("n_name").alias("name"), F.upper("n_name").alias("display"), F.lit(None).cast("string").alias("short_name"), F.lit(1).alias("depth"))
    return names.resolve_name(n, "NATION_7").select("key", "rung")


@query("""WITH e AS (SELECT 'n' || n_nationkey AS key, n_name AS name, upper(n_name) AS display, 'N-' || n_nationkey AS short_name, 1 AS depth, n_nationkey AS k FROM nation
 UNION ALL SELECT 'c' || c_custkey, c_name, upper(c_name) || '_' || c_mktsegment, 'C-' || c_custkey, 2, c_custkey FROM customer),
 w AS (SELECT DISTINCT CASE k % 6 WHEN 0 THEN name WHEN 1 THEN lower(display) WHEN 2 THEN replace(lower(display), '_', ' ') WHEN 3 THEN lower(short_name) WHEN 4 THEN substr(display, 4) ELSE substr(name, 2, 12) || '?' END AS written FROM e),
 r AS (SELECT written, key, depth, length(display) AS l, CASE WHEN name = written THEN 1 WHEN display = upper(written) THEN 2 WHEN display = replace(upper(written), ' ', '_') THEN 3 WHEN lower(short_name) = lower(written) THEN 4 WHEN contains(display, upper(written)) THEN 5 END AS rung FROM w, e)
 SELECT written, key, rung FROM r WHERE rung IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY written ORDER BY rung, CASE WHEN rung = 5 THEN l ELSE 0 END, depth, key) = 1""", False)  # fmt: skip
def names_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of all nations and customers, written in six ways, the last of which means nothing."""
    k = F.col("k").cast("string")
    n = _read(spark, sf_dir, "nation").select(F.lit("n").alias("kind"), F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name"), F.upper("n_name").alias("display"), F.lit("N-").alias("s"), F.lit(1).alias("depth"))
    c = _read(spark, sf_dir, "customer").select(F.lit("c").alias("kind"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.concat(F.upper("c_name"), F.lit("_"), "c_mktsegment").alias("display"), F.lit("C-").alias("s"), F.lit(2).alias("depth"))
    e = n.unionByName(c).withColumns({"key": F.concat("kind", k), "short_name": F.concat("s", k)})
    way = F.col("k") % 6
    written = (
        F.when(way == 0, F.col("name")).when(way == 1, F.lower("display")).when(way == 2, F.replace(F.lower("display"), F.lit("_"), F.lit(" "))).when(way == 3, F.lower("short_name"))
        .when(way == 4, F.substring("display", 4, 1000)).otherwise(F.concat(F.substring("name", 2, 12), F.lit("?")))
    )
    return names.resolve_names(e, e.select(written.alias("written"))).select("written", "key", "rung")


@query("WITH a AS (SELECT 's' || s_suppkey AS entity, n_name AS name FROM supplier JOIN nation ON n_nationkey = s_nationkey), d AS (SELECT 'n' || n_nationkey AS key, n_name AS name FROM nation UNION ALL SELECT 'r' || r_regionkey, r_name FROM region),"
       " o AS (SELECT regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS alias, MIN(key) AS key FROM d GROUP BY 1 HAVING COUNT(DISTINCT key) = 1) SELECT entity, key FROM a JOIN o ON alias = regexp_replace(lower(name), '[^a-z0-9]', '', 'g')", False)  # fmt: skip
def unique_alias_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, one = _read(spark, sf_dir, "nation"), F.lit("m").alias("module")
    entities = _read(spark, sf_dir, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey")).select(F.concat(F.lit("s"), "s_suppkey").alias("entity"), one, F.col("n_name").alias("name"))
    stated = nation.select(F.concat(F.lit("n"), "n_nationkey").alias("key"), one, F.col("n_name").alias("name")).unionByName(_read(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("key"), one, F.col("r_name").alias("name")))
    return names.unique_aliases(entities, stated)


@query("WITH {graph}, i AS (SELECT DISTINCT 'order/' || o_orderkey AS src, 'customer/' || o_custkey AS dst, 'RELATED' AS label FROM orders UNION ALL SELECT DISTINCT 'supplier/' || l_suppkey, 'part/' || l_partkey, 'MAKES' FROM lineitem UNION ALL SELECT key, key, 'RELATED' FROM elements WHERE kind = 'package' UNION ALL SELECT key, 'x', 'Owns' FROM elements WHERE kind = 'package')"
       " SELECT label, COUNT(*) AS n FROM i WHERE lower(label) NOT IN ('owns') AND src <> dst AND NOT EXISTS (SELECT 1 FROM edges e WHERE (e.src = i.src AND e.dst = i.dst) OR (e.src = i.dst AND e.dst = i.src)) GROUP BY label")  # fmt: skip
def prune_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    lit = F.lit
    inferred = (
        _read(spark, sf_dir, "orders").select(F.concat(lit("order/"), "o_orderkey").alias("src"), F.concat(lit("customer/"), "o_custkey").alias("dst"), lit("RELATED").alias("label")).distinct()
        .unionByName(_read(spark, sf_dir, "lineitem").select(F.concat(lit("supplier/"), "l_suppkey").alias("src"), F.concat(lit("part/"), "l_partkey").alias("dst"), lit("MAKES").alias("label")).distinct())
        .unionByName(g.elements.filter("kind = 'package'").select(F.col("key").alias("src"), F.col("key").alias("dst"), lit("RELATED").alias("label")))
        .unionByName(g.elements.filter("kind = 'package'").select(F.col("key").alias("src"), lit("x").alias("dst"), lit("Owns").alias("label")))
    )
    return mutate.prune(inferred, g.edges, ["owns"]).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN 'renamed' ELSE c_name END AS name FROM customer UNION ALL SELECT -1, 'new'", False)
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    new = old.filter("key % 3 = 0").select("key", F.lit("renamed").alias("name")).unionByName(spark.createDataFrame([(-1, "new")], "key long, name string"))
    return mutate.upsert(old, new)


@query("SELECT c_custkey AS key, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN 'vip' ELSE c_mktsegment END AS segment FROM customer", False)
def update_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return mutate.update(old, old.filter("key % 5 = 0").select("key", F.lit("vip").alias("segment")))


@query("SELECT src, dst, COUNT(*) AS n FROM (SELECT lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS src, event_type AS dst FROM events) WHERE src IS NOT NULL GROUP BY src, dst", False)
def transition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transitions(_read(spark, sf_dir, "events")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, length(text) - length(replace(text, chr(10), '')) + 1 AS lines, length(text) AS characters, length(substr(text, 1, 4800)) AS head FROM documents", False)
def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents")
    return d.select("doc_id", scalar.lines(F.col("text")).cast("long").alias("lines"), F.length("text").cast("long").alias("characters"), F.length(F.substring("text", 1, 4800)).cast("long").alias("head"))


@query("WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id = 0) SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), x), 6) AS score FROM embeddings, q WHERE vec_id <> 0 ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), x) DESC, vec_id LIMIT 10", False)
def cosine_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    first = rows.filter("vec_id = 0").select("embedding").head()
    return search.cosine_top(rows.filter("vec_id <> 0"), first[0] if first else [0.0], 10).select("vec_id", F.round("score", 6).alias("score"))


@query(BM25_SQL + "SELECT doc_id, round(score, 6) AS score FROM r WHERE score > 0 ORDER BY r.score DESC, doc_id LIMIT 10", False)
def bm25_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.bm25(_read(spark, sf_dir, "documents"), ["the", "thing"], 10).select("doc_id", F.round("score", 6).alias("score"))


@query(BM25_SQL + ", a AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY score DESC, doc_id) AS k FROM r WHERE score > 0), b AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY n_chars DESC, doc_id) AS k FROM documents), u AS (SELECT * FROM a WHERE k <= 20 UNION ALL SELECT * FROM b WHERE k <= 20)"
       " SELECT doc_id, round(SUM(1.0 / (60 + k)), 8) AS rrf FROM u GROUP BY doc_id ORDER BY SUM(CAST(1.0 AS DOUBLE) / (60 + k)) DESC, doc_id LIMIT 10", False)  # fmt: skip
def rank_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    longest = docs.select("doc_id", F.col("n_chars").cast("double").alias("score")).orderBy(F.desc("score"), "doc_id").limit(20)
    return search.fuse([search.bm25(docs, ["the", "thing"], 20), longest], 10).select("doc_id", F.round("rrf", 8).alias("rrf"))


@query("""WITH r AS (SELECT vec_id AS key, vec_id % 2 AS model, label AS role, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), m AS (SELECT model FROM r GROUP BY model ORDER BY COUNT(*) DESC, model LIMIT 1),
 p AS (SELECT a.key AS src, b.key AS dst, list_cosine_similarity(a.x, b.x) AS score FROM r a JOIN r b ON a.role = b.role AND a.model <> b.model WHERE a.model NOT IN (SELECT model FROM m)),
 k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY src ORDER BY score DESC, dst) AS n FROM p WHERE score >= 0.3)
 SELECT least(src, dst) AS src, greatest(src, dst) AS dst, round(MAX(score), 6) AS score FROM k WHERE n <= 5 GROUP BY 1, 2""", False)  # fmt: skip
def analogy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A floor that these tables' vectors reach; the operator's own is 0.55."""
    rows = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("key"), (F.col("vec_id") % 2).alias("model"), F.col("label").alias("role"), "embedding")
    return search.reciprocal_once(search.analogies(rows, 0.3, 5)).select("src", "dst", F.round("score", 6).alias("score"))


@query(None)
def analogy_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy, so without SQL; tested against a plain loop. The floor is one that these vectors reach."""
    rows = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("key"), (F.col("vec_id") % 2).alias("model"), F.col("label").alias("role"), "embedding")
    return search.greedy(search.analogies(rows, 0.3)).select("src", "dst", F.round("score", 6).alias("score"))


@query("WITH x AS (SELECT c_nationkey AS node, c_mktsegment AS value FROM customer) SELECT node, string_agg(DISTINCT value, ',' ORDER BY value) AS files FROM x GROUP BY node", False)
def provenance_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    links, chunks = c.select(F.col("c_nationkey").alias("node"), F.col("c_custkey").alias("chunk")), c.select(F.col("c_custkey").alias("chunk"), F.col("c_mktsegment").alias("value"))
    return mutate.stamp(chunks, links, "files").select("node", F.array_join("files", ",").alias("files"))


@query("SELECT upper(p_type) AS upper, lower(p_brand) AS lower, substr(p_name, 3, 4) AS part, contains(p_name, 'a') AS has, length(p_name) AS n, replace(p_name, ' ', '_') AS joined, string_split(p_type, ' ')[1] AS head, COUNT(*) AS k FROM part GROUP BY ALL", False)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    rows = p.select(
        F.upper("p_type").alias("upper"), F.lower("p_brand").alias("lower"), scalar.substring(F.col("p_name"), 2, 4).alias("part"), F.contains("p_name", F.lit("a")).alias("has"),
        F.length("p_name").cast("long").alias("n"), scalar.substitute(F.col("p_name"), " ", "_").alias("joined"), scalar.split_part(F.col("p_type"), " ", 0).alias("head"),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("k"))


@query("SELECT o_custkey AS src, o_orderkey AS dst, o_totalprice AS value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1", False)
def first_of_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    best = o.groupBy("o_custkey").agg(F.min(F.struct((-F.col("o_totalprice")).alias("v"), "o_orderkey")).alias("x"))
    return best.select(F.col("o_custkey").alias("src"), F.col("x.o_orderkey").alias("dst"), (-F.col("x.v")).alias("value"))


def _nation_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model file for each region, written from the tables: a definition, a part of it for each nation with its key as a quantity, and a dependency on the region's first nation."""
    n, r = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    key = F.col("n_nationkey").cast("string")
    part = F.concat(F.lit("  part n"), key, F.lit(" : Nation { attribute code = "), key, F.lit(" [kg]; doc /* "), "n_name", F.lit(" */ }\n"))
    body = n.groupBy("n_regionkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", part.alias("t")))), lambda x: x["t"]), "").alias("body"), F.min("n_nationkey").alias("least"))
    text = F.concat(F.lit("package '"), "r_name", F.lit("' {\n  abstract part def Nation;\n"), "body", F.lit("  dependency D to n"), F.col("least").cast("string"), F.lit(";\n  part def D :> Nation;\n}\n"))
    return body.join(r, body["n_regionkey"] == r["r_regionkey"]).select(F.concat(F.lit("m"), F.col("r_regionkey").cast("string"), F.lit("/model.sysml")).alias("path"), text.alias("text"))


@query("""WITH n AS (SELECT 'm' || r_regionkey AS module, r_name, n_nationkey AS k, n_name FROM nation JOIN region ON n_regionkey = r_regionkey), m AS (SELECT DISTINCT module, r_name FROM n)
 SELECT module, r_name AS qualified, 'package' AS kind, false AS is_definition, CAST(NULL AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS VARCHAR) AS doc FROM m
 UNION ALL SELECT module, r_name || '::Nation', 'part', true, NULL, NULL, NULL FROM m UNION ALL SELECT module, r_name || '::D', 'part', true, NULL, NULL, NULL FROM m
 UNION ALL SELECT module, r_name || '::dependency@' || (3 + COUNT(*)), 'dependency', false, NULL, NULL, NULL FROM n GROUP BY module, r_name
 UNION ALL SELECT module, r_name || '::n' || k, 'part', false, NULL, NULL, n_name FROM n
 UNION ALL SELECT module, r_name || '::n' || k || '::code', 'attribute', false, k, 'kg', NULL FROM n""", False)
def notation_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = notation.elements(notation.declarations(_nation_sources(spark, sf_dir)))
    return found.select("module", "qualified", "kind", "is_definition", "value.num", "value.unit", "doc")


@query("""WITH n AS (SELECT 'm' || r_regionkey AS module, 'm' || r_regionkey || '::' || r_name AS top, n_nationkey AS k FROM nation JOIN region ON n_regionkey = r_regionkey), m AS (SELECT module, top, MIN(k) AS k, COUNT(*) AS c FROM n GROUP BY ALL)
 SELECT top AS src, 'owns' AS label, top || '::n' || k AS dst FROM n UNION ALL SELECT top || '::n' || k, 'owns', top || '::n' || k || '::code' FROM n UNION ALL SELECT top || '::n' || k, 'typedBy', top || '::Nation' FROM n
 UNION ALL SELECT top, 'owns', top || '::Nation' FROM m UNION ALL SELECT top, 'owns', top || '::D' FROM m UNION ALL SELECT top, 'owns', top || '::dependency@' || (3 + c) FROM m
 UNION ALL SELECT top || '::D', 'specializes', top || '::Nation' FROM m UNION ALL SELECT top || '::D', 'dependsOn', top || '::n' || k FROM m""", False)
def notation_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notation.edges(notation.relations(notation.declarations(_nation_sources(spark, sf_dir)))).select("src", "label", "dst")


@query("SELECT 'm' || n_regionkey || '::' || r_name || '::n' || n_nationkey AS owner, CAST(n_nationkey AS DOUBLE) AS num, 'kg' AS unit FROM nation JOIN region ON n_regionkey = r_regionkey", False)
def notation_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = notation.attributes(notation.elements(notation.declarations(_nation_sources(spark, sf_dir))))
    return found.select("owner", F.col("attributes")["code"]["num"].alias("num"), F.col("attributes")["code"]["unit"].alias("unit"))


from grapheon import queries_more, queries_survey  # noqa: E402, F401  they register their queries here
