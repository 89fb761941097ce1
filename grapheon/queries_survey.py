"""The survey's probes over a model graph of the driver's tables, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grapheon.functions.scalar import lines
from grapheon.plans import survey
from grapheon.registry import _read, query
from grapheon.streaming.transitions import transitions

LABELS = ("owns", "typedBy", "satisfies", "verifies", "transitionsTo", "connectedTo", "subsets", "redefines", "specializes")

SQL = """rn AS (SELECT n_nationkey, n_name, r_regionkey, r_name FROM nation JOIN region ON r_regionkey = n_regionkey),
 el AS (SELECT 'region/' || r_regionkey AS key, r_name AS module, 'package' AS kind, false AS is_definition, r_name AS name, CAST(NULL AS VARCHAR) AS short_name, r_name AS display, CAST(NULL AS VARCHAR) AS owner, CAST(NULL AS VARCHAR) AS multiplicity, CAST(NULL AS VARCHAR) AS expression FROM region
  UNION ALL SELECT 'nation/' || n_nationkey, r_name, 'package', false, n_name, 'N' || n_nationkey, n_name, 'region/' || r_regionkey, NULL, NULL FROM rn
  UNION ALL SELECT 'limit/' || n_nationkey, r_name, 'constraint', false, NULL, NULL, 'constraint@' || n_nationkey, 'nation/' || n_nationkey, NULL, 'ISQ::mass <= ' || n_nationkey || '.5' FROM rn
  UNION ALL SELECT 'customer/' || c_custkey, r_name, 'part', false, c_name, NULL, CASE WHEN c_mktsegment = 'BUILDING' THEN n_name || '_' || c_name ELSE c_name END, 'nation/' || c_nationkey, CAST(c_custkey % 4 AS VARCHAR), NULL FROM customer JOIN rn ON n_nationkey = c_nationkey
  UNION ALL SELECT 'part/' || p_partkey, p_brand, 'part', true, p_name, NULL, p_name, NULL, NULL, NULL FROM part
  UNION ALL SELECT 'order/' || o_orderkey, 'orders', 'requirement', o_orderkey % 2 = 0, 'Order/' || o_orderkey, NULL, 'Order/' || o_orderkey, 'customer/' || o_custkey, NULL, NULL FROM orders),
 av AS (SELECT 'customer/' || c_custkey AS key, 'acctbal' AS attribute, c_acctbal AS num, 'usd' AS unit, CAST(NULL AS VARCHAR) AS expression FROM customer
  UNION ALL SELECT 'part/' || p_partkey, 'retailprice', p_retailprice, 'eur', NULL FROM part UNION ALL SELECT 'part/' || p_partkey, 'size', p_size, CASE WHEN p_size % 2 = 0 THEN 'mm' END, NULL FROM part
  UNION ALL SELECT 'part/' || p_partkey, 'cost', NULL, NULL, 'retailprice * ' || p_size FROM part),
 tr AS (SELECT DISTINCT src, dst FROM (SELECT lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS src, event_type AS dst FROM events) WHERE src IS NOT NULL),
 ed AS (SELECT owner AS src, key AS dst, 'owns' AS label, CAST(NULL AS VARCHAR) AS trigger, CAST(NULL AS VARCHAR) AS guard, CAST(NULL AS VARCHAR) AS through FROM el WHERE owner IS NOT NULL
  UNION ALL SELECT DISTINCT 'order/' || l_orderkey, 'part/' || l_partkey, 'typedBy', NULL, NULL, NULL FROM lineitem
  UNION ALL SELECT DISTINCT 'supplier/' || l_suppkey, 'order/' || l_orderkey, 'satisfies', NULL, NULL, NULL FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT DISTINCT 'supplier/' || l_suppkey, 'order/' || l_orderkey, 'verifies', NULL, NULL, NULL FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'A'
  UNION ALL SELECT src, dst, 'transitionsTo', CASE WHEN dst <> 'error' THEN 'on_' || dst END, CASE WHEN src = dst THEN 'again' END, NULL FROM tr
  UNION ALL SELECT 'supplier/' || s_suppkey, 'customer/' || c_custkey, 'connectedTo', NULL, NULL, 'nation/' || s_nationkey FROM supplier JOIN customer ON c_custkey = s_suppkey AND c_nationkey = s_nationkey),
 so AS (SELECT source || '/' || doc_id AS path, source AS module, length(text) - length(replace(text, chr(10), '')) + 1 AS lines, length(text) AS characters FROM documents),
 en AS (SELECT 's' || s_suppkey AS key, CASE WHEN s_acctbal < 0 THEN 'debtor' ELSE 'creditor' END AS type, 'customer/' || c_custkey AS element FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey AND c_nationkey = s_nationkey),
 inf AS (SELECT 's' || l_suppkey AS src, 'p' || l_partkey AS dst, l_returnflag AS type FROM lineitem)"""
WITH = "WITH RECURSIVE " + SQL + " "


def model(spark: SparkSession, sf_dir: str) -> survey.Model:
    """Regions own nations, nations own limits and customers, customers own orders; parts are definitions of their brand's module."""
    read = lambda t: _read(spark, sf_dir, t)
    text = lambda c: F.lit(c).cast("string")
    key = lambda kind, c: F.concat(F.lit(kind + "/"), F.col(c).cast("string"))
    value = "map<string, struct<num: double, unit: string, expression: string>>"
    of = lambda num, unit, expression=None: F.struct((F.col(num) if num else F.lit(None)).cast("double").alias("num"), unit.cast("string").alias("unit"), (expression if expression is not None else F.lit(None)).cast("string").alias("expression"))
    rn = read("nation").join(read("region"), F.col("r_regionkey") == F.col("n_regionkey"))

    def rows(df: DataFrame, **columns) -> DataFrame:
        blank = {"short_name": text(None), "owner": text(None), "multiplicity": text(None), "expression": text(None), "is_definition": F.lit(False), "modifiers": F.array().cast("array<string>"), "refs": F.array().cast("array<string>"), "attributes": F.create_map().cast(value)}
        blank |= columns
        order = ("key", "module", "kind", "is_definition", "name", "short_name", "display", "owner", "multiplicity", "modifiers", "expression", "refs", "attributes")
        return df.select(*((blank[c] if not isinstance(blank[c], str) else F.lit(blank[c])).alias(c) for c in order))

    n_name, c_name = F.col("n_name"), F.col("c_name")
    order_name = F.concat(F.lit("Order/"), F.col("o_orderkey").cast("string"))
    parts = [
        rows(read("region"), key=key("region", "r_regionkey"), module=F.col("r_name"), kind="package", name=F.col("r_name"), display=F.col("r_name")),
        rows(rn, key=key("nation", "n_nationkey"), module=F.col("r_name"), kind="package", name=n_name, short_name=F.concat(F.lit("N"), F.col("n_nationkey").cast("string")), display=n_name, owner=key("region", "r_regionkey"), refs=F.array(F.concat(F.lit("ScalarValues::"), "r_name"), F.concat("r_name", F.lit("::x")))),
        rows(rn, key=key("limit", "n_nationkey"), module=F.col("r_name"), kind="constraint", name=text(None), display=F.concat(F.lit("constraint@"), F.col("n_nationkey").cast("string")), owner=key("nation", "n_nationkey"), expression=F.concat(F.lit("ISQ::mass <= "), F.col("n_nationkey").cast("string"), F.lit(".5"))),
        rows(
            read("customer").join(rn, F.col("n_nationkey") == F.col("c_nationkey")), key=key("customer", "c_custkey"), module=F.col("r_name"), kind="part", name=c_name, owner=key("nation", "c_nationkey"),
            display=F.when(F.col("c_mktsegment") == "BUILDING", F.concat(n_name, F.lit("_"), c_name)).otherwise(c_name), multiplicity=(F.col("c_custkey") % 4).cast("string"),
            modifiers=F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("abstract"), F.lit("ref"))).otherwise(F.array(F.lit("ref"))), attributes=F.create_map(F.lit("acctbal"), of("c_acctbal", F.lit("usd"))),
        ),
        rows(
            read("part"), key=key("part", "p_partkey"), module=F.col("p_brand"), kind="part", is_definition=F.lit(True), name=F.col("p_name"), display=F.col("p_name"),
            attributes=F.create_map(F.lit("retailprice"), of("p_retailprice", F.lit("eur")), F.lit("size"), of("p_size", F.when(F.col("p_size") % 2 == 0, "mm")), F.lit("cost"), of(None, F.lit(None), F.concat(F.lit("retailprice * "), F.col("p_size").cast("string")))),
        ),
        rows(read("orders"), key=key("order", "o_orderkey"), module="orders", kind="requirement", is_definition=F.col("o_orderkey") % 2 == 0, name=order_name, display=order_name, owner=key("customer", "o_custkey")),
    ]
    elements = parts[0]
    for p in parts[1:]:
        elements = elements.unionByName(p)

    def edge(df: DataFrame, src, dst, label: str, trigger=None, guard=None, through=None) -> DataFrame:
        given = [("src", src), ("dst", dst), ("label", F.lit(label)), ("trigger", trigger), ("guard", guard), ("through", through)]
        return df.select(*((text(None) if c is None else c).alias(n) for n, c in given))

    line, supplier = read("lineitem"), read("supplier")
    order, made = key("order", "l_orderkey"), key("supplier", "l_suppkey")
    pairs = transitions(read("events")).select("src", "dst").distinct()
    met = supplier.join(read("customer"), (F.col("c_custkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")), "left")
    edges = (
        edge(elements.filter("owner is not null"), F.col("owner"), F.col("key"), "owns")
        .unionByName(edge(line, order, key("part", "l_partkey"), "typedBy").distinct())
        .unionByName(edge(line.filter("l_returnflag = 'R'"), made, order, "satisfies").distinct())
        .unionByName(edge(line.filter("l_linestatus = 'F' and l_returnflag = 'A'"), made, order, "verifies").distinct())
        .unionByName(edge(pairs, F.col("src"), F.col("dst"), "transitionsTo", F.when(F.col("dst") != "error", F.concat(F.lit("on_"), "dst")), F.when(F.col("src") == F.col("dst"), "again")))
        .unionByName(edge(met.filter("c_custkey is not null"), key("supplier", "s_suppkey"), key("customer", "c_custkey"), "connectedTo", through=key("nation", "s_nationkey")))
    )
    sources = read("documents").select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"), F.col("source").alias("module"), lines(F.col("text")).cast("long").alias("lines"), F.length("text").cast("long").alias("characters"))
    entities = met.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("key"), F.when(F.col("s_acctbal") < 0, "debtor").otherwise("creditor").alias("type"), F.when(F.col("c_custkey").isNotNull(), key("customer", "c_custkey")).alias("element"))
    inferred = line.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"), F.col("l_returnflag").alias("type"))
    return survey.Model(elements, edges, sources, entities, inferred, spark.createDataFrame([(x,) for x in LABELS], "label string"))


SHOWN = f"LIMIT {survey.SHOWN}"
PROBE_SQL = {
    "sizes": "SELECT 'elements' AS collection, COUNT(*) AS n FROM el UNION ALL SELECT 'edges', COUNT(*) FROM ed UNION ALL SELECT 'sources', COUNT(*) FROM so UNION ALL SELECT 'entities', COUNT(*) FROM en UNION ALL SELECT 'inferred', COUNT(*) FROM inf",
    "modules": "SELECT module, elements, COALESCE(relations, 0) AS relations FROM (SELECT module, COUNT(*) AS elements FROM el GROUP BY 1) LEFT JOIN (SELECT module, COUNT(*) AS relations FROM ed JOIN el ON el.key = ed.src GROUP BY 1) USING (module)",
    "kinds": "SELECT kind, COUNT(*) FILTER (is_definition) AS definitions, COUNT(*) FILTER (NOT is_definition) AS usages FROM el GROUP BY 1",
    "attributes": "SELECT attribute, COUNT(*) AS n, COUNT(num) AS numeric, COALESCE(string_agg(DISTINCT unit, ',' ORDER BY unit), '') AS units, arg_min_null(num, key) AS example FROM av GROUP BY 1",
    "formulas": "SELECT key, attribute, expression FROM av WHERE expression IS NOT NULL",
    "labels": "SELECT label, COUNT(*) AS n FROM ed GROUP BY 1",
    "empty_labels": "SELECT * FROM (VALUES " + ", ".join(f"('{x}')" for x in LABELS) + ") v(label) WHERE label NOT IN (SELECT label FROM ed)",
    "disambiguated": "SELECT COUNT(*) AS n FROM el WHERE name IS NOT NULL AND display <> name",
    "disambiguated_sample": f"SELECT key, name, display FROM el WHERE name IS NOT NULL AND display <> name ORDER BY key {SHOWN}",
    "short_names": f"SELECT short_name, key FROM el WHERE short_name IS NOT NULL ORDER BY 1, 2 {SHOWN}",
    "roots": "SELECT root, COUNT(DISTINCT node) AS size FROM walk WHERE node <> root GROUP BY 1 ORDER BY 2 DESC, 1 " + SHOWN,
    "most_numeric": f"SELECT key, COUNT(*) AS n FROM av WHERE num IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 {SHOWN}",
    "constraints": "SELECT key, expression, CAST(regexp_extract(expression, '([0-9.]+)$', 1) AS DOUBLE) AS bound FROM el WHERE kind = 'constraint'",
    "multiplicities": "SELECT multiplicity, COUNT(*) AS n FROM el WHERE multiplicity IS NOT NULL GROUP BY 1",
    "modifiers": "SELECT 'ref' AS modifier, COUNT(*) AS n FROM customer UNION ALL SELECT 'abstract', COUNT(*) FROM customer WHERE c_custkey % 2 = 0",
    "triggered": "SELECT src, dst, trigger, guard FROM ed WHERE label = 'transitionsTo' AND trigger IS NOT NULL",
    "connections": "SELECT src, dst, through FROM ed WHERE label = 'connectedTo'",
    "coverage": "SELECT COUNT(*) AS n, COUNT(*) FILTER (is_definition) AS definitions, COUNT(*) FILTER (s) AS satisfied, COUNT(*) FILTER (v) AS verified, COUNT(*) FILTER (NOT s AND NOT v) AS open FROM (SELECT is_definition, key IN (SELECT dst FROM ed WHERE label = 'satisfies') AS s, key IN (SELECT dst FROM ed WHERE label = 'verifies') AS v FROM el WHERE kind = 'requirement')",
    "one_element": "SELECT key, module, kind, is_definition, name, short_name, display, owner, multiplicity FROM el ORDER BY key LIMIT 1",
    "one_edge": "SELECT src, dst, label, through FROM ed ORDER BY label, src, dst LIMIT 1",
    "external": "SELECT namespace, COUNT(*) AS n FROM (SELECT 'ISQ' AS namespace FROM rn UNION ALL SELECT 'ScalarValues' FROM rn UNION ALL SELECT r_name FROM rn) WHERE namespace NOT IN (SELECT name FROM el WHERE name IS NOT NULL) GROUP BY 1",
    "inferred_types": "SELECT 'entity' AS what, type, COUNT(*) AS n FROM en GROUP BY 2 UNION ALL SELECT 'relationship', type, COUNT(*) FROM inf GROUP BY 2",
    "link_coverage": "SELECT COUNT(*) AS entities, COUNT(element) AS linked, COUNT(DISTINCT element) AS elements FROM en",
    "layers": "SELECT module, COUNT(*) AS files, CAST(SUM(lines) AS BIGINT) AS lines, CAST(SUM(characters) AS BIGINT) AS characters FROM so GROUP BY 1",
}


def _register(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return survey.PROBES[name](model(spark, sf_dir))

    run.__name__ = f"survey_{name}"
    walk = ", walk AS (SELECT key AS root, key AS node FROM el WHERE owner IS NULL AND kind = 'package' UNION SELECT w.root, e.key FROM walk w JOIN el e ON e.owner = w.node) " if name == "roots" else " "
    query("WITH RECURSIVE " + SQL + walk + PROBE_SQL[name], False)(run)


for _name in survey.PROBES:
    _register(_name)
