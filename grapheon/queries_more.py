"""Queries of retrieval, functions, change and the remaining operators, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grapheon.functions import scalar
from grapheon.operators import mutate, retrieve, rollup, search, traverse
from grapheon.plans import binds, guard, validate
from grapheon.plans.lineage import cut
from grapheon.registry import BM25_SQL, TOTAL, _graph, _read, query
from grapheon.queries_survey import SQL as SURVEY_SQL
from grapheon.queries_survey import model
from grapheon.sources import files
from grapheon.streaming.transitions import transitions, windowed_counts

WORDS = ["the", "thing"]
COSINE = "list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"
Q = "q AS (SELECT embedding AS x FROM embeddings WHERE vec_id = 0)"


def _question(spark: SparkSession, sf_dir: str) -> list[float]:
    """The vector of one row, which stands for a question's."""
    row = _read(spark, sf_dir, "embeddings").filter("vec_id = 0").select("embedding").head()
    return list(row[0]) if row else [0.0]


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("key"), "embedding")
    return retrieve.attach(_read(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text"), vectors)


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"), F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"))


@query(f"WITH {Q} SELECT vec_id AS key, label AS relation, round({COSINE.format(a='embedding', b='x')}, 6) AS score FROM embeddings, q WHERE label = 3 ORDER BY {COSINE.format(a='embedding', b='x')} DESC, 1 LIMIT 8", False)
def relation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("key"), F.col("label").alias("relation"), "embedding")
    return retrieve.search_relations(edges, _question(spark, sf_dir), relation=3).withColumn("score", F.round("score", 6))


@query(f"WITH {Q} SELECT vec_id AS key, label AS relation, round({COSINE.format(a='embedding', b='x')}, 6) AS score FROM embeddings, q ORDER BY {COSINE.format(a='embedding', b='x')} DESC, 1 LIMIT 8", False)
def relation_search_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without the optional relation."""
    edges = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("key"), F.col("label").alias("relation"), "embedding")
    return retrieve.search_relations(edges, _question(spark, sf_dir)).withColumn("score", F.round("score", 6))


HYBRID = (
    BM25_SQL + f", {Q}, a AS (SELECT doc_id AS key, ROW_NUMBER() OVER (ORDER BY score DESC, doc_id) AS k FROM r WHERE score > 0), b AS (SELECT doc_id AS key, ROW_NUMBER() OVER (ORDER BY {COSINE.format(a='embedding', b='x')} DESC, doc_id) AS k FROM documents JOIN embeddings ON vec_id = doc_id, q),"
    " u AS (SELECT * FROM a WHERE k <= 20 UNION ALL SELECT * FROM b WHERE k <= 20), h AS (SELECT key, SUM(CAST(1.0 AS DOUBLE) / (60 + k)) AS score FROM u GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5),"
    " li AS (SELECT l_orderkey || '/' || l_linenumber AS key, l_orderkey AS src, l_partkey AS dst FROM lineitem),"
    " lo AS (SELECT 'entity' AS what, CAST(key AS VARCHAR) AS key, score FROM h UNION ALL SELECT 'relation', li.key, MAX(score) FROM li JOIN h ON h.key IN (li.src, li.dst) GROUP BY 2) "
)


def _texted(df: DataFrame) -> DataFrame:
    return df.select("what", F.col("key").cast("string").alias("key"), F.round("score", 8).alias("score"))


@query(HYBRID + "SELECT what, key, round(score, 8) AS score FROM lo", False)
def retrieve_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texted(retrieve.local(_entities(spark, sf_dir), _links(spark, sf_dir), _question(spark, sf_dir), WORDS))


@query(f"WITH {Q} SELECT 'report' AS what, CAST(vec_id AS VARCHAR) AS key, round(score, 8) AS score FROM (SELECT vec_id, {COSINE.format(a='embedding', b='x')} AS score FROM embeddings, q ORDER BY 2 DESC, 1 LIMIT 5) WHERE score >= 0.25", False)
def retrieve_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("key"), "embedding")
    return _texted(retrieve.reports(rows, _question(spark, sf_dir)))


@query(HYBRID + "SELECT what, key, round(score, 8) AS score FROM lo UNION ALL SELECT 'chunk', CAST(key AS VARCHAR), round(score, 8) FROM h", False)
def retrieve_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _entities(spark, sf_dir)
    return _texted(retrieve.unified(rows, _links(spark, sf_dir), rows, _question(spark, sf_dir), WORDS))


@query(f"SELECT src, dst, round(score, 6) AS score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY src ORDER BY score DESC, dst) AS r FROM (SELECT a.vec_id AS src, b.vec_id AS dst, {COSINE.format(a='a.embedding', b='b.embedding')} AS score FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)) WHERE r <= 3", False)
def similar_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("key"), F.col("label").alias("module"), "embedding")
    return retrieve.similar_within(rows).withColumn("score", F.round("score", 6))


@query("SELECT doc_id AS key, len(embedding) AS width FROM documents LEFT JOIN embeddings ON vec_id = doc_id", False)
def vectors_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _entities(spark, sf_dir)
    return rows.select("key", F.when(F.col("embedding").isNotNull(), F.size("embedding")).cast("long").alias("width"))


@query("WITH {graph} SELECT e.src, e.dst, s.name AS src_name, d.name AS dst_name FROM edges e LEFT JOIN elements s ON s.key = e.src LEFT JOIN elements d ON d.key = e.dst WHERE label = 'satisfies'")
def dereferenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends of edges looked up by key; null where there is none."""
    g = _graph(spark, sf_dir)
    named = lambda end: g.elements.select(F.col("key").alias(end), F.col("name").alias(end + "_name"))
    return g.labelled("satisfies").select("src", "dst").join(named("src"), "src", "left").join(named("dst"), "dst", "left")


@query("WITH {graph}, w AS (SELECT DISTINCT s.src AS root, o.dst AS customer FROM edges s JOIN edges o ON o.src = s.dst WHERE s.src LIKE 'region/%' AND s.label = 'owns' AND o.label = 'owns' AND o.dst LIKE 'customer/%')"
       " SELECT root, COUNT(*) AS n FROM w GROUP BY root")  # fmt: skip
def walk_in_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A walk whose second step stays among customers."""
    g = _graph(spark, sf_dir)
    roots = g.elements.filter("key like 'region/%'").select(F.col("key").alias("root"))
    nations = traverse.hop(roots, traverse.within(g.labelled("owns"), "nation"), "root").select("root", F.col("dst").alias("at"))
    held = traverse.hop(nations, traverse.within(g.labelled("owns"), "customer"), "at").select("root", "dst").distinct()
    return held.groupBy("root").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + SURVEY_SQL + " SELECT src AS key, dst, trigger, guard FROM ed WHERE label = 'transitionsTo'", False)
def successor_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir)
    return traverse.successors(m.edges.filter("label = 'transitionsTo'").select(F.col("src").alias("key")).distinct(), m.edges)


@query("WITH " + SURVEY_SQL + " SELECT src AS key, dst AS neighbour FROM ed WHERE label = 'connectedTo' UNION ALL SELECT dst, src FROM ed WHERE label = 'connectedTo'", False)
def connection_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = model(spark, sf_dir).edges.filter("label = 'connectedTo'")
    ends = joined.select(F.col("src").alias("key")).unionByName(joined.select(F.col("dst").alias("key"))).distinct()
    return traverse.hop(ends, joined, direction="any").select("key", F.col("dst").alias("neighbour"))


@query("WITH " + SURVEY_SQL + " SELECT en.type, el.module, COUNT(*) AS n FROM en JOIN el ON el.key = en.element GROUP BY ALL", False)
def read_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred entities by the module of the element that they are read as: a hop against READ_AS, then the element's declaration."""
    m = model(spark, sf_dir)
    links = m.entities.filter("element is not null").select(F.col("key").alias("src"), F.col("element").alias("dst"))
    hop = traverse.hop(m.elements.select("key", "module"), links, direction="in").select("module", F.col("dst").alias("entity"))
    return hop.join(m.entities.select(F.col("key").alias("entity"), "type"), "entity").groupBy("type", "module").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + SURVEY_SQL + " SELECT module, path FROM (SELECT DISTINCT module FROM el) JOIN (SELECT 'model/' || r_name AS path, r_name AS module FROM region) USING (module)", False)
def declared_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modules with the source that declares their elements."""
    source = _read(spark, sf_dir, "region").select(F.concat(F.lit("model/"), "r_name").alias("path"), F.col("r_name").alias("module"))
    return model(spark, sf_dir).elements.select("module").distinct().join(source, "module")


@query("WITH {graph} SELECT owner AS root, unit, total, n, list_extract(parts, 1).value AS largest, list_extract(parts, 1).name AS first FROM (SELECT owner, unit, " + TOTAL.format(c="num") + " AS total, COUNT(*) AS n, list({'value': num, 'name': name} ORDER BY num DESC, name DESC) AS parts FROM elements WHERE owner LIKE 'nation/%' AND num IS NOT NULL GROUP BY 1, 2)")
def totals_and_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    reached = g.elements.filter("owner like 'nation/%'").select(F.col("owner").alias("root"), F.col("key").alias("node"))
    found = rollup.with_parts(reached, g.elements, "root")
    top = F.col("parts")[0]
    return found.select("root", "unit", "total", F.size("parts").cast("long").alias("n"), top["value"].alias("largest"), top["name"].alias("first"))


@query("WITH {graph}, d AS (SELECT unnest(['owns', 'typedBy', 'verifies']) AS label) SELECT label, 'unproduced' AS fault FROM d WHERE label NOT IN (SELECT label FROM edges) UNION ALL SELECT DISTINCT label, 'undeclared' FROM edges WHERE label NOT IN (SELECT label FROM d)")
def vocabulary_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = spark.createDataFrame([("owns",), ("typedBy",), ("verifies",)], "label string")
    return rollup.vocabulary_differences(_graph(spark, sf_dir).edges, declared)


@query("SELECT c_nationkey AS model, COUNT(*) AS n FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1", False)
def largest_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.largest(_read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("model")), "model")


@query("SELECT o_custkey AS key, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, COUNT(DISTINCT o_orderstatus) AS states, MIN(o_orderkey) AS first, COUNT(*) = 1 AS single FROM orders GROUP BY 1", False)
def array_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows collected into arrays, then summed, made unique, indexed and counted there."""
    rows = _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.sort_array(F.collect_list(F.struct("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderstatus"))).alias("rows"))
    total = F.aggregate(scalar.expanded(F.col("rows"), "price"), F.lit(0).cast("decimal(28,2)"), lambda s, x: (s + x).cast("decimal(28,2)"))
    states = F.size(scalar.unique_sorted(scalar.expanded(F.col("rows"), "o_orderstatus"))).cast("long")
    return rows.select("key", total.cast("double").alias("total"), states.alias("states"), F.col("rows")[0]["o_orderkey"].alias("first"), (F.size("rows") == 1).alias("single"))


@query("""SELECT o_orderkey AS key, COALESCE(CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END, '') || o_orderpriority AS joined, 'order/' || o_orderkey AS identifier, CAST(o_orderkey AS VARCHAR) AS parsed, true AS same, false AS other,
 CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS listed, o_orderkey % 2 = 0 AS number, o_orderkey % 3 = 0 AS list, CASE WHEN o_orderkey % 2 = 0 THEN 'price,status' ELSE 'status' END AS names, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS merged, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS price FROM orders""", False)
def more_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    even = F.col("o_orderkey") % 2 == 0
    identifier = F.concat(F.lit("order/"), F.col("o_orderkey").cast("string"))
    listed = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("x")))
    price = F.struct(F.when(even, F.col("o_totalprice")).alias("num"))
    attributes = F.when(even, F.create_map(F.lit("status"), F.lit("old"), F.lit("price"), F.lit("p"))).otherwise(F.create_map(F.lit("status"), F.lit("old")))
    newer = F.when(even, F.create_map(F.lit("status"), F.lit("new"))).otherwise(F.create_map().cast("map<string,string>"))
    return o.select(
        F.col("o_orderkey").alias("key"), scalar.concat(F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")), F.col("o_orderpriority")).alias("joined"), identifier.alias("identifier"),
        scalar.key_of_identifier(identifier).alias("parsed"), scalar.same_collection("order", identifier).alias("same"), scalar.same_collection("part", identifier).alias("other"),
        F.size(scalar.append(listed, F.array(F.lit("y")))).alias("listed"), scalar.is_number(price).alias("number"), scalar.is_list(listed).alias("list"),
        F.array_join(scalar.attributes(attributes), ",").alias("names"), scalar.attribute(scalar.merge(attributes, newer), "status").alias("merged"), price["num"].alias("price"),
    )


@query("WITH {graph} SELECT 'stated' AS layer, src, dst FROM edges WHERE label = 'satisfies' UNION ALL SELECT DISTINCT 'inferred', 'supplier/' || l_suppkey, 'part/' || l_partkey FROM lineitem")
def stated_and_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two result sets in one, told apart by a tag."""
    stated = _graph(spark, sf_dir).labelled("satisfies").select(F.lit("stated").alias("layer"), "src", "dst")
    line = _read(spark, sf_dir, "lineitem").select(F.lit("inferred").alias("layer"), F.concat(F.lit("supplier/"), "l_suppkey").alias("src"), F.concat(F.lit("part/"), "l_partkey").alias("dst")).distinct()
    return stated.unionByName(line)


@query("WITH {graph} SELECT label, COUNT(*) AS n FROM edges WHERE label <> 'owns' AND src IN (SELECT key FROM elements WHERE kind <> 'part' OR num >= 0) GROUP BY 1")
def scoped_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of two labels stay; then those go whose source is no longer there."""
    g = _graph(spark, sf_dir)
    kept = mutate.without_dangling(mutate.keep_labels(g.edges, ["typedBy", "satisfies"]), g.elements.filter("kind <> 'part' or num >= 0"))
    return kept.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("WITH {graph} SELECT label, COUNT(*) AS n FROM (SELECT src, dst, label FROM edges WHERE label <> 'typedBy' UNION ALL SELECT 'x', 'y', 'typedBy') GROUP BY 1")
def replaced_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = spark.createDataFrame([("x", "y", "typedBy")], "src string, dst string, label string")
    return mutate.replace_type(_graph(spark, sf_dir).edges.select("src", "dst", "label"), "typedBy", new).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey AS key, replace(p_name || '<SEP>' || p_brand, '<SEP>', ' ') AS description FROM part", False)
def unjoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.concat("p_name", F.lit("<SEP>"), "p_brand")
    return _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), scalar.substitute(joined, "<SEP>", " ").alias("description"))


@query("SELECT c_mktsegment AS segment, COUNT(*) AS n FROM customer WHERE c_acctbal >= 1000.0 AND c_mktsegment <> 'BUILDING' GROUP BY 1", False)
def bound_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement that the gate lets through, with its values bound, never spliced."""
    return guard.read_only(spark, "SELECT c_mktsegment AS segment, COUNT(*) AS n FROM parquet.`" + f"{sf_dir}/customer.parquet" + "` WHERE c_acctbal >= :least AND c_mktsegment <> :but GROUP BY 1", {"least": 1000.0, "but": "BUILDING"})


@query("""WITH RECURSIVE {graph}, c AS (SELECT owner AS key, COUNT(*) AS n FROM elements WHERE owner IS NOT NULL GROUP BY 1), w AS (SELECT e.key AS root, e.key AS node FROM elements e JOIN c USING (key) WHERE c.n > 1 AND kind IN ('part', 'item', 'package', 'action')
 UNION SELECT w.root, e.dst FROM w JOIN edges e ON e.src = w.node AND e.label IN ('owns', 'typedBy')),
 a AS (SELECT root, attribute, COUNT(*) AS n FROM w JOIN elements ON key = node WHERE node <> root AND num IS NOT NULL GROUP BY 1, 2), t AS (SELECT root, SUM(n) AS valued FROM a GROUP BY 1), s AS (SELECT root, COUNT(*) - 1 AS size FROM w GROUP BY 1),
 b AS (SELECT root, valued, size FROM t JOIN s USING (root) ORDER BY valued DESC, size DESC, root LIMIT 1)
 SELECT (SELECT kind FROM elements GROUP BY kind ORDER BY COUNT(*) DESC, kind LIMIT 1) AS kind, (SELECT MIN(key) FROM elements WHERE kind = 'requirement') AS requirement, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS element,
 (SELECT MIN(substr(name, 1, 4)) FROM elements WHERE length(name) > 4) AS word, 'owns' AS label, b.root AS start, e.name, (SELECT attribute FROM a WHERE a.root = b.root ORDER BY n DESC, attribute LIMIT 1) AS attribute, CAST(b.valued AS BIGINT) AS valued, b.size FROM b JOIN elements e ON e.key = b.root""")  # fmt: skip
def bind_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values for the parameters of example queries; states and connections are in the survey's graph, not in this one."""
    g = _graph(spark, sf_dir)
    return binds.bind_values(g.elements, g.edges, g.labelled("typedBy", "subsets", "redefines"))


DOCUMENT = """# Orders
```sql
SELECT o_custkey, COUNT(*) AS n FROM orders_now GROUP BY o_custkey
```
What a customer is owed, by segment:
```sql
SELECT * FROM customer_now WHERE c_mktsegment = :kind AND c_acctbal >= 0
```
```sql
DROP TABLE orders_now
```
```sql
SELECT nothing FROM orders_now
```
```sql
SELECT n_name FROM nation_now WHERE n_name LIKE '<WORD>%' -- not a :parameter
```
"""


@query("""SELECT 1 AS n, true AS parses, true AS runs, (SELECT COUNT(DISTINCT o_custkey) FROM orders) AS rows, '' AS binds UNION ALL SELECT 2, true, true, (SELECT COUNT(*) FROM customer WHERE c_mktsegment = (SELECT MIN(c_mktsegment) FROM customer) AND c_acctbal >= 0), 'kind'
 UNION ALL SELECT 3, false, false, 0, '' UNION ALL SELECT 4, false, false, 0, '' UNION ALL SELECT 5, true, true, (SELECT COUNT(*) FROM nation WHERE starts_with(n_name, (SELECT MIN(substr(n_name, 1, 5)) FROM nation))), ''""", False)  # fmt: skip
def checked_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of a document over the tables, run with a time limit; the third writes and the fourth names no column."""
    for name in ("orders", "customer", "nation"):
        _read(spark, sf_dir, name).createOrReplaceTempView(name + "_now")
    found = _read(spark, sf_dir, "customer").agg(F.min("c_mktsegment")).head()[0], _read(spark, sf_dir, "nation").agg(F.min(F.substring("n_name", 1, 5))).head()[0]
    rows = validate.checked(spark, DOCUMENT, {"kind": found[0], "word": found[1]}, 300.0)
    return rows.select("n", "parses", "runs", "rows", F.array_join("binds", ",").alias("binds"))


IMPORTS = "i AS (SELECT 'n' || n_nationkey AS path, 'N' || (n_nationkey + 1) % 4 AS imported, 'N' || n_nationkey AS namespace FROM nation)"


def _importing(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return _read(spark, sf_dir, "nation").select(F.concat(F.lit("n"), key.cast("string")).alias("path"), F.concat(F.lit("package N"), key.cast("string"), F.lit(" {\n  private import N"), ((key + 1) % 4).cast("string"), F.lit("::*;\n}")).alias("text"))


@query(f"WITH {IMPORTS} SELECT imported, COUNT(*) AS n FROM i GROUP BY 1", False)
def import_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.import_counts(files.import_edges(_importing(spark, sf_dir)))


@query("SELECT 'n' || n_nationkey AS path FROM nation WHERE n_nationkey < 4", False)
def import_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N0 imports N1, and so on to N3, which imports N0; the others only lead there."""
    sources = _importing(spark, sf_dir)
    declared = sources.select(F.upper("path").alias("namespace"), "path")
    return files.import_cycles(files.import_edges(sources), declared)


@query("SELECT 'm' || doc_id // 16 AS module, string_agg('// ' || doc_id || chr(10) || COALESCE(text, ''), chr(10) ORDER BY CAST(doc_id AS VARCHAR)) AS text FROM documents GROUP BY 1", False)
def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole files of each module as one text. A module is a row, so the query's hold sixteen files each."""
    module = F.concat(F.lit("m"), F.floor(F.col("doc_id") / 16).cast("string"))
    return files.combine(_read(spark, sf_dir, "documents").select(module.alias("module"), F.col("doc_id").cast("string").alias("path"), "text"))


@query("SELECT doc_id || '/x' AS path, CAST(doc_id AS VARCHAR) AS module, length(text) - length(replace(text, chr(10), '')) + 1 AS lines, length(text) AS characters, length(substr(text, 1, 4800)) AS head FROM documents", False)
def source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit("/x")).alias("path"), "text")
    return files.source_stats(d).select("path", "module", F.col("lines").cast("long").alias("lines"), F.col("characters").cast("long").alias("characters"), F.length("head").cast("long").alias("head"))


@query("SELECT event_type, epoch_us(time_bucket(INTERVAL '5 minutes', ts)) // 1000000 AS start, COUNT(*) AS n FROM events GROUP BY 1, 2", False)
def windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by type and window, the batch form of the stream."""
    found = windowed_counts(_read(spark, sf_dir, "events"))
    return found.select("event_type", F.col("start").cast("timestamp").cast("long").alias("start"), "n")


@query("SELECT dst AS state, COUNT(DISTINCT user_id) AS users FROM (SELECT user_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS src, event_type AS dst FROM events) WHERE src = 'view' GROUP BY 1", False)
def after_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transitions(_read(spark, sf_dir, "events")).filter("src = 'view'").groupBy(F.col("dst").alias("state")).agg(F.count_distinct("user_id").alias("users"))


@query(BM25_SQL + "SELECT doc_id, round(score, 6) AS score FROM r WHERE score > 0 ORDER BY r.score DESC, doc_id LIMIT 10", False)
def bm25_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranking as bm25_top, from the inverted index, which is built in one scan and has the mean length, too."""
    docs = _read(spark, sf_dir, "documents")
    index = cut(search.postings(docs))
    documents, terms = docs.count(), index.agg(F.coalesce(F.sum("tf"), F.lit(0))).head()[0]
    return search.bm25_postings(index, WORDS, 10, documents, terms / max(documents, 1)).select("doc_id", F.round("score", 6).alias("score"))


@query(None)
def module_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the nations of each region by label propagation; tested against cliques."""
    n = _read(spark, sf_dir, "nation").select(F.concat(F.lit("m"), F.col("n_regionkey").cast("string")).alias("module"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node"), "n_nationkey")
    a, b = n.select("module", F.col("node").alias("a"), F.col("n_nationkey").alias("x")), n.select("module", F.col("node").alias("b"), F.col("n_nationkey").alias("y"))
    linked = a.join(b, "module").filter((F.col("x") < F.col("y")) & (F.col("x") % 2 == F.col("y") % 2)).select("module", "a", "b", F.lit(1.0).alias("weight"))
    return search.clusters(n.select("module", "node"), linked)
