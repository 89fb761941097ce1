"""The named queries and their SQL, and what the modules that register them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grapheon.plans.graph import Graph, table_graph

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

ELEMENTS = """elements AS (
  SELECT 'region/' || r_regionkey AS key, 'package' AS kind, r_name AS name, CAST(NULL AS VARCHAR) AS owner, 0 AS depth, CAST(NULL AS VARCHAR) AS attribute, CAST(NULL AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS unit FROM region
  UNION ALL SELECT 'nation/' || n_nationkey, 'package', n_name, 'region/' || n_regionkey, 1, NULL, NULL, NULL FROM nation
  UNION ALL SELECT 'customer/' || c_custkey, 'part', c_name, 'nation/' || c_nationkey, 2, 'acctbal', c_acctbal, 'usd' FROM customer
  UNION ALL SELECT 'supplier/' || s_suppkey, 'part', s_name, 'nation/' || s_nationkey, 2, 'acctbal', s_acctbal, 'usd' FROM supplier
  UNION ALL SELECT 'part/' || p_partkey, 'part_definition', p_name, NULL, 0, 'retailprice', p_retailprice, 'eur' FROM part
  UNION ALL SELECT 'order/' || o_orderkey, 'requirement', 'Order/' || o_orderkey, 'customer/' || o_custkey, 3, 'totalprice', o_totalprice, 'chf' FROM orders
), edges AS (
  SELECT owner AS src, key AS dst, 'owns' AS label FROM elements WHERE owner IS NOT NULL
  UNION ALL SELECT DISTINCT 'order/' || l_orderkey, 'part/' || l_partkey, 'typedBy' FROM lineitem
  UNION ALL SELECT DISTINCT 'supplier/' || l_suppkey, 'order/' || l_orderkey, 'satisfies' FROM lineitem
)"""


def query(sql: str | None, prelude: bool = True):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql.replace("{graph}", ELEMENTS) if prelude else sql
        return f

    return add


def _graph(spark: SparkSession, sf_dir: str) -> Graph:
    return table_graph(spark, sf_dir)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TOTAL = "COALESCE(CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE), 0)"

BM25_SQL = """WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents),
 c AS (SELECT doc_id, len(w) AS l, len(list_filter(w, lambda x: x = 'the')) AS tf0, len(list_filter(w, lambda x: x = 'thing')) AS tf1 FROM t),
 s AS (SELECT COUNT(*) AS n, AVG(l) AS m, COUNT(*) FILTER (tf0 > 0) AS df0, COUNT(*) FILTER (tf1 > 0) AS df1 FROM c),
 r AS (SELECT doc_id, ln(1 + (n - df0 + 0.5) / (df0 + 0.5)) * tf0 * 2.2 / (tf0 + 1.2 * (0.25 + 0.75 * l / m)) + ln(1 + (n - df1 + 0.5) / (df1 + 0.5)) * tf1 * 2.2 / (tf1 + 1.2 * (0.25 + 0.75 * l / m)) AS score FROM c, s)
 """
