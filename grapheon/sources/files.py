"""Model files as sources; tables as sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grapheon.functions.scalar import lines
from grapheon.operators.traverse import walk

#: Characters of a source that its row keeps for similarity.
HEAD = 4800


def read_sources(spark: SparkSession, root: str, glob: str = "*.sysml") -> DataFrame:
    """path (relative to root), text of each model file under root. Spark skips files of no bytes, which declare nothing."""
    base = root.rstrip("/")
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(base, wholetext=True)
    absolute = F.col("_metadata.file_path")
    at = F.instr(absolute, F.lit(base + "/"))
    return files.select(F.substring(absolute, at + F.lit(len(base) + 1), F.length(absolute)).alias("path"), F.col("value").alias("text"))


def module_of(path):
    """The top folder, or the file's stem."""
    return F.regexp_replace(F.split(path, "/")[0], r"\.[^.]*$", "")


def source_stats(sources: DataFrame) -> DataFrame:
    return sources.select("path", module_of(F.col("path")).alias("module"), lines(F.col("text")).alias("lines"), F.length("text").alias("characters"), F.substring("text", 1, HEAD).alias("head"))


def modules(sources: DataFrame) -> DataFrame:
    return sources.groupBy(module_of(F.col("path")).alias("module")).agg(F.sort_array(F.collect_list("path")).alias("files"))


def import_edges(sources: DataFrame) -> DataFrame:
    """path, imported: namespaces that files import."""
    found = F.regexp_extract_all("text", F.lit(r"(?m)^\s*(?:(?:public|private|protected)\s+)?import\s+([A-Za-z_][\w]*|'[^']+')"), F.lit(1))
    return sources.select("path", F.explode(F.array_distinct(found)).alias("imported"))


def import_counts(edges: DataFrame) -> DataFrame:
    """imported, n: how many files import each namespace. edges: of `import_edges`."""
    return edges.groupBy("imported").agg(F.count(F.lit(1)).alias("n"))


def import_cycles(edges: DataFrame, declared: DataFrame, most: int = 8) -> DataFrame:
    """path: files that import themselves over at most `most` files. declared: namespace, path."""
    files = edges.join(declared.select(F.col("namespace").alias("imported"), F.col("path").alias("dst")), "imported").select(F.col("path").alias("src"), "dst").distinct()
    steps = files.filter("src <> dst")
    reached = walk(files.select(F.col("src").alias("root")).distinct(), steps, most - 1)
    back = reached.join(steps.select(F.col("src").alias("node"), F.col("dst").alias("root")), ["node", "root"], "left_semi").select(F.col("root").alias("path"))
    return back.unionByName(files.filter("src = dst").select(F.col("src").alias("path"))).distinct()


def combine(sources: DataFrame, by: str = "module") -> DataFrame:
    """One row for each module with the texts of its files in path order, each under its path. sources: path, text, and the column `by`."""
    parts = sources.groupBy(by).agg(F.sort_array(F.collect_list(F.struct("path", "text"))).alias("x"))
    return parts.select(by, F.array_join(F.transform("x", lambda s: F.concat(F.lit("// "), s["path"], F.lit("\n"), F.coalesce(s["text"], F.lit("")))), "\n").alias("text"))


def write_partitioned(df: DataFrame, path: str, by: str = "module") -> None:
    """One folder for each module, rows in it by label or kind where there is one, so that statistics prune."""
    inner = [c for c in ("label", "kind") if c in df.columns]
    df.repartition(by).sortWithinPartitions(by, *inner).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def report(elements: DataFrame, related: DataFrame) -> DataFrame:
    """what, name, n: elements by kind, relations by label, and unresolved references by label, of a model's frames."""
    count = lambda df, what, by: df.groupBy(F.col(by).alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "name", "n")
    return count(elements, "elements", "kind").unionByName(count(related.filter("dst is not null"), "relations", "label")).unionByName(count(related.filter("dst is null"), "unresolved", "label"))


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Inferred nodes or edges from JSON lines or Parquet, by the name's ending."""
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.json(path)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def create_vector_index(rows: DataFrame, table: str, key: str = "key", by: str = "module", buckets: int = 16) -> None:
    """A table of unit vectors, bucketed and sorted by `by`, so that a search within it reads one bucket and a score is one product. Searches over it are exact."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    unit = rows.filter("embedding is not null").withColumn("_norm", norm).filter("_norm > 0")
    unit.select(key, by, F.transform("embedding", lambda x: x.cast("double") / F.col("_norm")).alias("embedding")).write.mode("overwrite").bucketBy(buckets, by).sortBy(by).saveAsTable(table)


def drop_vector_index(spark: SparkSession, table: str) -> None:
    """To be called before the vectors are written anew."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def write_search_view(postings: DataFrame, table: str, buckets: int = 16) -> None:
    """The inverted index (key, term, tf, length) as a table bucketed by term: a search reads its words' buckets only."""
    postings.write.mode("overwrite").bucketBy(buckets, "term").sortBy("term").saveAsTable(table)


def rendered(rows: DataFrame, most: int = 4500, order: str | None = None) -> str:
    """Rows as JSON lines up to `most` characters, cut at a row. Only the rows that are shown come to the driver."""
    text = rows.orderBy(order) if order else rows
    out, held = [], 0
    for r in text.select(F.to_json(F.struct("*")).alias("j")).limit(most).toLocalIterator():
        held += len(r["j"]) + 1
        if held > most:
            out.append("...")
            break
        out.append(r["j"])
    return "\n".join(out)
