"""Exact duplicates: texts that are equal once white space is gone.

Texts are combined in three stages, each of which compares whole contents: inside a task (the map side of the first aggregation), inside a salted part of a digest
(its reduce side; the salt is the task's, so a part of a hot group has a row a task at most), and over the salts of a digest. Only digests and figures go on.
Where one digest stands for several contents, which is found out, its rows are joined by content instead.

Rows: a null text is an empty one; a null id comes after all others, so it is kept only where no other is; equal rows count each, and one of them stays.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grapheon.llm.common import cut, spread_join

SPACE = r"[\x20\x09-\x0D]+"
SALTS, RUN = 16, 65536
_TOP, _STEP = Decimal(2**63 - 1), Decimal(10**20)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _code(n_chars: Column, doc_id: Column) -> Column:
    """One number whose maximum is the longest row's, of those the least id's; a number, since aggregates over hashed groups take no other type of this width."""
    rest = F.coalesce(F.lit(_TOP).cast("decimal(20,0)") - doc_id.cast("decimal(20,0)") + 1, F.lit(0).cast("decimal(20,0)")).cast("decimal(21,0)")
    return (n_chars.cast("decimal(12,0)") * F.lit(_STEP).cast("decimal(21,0)") + rest).cast("decimal(38,0)")


def _decoded(code: Column) -> tuple[Column, Column]:
    """n_chars and doc_id of a code."""
    step = F.lit(_STEP).cast("decimal(38,0)")
    rest = (code % step).cast("decimal(21,0)")
    n_chars = ((code - rest) / step).cast("long")
    return n_chars, F.when(rest > 0, (F.lit(_TOP).cast("decimal(21,0)") - rest + 1).cast("long"))


def _contents(docs: DataFrame, text: str, key: str, digest: Callable[[Column], Column]) -> DataFrame:
    """id, n_chars, content, sha, digest: a row a document."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).select("id", F.length(F.coalesce("t", F.lit(""))).cast("long").alias("n_chars"), normalised(F.col("t")).alias("content"))
    rows = rows.withColumn("sha", sha256(F.col("content")))
    return rows.withColumn("digest", F.col("sha") if digest is sha256 else digest(F.col("content")))


def _groups(rows: DataFrame, salts: int) -> DataFrame:
    """digest, content, code, n: the contents, each once, with the best row's code and how many rows there are. Dealt by digest."""
    figures = [F.max("code").alias("code"), F.sum("n").cast("long").alias("n")]
    # a task's salt: what the task combines stays together, and a task that runs again gets the same one
    each = rows.select("digest", "content", _code(F.col("n_chars"), F.col("id")).alias("code"), F.lit(1).cast("long").alias("n"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    parts = each.groupBy("digest", "salt", "content").agg(*figures)
    return parts.repartition("digest").groupBy("digest", "content").agg(*figures)


def _members(rows: DataFrame, *by: str) -> DataFrame:
    """Rows that differ, each once, with how many of it there are (`same`)."""
    return rows.groupBy("id", "n_chars", *by).agg(F.count(F.lit(1)).alias("same"))


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """id, n_chars, digest, sha, same, keep_id, keep_chars, group_size: each distinct (id, length, content) with the row that stays of its group."""
    rows = _contents(docs, text, key, digest)
    groups = _groups(rows, salts)
    # dealt by digest already: no exchange, and no content goes on
    found = cut(groups.groupBy("digest").agg(F.count(F.lit(1)).alias("contents"), F.max("code").alias("code"), F.sum("n").cast("long").alias("n")))
    several = found.filter("contents > 1").select("digest")
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    out = _members(rows, "digest", "sha")
    single = found.filter("contents = 1").select("digest", "code", F.col("n").alias("group_size"), F.col("n").alias("times"))
    if several.isEmpty():
        out = spread_join(out, single, "digest", "times", total)
    else:
        lone = spread_join(out, single, "digest", "times", total).filter("code is not null")
        shared = rows.join(several, "digest", "left_semi")
        by_content = _groups(shared, salts).select("digest", "content", "code", F.col("n").alias("group_size"))
        out = lone.unionByName(_members(shared, "digest", "sha", "content").join(by_content, ["digest", "content"]).drop("content"))
    keep_chars, keep_id = _decoded(F.col("code"))
    return out.select("id", "n_chars", "digest", "sha", "same", keep_id.alias("keep_id"), keep_chars.alias("keep_chars"), "group_size")


def _runs(rows: DataFrame) -> DataFrame:
    """A row for each of the `same` rows, numbered (nth) from 0, in runs so that no row holds a long array."""
    starts = rows.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("same") - 1, F.lit(RUN).cast("long"))))
    return starts.withColumn("nth", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + RUN, F.col("same")) - 1))).drop("_from")


def exact_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: a row for each document; of a group, the row with the most code points stays, of those the one with the least id."""
    best = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    return _runs(classes(docs, **settings)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (best & (F.col("nth") == 0)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )
