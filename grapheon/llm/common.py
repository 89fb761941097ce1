"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows and bytes of text that a Python worker turns into objects at once.
SLICE_ROWS, SLICE_BYTES = 4000, 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: the session's spark.checkpoint.dir. Where that is unset, as in local tests, a temporary one; a cluster has no such folder, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir names no shared folder")
    return tempfile.mkdtemp(prefix="checkpoint")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours with the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def forget(*frames: DataFrame) -> None:
    """Delete the files of frames that `cut` gave. Only for those that nothing reads any more: what was made of them has been cut itself."""
    for df in frames:
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            remove(df.sparkSession, file.get())


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, counted."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string")).cast("long")), F.lit(0))).head()[0]


def spread_join(rows: DataFrame, by: DataFrame, key: str, times: str, total: int, few: int = 1000, parts: int = 64) -> DataFrame:
    """rows left-joined with `by`, which has one row a key and how many of the `total` rows have it (`times`, dropped from the result).

    A key of more than total / few rows is one of fewer than `few` such keys, so a broadcast of these is bounded; it is split into `parts`.
    A row's part follows from what it holds and from its task, never from its place in it: a task that runs again deals its rows as before, in whatever order they come.
    """
    hot = by.filter(F.col(times) * few > total).select(key, F.lit(True).alias("_hot"))
    left = rows.join(F.broadcast(hot), key, "left").withColumn("_part", F.when(F.col("_hot"), F.pmod(F.xxhash64(*rows.columns) + F.spark_partition_id(), F.lit(parts))).otherwise(F.lit(0).cast("long"))).drop("_hot")
    every = F.when(F.col(times) * few > total, F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return left.join(by.withColumn("_part", F.explode(every)).drop(times), [key, "_part"], "left").drop("_part")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that no more than `most` bytes of text (one row at least) are taken at a time."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.binary_length(column).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and (held + (size or 0) > most or i - start >= SLICE_ROWS):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        if start < len(sizes):
            yield batch.slice(start)


#: What an operator keeps in a worker over its own tasks: its name, and a function that drops it.
KEPT: dict[str, Callable[[], object]] = {}
_given_back = 0.0


def give_back(every: float = 0.0, owner: str | None = None) -> None:
    """Drop what operators other than `owner` keep in the worker, and return the worker's free memory to the system, if that was last done `every` seconds ago at least.

    Python workers outlive their tasks, and would hold what the largest of them took.
    """
    global _given_back
    if time.monotonic() - _given_back < every:
        return
    _given_back = time.monotonic()
    for name, drop in KEPT.items():
        if name != owner:
            drop()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def lean(run: Callable[[Iterator], Iterator], owner: str | None = None) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that gives its memory back before it starts and when it ends."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        give_back(owner=owner)
        yield from run(batches)
        give_back(owner=owner)

    return wrapped


def lean_group(run: Callable) -> Callable:
    """A function of groups that gives its memory back now and then."""

    @functools.wraps(run)
    def wrapped(*args):
        give_back(2.0)
        out = run(*args)
        give_back(2.0)
        return out

    # Spark tells by the number of parameters whether a function takes its group's key
    return {1: lambda a: wrapped(a), 2: lambda a, b: wrapped(a, b), 3: lambda a, b, c: wrapped(a, b, c)}[run.__code__.co_argcount]
