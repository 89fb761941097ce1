"""Which fingerprints occur more than once: a distributed count that moves about four bytes for each.

Documents are taken in batches of bounded size. A batch's distinct 64-bit fingerprints, sorted, are dealt
to buckets by their upper bits; a bucket row holds the next 32 bits of each. Buckets grow in number with the table, so that each stays a task's work; one takes
the fingerprints of many megabytes of text, so that a row holds many entries (tens at 30 GB; beyond some terabytes rows become short, and what is around an entry outweighs it). A bucket counts them over all batches and
gives back one byte for each entry in the same order: the bit length of the count. Since buckets are ranges of the sorted
order, the bytes of all buckets laid end to end line up with the batch's fingerprints again. A fingerprint sends one
entry for each batch, however often it occurs there, so no group grows with a fingerprint's popularity in a batch. Two
fingerprints that agree in bucket and 32 bits are counted as one, so a count can be too high, never too low.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grapheon.llm.common import lean_group

#: kind 0: what a batch keeps for itself (a, b, c, d); kind 1: its fingerprints in one bucket (a: uint32, b: uint16 counts)
ROWS = "kind int, batch long, bucket int, a binary, b binary, c binary, d binary"
_NAMES = ["kind", "batch", "bucket", "a", "b", "c", "d"]


def bucket_bits(size: int, each: int, least: int = 16) -> int:
    """Bits of a bucket's number, for about `each` bytes of the input in a bucket. Not capped but by the 32-bit numbers of buckets."""
    return min(31, max(least - 1, -(-size // each) - 1).bit_length())


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def batch_ids():
    """Ids that differ over all tasks and are the same when a task is run again."""
    context = TaskContext.get()
    at = (context.partitionId() if context else 0) << 32
    while True:
        yield at
        at += 1


def batch_rows(batch: int, home: tuple[bytes, ...], found: np.ndarray, counts: np.ndarray | None, bits: int) -> pa.RecordBatch:
    """The home row of a batch and a row for each bucket. found: sorted distinct uint64; counts: how often each occurs, if that matters."""
    upper = (found >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.append(np.flatnonzero(np.diff(upper, prepend=-1)), len(upper))
    low = ((found >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype("<u4")
    more = None if counts is None else np.minimum(counts, 65535).astype("<u2")
    kind, bucket, a, b = [0], [0], [home[0]], [home[1]]
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        kind.append(1)
        bucket.append(int(upper[s]))
        a.append(low[s:e].tobytes())
        b.append(b"" if more is None else more[s:e].tobytes())
    rest = [b""] * (len(edges) - 1)
    columns = [pa.array(kind, pa.int32()), pa.array([batch] * len(kind), pa.int64()), pa.array(bucket, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array([home[2], *rest], pa.binary()), pa.array([home[3], *rest], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _count(group: pa.Table) -> pa.Table:
    blobs = group.column("a").to_pylist()
    sizes = np.array([len(x) // 4 for x in blobs])
    low = np.frombuffer(b"".join(blobs), "<u4")
    given = [x for x in group.column("b").to_pylist()]
    weight = np.frombuffer(b"".join(given), "<u2").astype(np.int64) if any(given) else None
    _, inverse = np.unique(low, return_inverse=True)
    total = np.bincount(inverse, weight).astype(np.int64)
    length = np.frexp(total.astype(np.float64))[1].astype(np.uint8)[inverse]
    ends = np.cumsum(sizes)
    out = [length[e - n : e].tobytes() for n, e in zip(sizes, ends, strict=True)]
    n = len(out)
    return pa.table({"kind": pa.array([2] * n, pa.int32()), "batch": group.column("batch"), "bucket": group.column("bucket"), "a": pa.array(out, pa.binary()), "b": pa.nulls(n, pa.binary()), "c": pa.nulls(n, pa.binary()), "d": pa.nulls(n, pa.binary())})


def counted(rows: DataFrame) -> DataFrame:
    """Rows of kind 2: for each bucket row of each batch the bit lengths of the counts (a)."""
    return rows.filter("kind = 1").groupBy("bucket").applyInArrow(lean_group(_count), ROWS)


def with_counts(rows: DataFrame, finish, schema: str) -> DataFrame:
    """Bring the counts back to the batches. finish(batch, home row as a tuple of bytes, uint8 bit lengths) gives a table of `schema`."""

    def run(home: pa.Table, back: pa.Table) -> pa.Table:
        order = np.argsort(back.column("bucket").to_numpy(), kind="stable")
        blobs = back.column("a").to_pylist()
        lengths = np.frombuffer(b"".join(blobs[i] for i in order), np.uint8)
        return finish(home.column("batch")[0].as_py(), tuple(home.column(c)[0].as_py() for c in "abcd"), lengths)

    return by_batch(homes(rows), counted(rows), run, schema)


def homes(rows: DataFrame) -> DataFrame:
    return rows.filter("kind = 0")


def by_batch(home: DataFrame, more: DataFrame, run, schema: str) -> DataFrame:
    """Cogroup on the batch. The home side's exchange is the same wherever it is used in a plan, so Spark makes it once."""
    more = more.select(*(F.col(c).alias(c) for c in more.columns))  # columns of their own, not those of home
    return home.groupBy("batch").cogroup(more.groupBy("batch")).applyInArrow(lean_group(run), schema)


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=7).compress(data)


def unsqueezed(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
