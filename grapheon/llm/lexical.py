"""Ranked lexical search over an index that is sharded by documents.

A shard is a row: some documents' ids, their terms, and the postings of all terms end to end (offsets, documents, impacts). A posting's impact, an integer, needs
only the collection's two totals, so it is computed when the index is written. A term's weight needs its document frequency, which the shards' offsets add up to.
To search, a wave of queries goes to all tasks; a shard is scored a query at a time, a term at a time into a dense array, and only rows that could be among
the k best leave a task. Waves are bounded by their number of terms, so more queries mean more passes over the index.

Rows: a null or empty text has no terms and is found by nothing, and isn't counted as a document. A null id comes after all others of its score. Equal documents
each have a place of their own, and so have equal queries. A long text is read in pieces and stays one document. Null queries find nothing.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grapheon.llm.common import cut, lean, shared_folder, slices

#: Bytes of text in a shard; distinct terms in a wave of queries; bytes of a text that are split at once.
SHARD_BYTES, WAVE_TERMS, PIECE_BYTES = 4_000_000, 1 << 19, 4_000_000
#: Terms are the runs of ASCII letters and digits and of all that isn't ASCII; only A to Z are lowered. In UTF-8 no other character holds ASCII bytes.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))
#: Parquet counts a row group's bytes only every 100 rows, and Spark reads up to 4096 rows of one at once: a shard is a row, so a row group is to hold few.
GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
INDEX = "documents long, terms long, ids array<long>, words array<string>, offsets array<int>, places array<int>, impacts array<int>"


def pieces(text: bytes, most: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    at = 0
    while at < len(text):
        part = text[at : at + most].translate(TERM_BYTES)
        end = len(part)
        if at + most < len(text) and text[at + most : at + most + 1].translate(TERM_BYTES) != b" ":
            end = part.rfind(b" ") + 1  # the last term goes on
            if not end:  # a term longer than a piece
                stop = at + most
                while stop < len(text) and text[stop : stop + 1].translate(TERM_BYTES) != b" ":
                    stop += 1
                part, end = text[at:stop].translate(TERM_BYTES), stop - at
        yield part[:end].split()
        at += end


def _texts(column: pa.Array) -> Iterator[bytes]:
    for t in column.cast(pa.binary()):
        yield t.as_py() or b""


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents have terms, and how many terms there are: one row a task."""
    documents = terms = 0
    for batch in slices(batches):
        for text in _texts(batch.column("text")):
            n = sum(map(len, pieces(text)))
            documents, terms = documents + (n > 0), terms + n
    yield pa.RecordBatch.from_pydict({"documents": pa.array([documents], pa.int64()), "terms": pa.array([terms], pa.int64())})


def length_factor(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    return 100 - 25 + (25 * n * documents) // max(terms, 1)


def shard(ids: list, texts: Iterator[bytes], documents: int, terms: int) -> dict:
    """The row of some documents: postings ordered by term, then by place."""
    words, places, times, lengths = [], [], [], np.zeros(len(ids), np.int64)

    def add(found: list[bytes], at: np.ndarray) -> None:
        coded = pa.array(found, pa.binary()).dictionary_encode()
        key, count = np.unique(coded.indices.to_numpy().astype(np.int64) * len(ids) + at, return_counts=True)
        words.append(coded.dictionary.take(pa.array(key // len(ids))))
        places.append(key % len(ids))
        times.append(count)

    held, at = [], []
    for i, text in enumerate(texts):
        for found in pieces(text):
            lengths[i] += len(found)
            held += found
            at.append((i, len(found)))
            if len(held) > 1_000_000:
                add(held, np.repeat([a for a, _ in at], [n for _, n in at]))
                held, at = [], []
    if held:
        add(held, np.repeat([a for a, _ in at], [n for _, n in at]))
    if not words:
        return {"documents": 0, "terms": 0, "ids": ids, "words": [], "offsets": [0], "places": [], "impacts": []}
    coded = pa.concat_arrays(words).dictionary_encode()
    key, back = np.unique(coded.indices.to_numpy().astype(np.int64) * len(ids) + np.concatenate(places), return_inverse=True)
    tf = np.zeros(len(key), np.int64)
    np.add.at(tf, back, np.concatenate(times))  # a long text's pieces, and lists that were added apart
    place = key % len(ids)
    impact = (1_000_000_000 * tf) // (1000 * tf + 12 * length_factor(lengths, documents, terms)[place])
    offsets = np.searchsorted(key // len(ids), np.arange(len(coded.dictionary) + 1))
    return {
        "documents": int((lengths > 0).sum()), "terms": int(lengths.sum()), "ids": ids, "words": coded.dictionary.cast(pa.string()), "offsets": offsets.astype(np.int32),
        "places": place.astype(np.int32), "impacts": impact.astype(np.int32),
    }


_SHARD = pa.schema([("documents", pa.int64()), ("terms", pa.int64()), ("ids", pa.list_(pa.int64())), ("words", pa.list_(pa.string())), ("offsets", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int32()))])


def _one(values, kind: pa.DataType) -> pa.Array:
    """A list column's single row."""
    flat = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def write_index(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", shard_bytes: int = SHARD_BYTES) -> None:
    """Write the index of docs as a table. Two passes over the texts, for impacts need the totals; nothing is shuffled."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    total = rows.mapInArrow(lean(_lengths), "documents long, terms long").agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).head()
    documents, terms = total[0], total[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def made() -> pa.RecordBatch:
            row = shard(ids, iter(texts), documents, terms)
            arrays = [pa.array([row["documents"]], pa.int64()), pa.array([row["terms"]], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays + [_one(row[f.name], f.type.value_type) for f in list(_SHARD)[2:]], schema=_SHARD)

        for batch in slices(batches):
            for i, t in zip(batch.column("id").to_pylist(), _texts(batch.column("text"))):
                if texts and size + len(t) > shard_bytes:
                    yield made()
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if texts:
            yield made()

    rows.mapInArrow(lean(run), INDEX).write.mode("overwrite").options(**GROUPS).parquet(path)


def term_lists(queries: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    """key, words, times: each query's distinct terms with how often it holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, times = [], []
            for t in _texts(batch.column("text")):
                count: dict[bytes, int] = {}
                for part in pieces(t):
                    for w in part:
                        count[w] = count.get(w, 0) + 1
                words.append([w.decode() for w in count])
                times.append(list(count.values()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(words, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))], ["key", "words", "times"])

    rows = queries.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lean(run), f"key {rows.schema['key'].dataType.simpleString()}, words array<string>, times array<long>")


def best_places(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above 0, equal ones by ids; whatever ties with the k-th is compared, not what the partition happens to leave first."""
    found = np.flatnonzero(score > 0)
    if len(found) > k:
        kth = score[found[np.argpartition(-score[found], k - 1)[k - 1]]]
        found = found[score[found] >= kth]
    return found[np.lexsort((ids[found], -score[found]))][:k]


#: Null ids in arrays of numbers: after all others.
NO_ID = np.iinfo(np.int64).max


def searcher(asked: list[tuple[list[str], list[int]]], k: int):
    """A function over shards that gives the k best rows of a task for each query. asked: terms and their weights, times taken in."""
    starts = np.cumsum([0, *(len(w) for w, _ in asked)])
    words = pa.array([x for w, _ in asked for x in w], pa.string()).dictionary_encode()
    weights = np.array([x for _, w in asked for x in w], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                ids, offsets, places, impacts = (batch.column(c)[r].values for c in ("ids", "offsets", "places", "impacts"))
                null = ids.is_null().to_numpy(zero_copy_only=False)
                ids, offsets, places, impacts = ids.fill_null(NO_ID).to_numpy(), offsets.to_numpy(), places.to_numpy(), impacts.to_numpy()
                if not len(places):
                    continue
                at = pc.index_in(words.dictionary, value_set=batch.column("words")[r].values).fill_null(-1).to_numpy()[words.indices.to_numpy()]
                score = np.zeros(len(ids), np.int64)
                for q in np.unique(np.repeat(np.arange(len(asked)), np.diff(starts))[at >= 0]):
                    score[:] = 0
                    for i in range(starts[q], starts[q + 1]):
                        if at[i] >= 0:
                            span = slice(offsets[at[i]], offsets[at[i] + 1])
                            score[places[span]] += weights[i] * impacts[span].astype(np.int64)  # a term's places differ
                    best = best_places(score, ids, k)
                    new = (score[best], ids[best], null[best])
                    if q in kept:
                        new = tuple(np.concatenate(x) for x in zip(kept[q], new))
                        order = np.lexsort((new[2], new[1], -new[0]))[:k]
                        new = tuple(x[order] for x in new)
                    kept[q] = new
        for q, (score, ids, null) in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q, np.int32)), pa.array(ids, pa.int64(), mask=null), pa.array(score)], ["q", "doc_id", "score"])

    return run


def _best(rows: DataFrame, k: int, *by: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int, text: str = "text", key: str = "item_id", wave_terms: int = WAVE_TERMS) -> DataFrame:
    """key, rank, doc_id, score: the k best documents of each query. Weights are floor(1000 * ln((2N + 2) / (2df + 1)))."""
    spark = index.sparkSession
    asked = cut(term_lists(queries, text, key))
    documents = index.agg(F.coalesce(F.sum("documents"), F.lit(0))).head()[0]
    size = F.size("words")
    waves = -(-(asked.agg(F.coalesce(F.sum(size), F.lit(0))).head()[0]) // wave_terms)
    kind = asked.schema["key"].dataType.simpleString()
    out = spark.createDataFrame([], f"{key} {kind}, rank int, doc_id long, score long")
    df = index.filter(size > 0).select(F.explode(F.arrays_zip("words", F.transform(F.sequence(F.lit(1), size), lambda i: F.element_at("offsets", i + 1) - F.element_at("offsets", i)).alias("df")))).select("col.words", "col.df")
    for wave in range(waves):
        part = asked.withColumn("wave", F.pmod(F.xxhash64("words", "times", "key"), F.lit(waves))).filter((F.col("wave") == wave) & (size > 0))
        terms = part.select(F.explode("words").alias("words")).distinct()
        weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * documents + 2.0) / (F.lit(2.0) * F.sum("df") + 1))).cast("long")
        weights = {r[0]: r[1] for r in df.join(F.broadcast(terms), "words").groupBy("words").agg(weight).collect()}  # a wave's terms at most
        rows = part.select("key", "words", "times").collect()  # the same bound
        terms_of = [[(w, weights[w] * n) for w, n in zip(r.words, r.times) if w in weights] for r in rows]
        run = searcher([([w for w, _ in t], [n for _, n in t]) for t in terms_of], k)
        found = index.select("ids", "words", "offsets", "places", "impacts").mapInArrow(lean(run), "q int, doc_id long, score long")
        # every task has k rows a query: merged in parts first, so that no task reads all of them
        merged = _best(_best(found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(32))), k, "q", "part"), k, "q")
        keys = spark.createDataFrame([(i, r.key) for i, r in enumerate(rows)], f"q int, {key} {kind}")
        out = out.unionByName(merged.join(F.broadcast(keys), "q").select(key, F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
        if waves > 1:
            out = cut(out)  # a wave's plan ends here
    return out


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 20, **settings) -> DataFrame:
    """search over an index of docs that is written to the shared folder; it goes once the result is there."""
    spark = docs.sparkSession
    path = posixpath.join(shared_folder(spark), f"lexical-{uuid.uuid4().hex}")
    write_index(docs, path)
    found = cut(search(spark.read.schema(INDEX).parquet(path), queries, k, **settings))
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return found
