"""Removal of long repeated substrings: exact, over UTF-8 bytes, with suffix arrays of shards.

A byte goes if it lies in a string of `length` bytes that also starts earlier: in a document of smaller id, or earlier in the same one.
Strings never cross documents and are judged on the input. All copies of such a string have to meet, in one place, but most text repeats
nowhere, so:

1. Every window of `length` bytes has an anchor: the least hash of the `gram`-byte strings in it, the leftmost of equal ones. It depends
   on the window's content alone. A few bytes in a hundred are anchors. Anchor hashes are counted over all documents; windows whose anchor occurs once
   repeat nowhere.
2. The others go to shards by their anchor's hash, as contexts: the anchor's windows are adjacent, so their bytes are sent once. Equal contexts
   are sent once for each batch of documents: the earliest one is, and the rest of them go at once, so a passage with many copies sends
   few rows.
3. A shard sorts the suffixes of its distinct contexts by induced sorting, computes the permuted common prefixes, and cuts the order where fewer than `length`
   bytes are shared. In each run, all windows but the earliest are repeats.

Results come back to the batches as byte ranges; their union is what is removed. Memory: a batch of documents, or a shard of contexts.

Nulls: a null text is an empty text; a null doc_id comes after all others and comes back as null. Rows that repeat a doc_id are read as one
document: of two strings, the one with the smaller start is the earlier, and neither if these are equal. Texts shorter than
`length` bytes stay whole. Columns other than doc_id and text are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grapheon.llm.common import cut, lean, lean_group, slices, text_bytes
from grapheon.llm.fingerprints import ROWS, batch_ids, batch_rows, bucket_bits, by_batch, homes, mix, squeezed, starts, unsqueezed, with_counts
from grapheon.llm.suffixes import permuted_prefixes, suffix_array

#: A null id is taken for the largest one, and its documents for later than those that have it: this is added to their starts.
NULL_ID, BEHIND = (1 << 63) - 1, 1 << 62
GRAM = 32
SPAN = 1 << 16  # windows that are looked at together
#: Bytes of text in a batch.
BATCH = 4_000_000
REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _tables() -> tuple[np.ndarray, list[np.uint64]]:
    seed = mix(np.arange(1, 300, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seed[:256], [np.uint64(x | 1) for x in seed[256:].tolist()]


TABLE, FACTORS = _tables()


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: the anchor's hash, first and last window. data: bytes of documents, end to end; bounds: where they begin, and the end."""
    hashes, firsts, lasts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    n, width = len(data), length - gram + 1
    ends = bounds[1:]
    for s in range(0, max(0, n - length + 1), SPAN):
        e = min(s + SPAN, n - length + 1)
        part = data[s : e + length - 1]
        h, step, level = TABLE[part], 1, 0
        while step < gram:  # grams of 1, 2, 4, ... bytes
            h = h[: len(h) - step] * FACTORS[level] + h[step:]
            step, level = 2 * step, level + 1
        h = mix(h)
        key = (h & ~np.uint64((1 << 18) - 1)) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while 2 * step <= width:
            key = np.minimum(key[: len(key) - step], key[step:])
            step *= 2
        key = np.minimum(key[: len(key) - (width - step)], key[width - step :]) if width > step else key
        at = (key & np.uint64((1 << 18) - 1)).astype(np.int64)
        window = np.arange(s, e)
        doc = np.searchsorted(bounds, window, "right") - 1
        inside = np.flatnonzero(window + length <= ends[doc])
        if not len(inside):
            continue
        turn = np.flatnonzero((at[inside[1:]] != at[inside[:-1]]) | (doc[inside[1:]] != doc[inside[:-1]])) + 1
        first, last = np.append(inside[0], inside[turn]), np.append(inside[turn - 1], inside[-1])
        hashes.append(mix(h[at[first]] + FACTORS[0]))  # anew: anchors' own hashes are least ones, so mostly near zero
        firsts.append(first + s)
        lasts.append(last + s)
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(lasts)


def _sketch(length: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = batch_ids()
        for part in slices(batches, most=BATCH):
            nulls = part.column(0).is_null().to_numpy(zero_copy_only=False).astype("u1")
            ids = part.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
            sizes = np.array([len(t) for t in texts], "<i8")
            data = b"".join(texts)
            h, _, _ = anchors(np.frombuffer(data, np.uint8), starts(sizes), length)
            rest = squeezed(_packed(part.select([2]))) if part.num_columns > 2 else b""
            yield batch_rows(next(names), (ids.astype("<i8").tobytes(), sizes.tobytes() + nulls.tobytes(), squeezed(data), rest), np.unique(h), None, bits)

    return run


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _home(home: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Ids, sizes and whether the id is null, of a batch's documents, and their bytes."""
    ids = np.frombuffer(home[0], "<i8")
    return ids, np.frombuffer(home[1], "<i8", len(ids)), np.frombuffer(home[1], "u1", len(ids), 8 * len(ids)), unsqueezed(home[2])


def _contexts(length: int, bits: int):
    """Of a batch: contexts for the shards (kind 1), and byte ranges that the batch itself shows to be repeats (kind 2)."""

    def finish(batch: int, home: tuple[bytes, ...], lengths: np.ndarray) -> pa.Table:
        ids, sizes, nulls, data = _home(home)
        bounds = starts(sizes)
        behind = nulls.astype(np.int64) << 62
        h, first, last = anchors(np.frombuffer(data, np.uint8), bounds, length)
        found, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
        take = np.flatnonzero(((lengths > 1) | (times > 1))[inverse])
        doc = np.searchsorted(bounds, first[take], "right") - 1
        owner = ids[doc]
        begin = first[take] - bounds[doc] + behind[doc]
        order = np.lexsort((begin, owner))  # earliest first
        take, doc, owner, begin = take[order], doc[order], owner[order], begin[order]
        held: dict[bytes, int] = {}
        kept, gone, texts = [], [], []
        place = list(zip(first[take].tolist(), (last[take] + length).tolist(), strict=True))
        for k, (a, b) in enumerate(place):
            text = data[a:b]
            seen = held.setdefault(text, k)
            if seen == k:
                kept.append(k)
                texts.append(text)
            elif owner[seen] != owner[k] or begin[seen] != begin[k]:
                gone.append(k)
            else:  # the same place of a row that repeats the document: judged by the shard, like the first
                kept.append(k)
                texts.append(text)
        kept, gone = np.array(kept, np.int64), np.array(gone, np.int64)
        shard = (h[take[kept]] >> np.uint64(64 - bits)).astype(np.int64) if len(kept) else np.zeros(0, np.int64)
        by = np.argsort(shard, kind="stable")
        edges = np.flatnonzero(np.append(True, shard[by][1:] != shard[by][:-1])) if len(by) else np.zeros(0, np.int64)
        rows: list[tuple] = []
        for s, e in zip(edges, np.append(edges, len(by))[1:], strict=True):
            part = by[s:e]
            k = kept[part]
            rows.append((1, batch, int(shard[part[0]]), np.array([len(texts[i]) for i in part], "<u2").tobytes(), squeezed(b"".join(texts[i] for i in part)), owner[k].astype("<i8").tobytes(), np.array([doc[k], begin[k]], "<i8").tobytes()))
        if len(gone):
            at = first[take[gone]] - bounds[doc[gone]]
            end = last[take[gone]] + length - bounds[doc[gone]]
            rows.append((2, batch, batch & ((1 << bits) - 1), np.array([doc[gone], at, end], "<i8").tobytes(), b"", b"", b""))
        types = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, types, strict=True)], names=["kind", "batch", "bucket", "a", "b", "c", "d"])

    return finish


def repeats(texts: list[bytes], owner: np.ndarray, begin: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(context, first, end): byte ranges of contexts whose windows start earlier elsewhere. Contexts are distinct or of the same place."""
    sizes = np.array([len(t) for t in texts], np.int64)
    at = starts(sizes + 1)
    s = np.ones(at[-1] + 1, np.uint8)  # 1 parts contexts, 0 ends all
    flat = np.frombuffer(b"\0".join(texts), np.uint8) + np.uint8(2)  # UTF-8 has no bytes over 0xF4
    s[: len(flat)] = flat
    s[at[1:] - 1] = 1
    s[-1] = 0
    sa = suffix_array(s)
    run = np.cumsum(permuted_prefixes(s, sa, length)[sa] < length)
    context = np.minimum(np.searchsorted(at, sa, "right") - 1, len(texts) - 1)
    within = sa - at[context]
    window = within + length <= sizes[context]  # whoever shares `length` bytes with a window is one
    sa, run, context, within = sa[window], run[window], context[window], within[window]
    order = np.lexsort((begin[context] + within, owner[context], run))
    head = np.append(True, run[order][1:] != run[order][:-1])
    first = order[np.flatnonzero(head)[np.cumsum(head) - 1]]  # of each in that order, the earliest of its run
    later = (owner[context[order]] != owner[context[first]]) | (begin[context[order]] + within[order] != begin[context[first]] + within[first])
    hit = np.sort(sa[order[later]])
    out: list[tuple[int, int, int]] = []
    if len(hit):
        gap = np.flatnonzero(np.diff(hit) > 1)
        for a, b in zip(np.append(hit[0], hit[gap + 1]), np.append(hit[gap], hit[-1]), strict=True):
            c = int(np.searchsorted(at, a, "right") - 1)
            out.append((c, int(a - at[c]), int(b - at[c]) + length))
    return out


def _judge(length: int):
    def run(group: pa.Table) -> pa.Table:
        rows: list[tuple] = [(2, r["batch"], r["bucket"], r["a"], b"", b"", b"") for r in group.filter(pc.equal(group.column("kind"), 2)).to_pylist()]
        texts, owner, begin, doc, batch = [], [], [], [], []
        for r in group.filter(pc.equal(group.column("kind"), 1)).to_pylist():
            data, at = unsqueezed(r["b"]), 0
            for size in np.frombuffer(r["a"], "<u2").tolist():
                texts.append(data[at : at + size])
                at += size
            owner.append(np.frombuffer(r["c"], "<i8"))
            d, b = np.frombuffer(r["d"], "<i8").reshape(2, -1)
            doc.append(d)
            begin.append(b)
            batch.append(np.full(len(d), r["batch"]))
        gone: list[tuple[int, int, int, int]] = []  # batch, document, range
        if texts:
            owner, begin, doc, batch = (np.concatenate(x) for x in (owner, begin, doc, batch))
            order = np.lexsort((begin, owner))
            held: dict[bytes, int] = {}
            kept = []
            for k in order.tolist():
                seen = held.setdefault(texts[k], k)
                if seen == k or (owner[seen] == owner[k] and begin[seen] == begin[k]):
                    kept.append(k)
                else:
                    at = int(begin[k]) & ~BEHIND
                    gone.append((int(batch[k]), int(doc[k]), at, at + len(texts[k])))
            kept = np.array(kept)
            for c, a, b in repeats([texts[k] for k in kept], owner[kept], begin[kept], length):
                k = kept[c]
                at = int(begin[k]) & ~BEHIND
                gone.append((int(batch[k]), int(doc[k]), at + a, at + b))
        if gone:
            found = np.array(gone, "<i8")
            found = found[np.argsort(found[:, 0], kind="stable")]
            edges = np.flatnonzero(np.append(True, found[1:, 0] != found[:-1, 0]))
            for s, e in zip(edges, np.append(edges[1:], len(found)), strict=True):
                rows.append((2, int(found[s, 0]), 0, np.ascontiguousarray(found[s:e, 1:].T).tobytes(), b"", b"", b""))
        types = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, types, strict=True)], names=["kind", "batch", "bucket", "a", "b", "c", "d"])

    return run


def united(ranges: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of ranges (rows of first and end)."""
    out: list[tuple[int, int]] = []
    for a, b in ranges[np.argsort(ranges[:, 0], kind="stable")].tolist():
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _removed(batch_tables: tuple[pa.Table, pa.Table]) -> Iterator[tuple[int | None, bytes, list[tuple[int, int]]]]:
    """Id, text and removed runs of each document of a batch."""
    home, more = batch_tables
    ids, sizes, nulls, data = _home(tuple(home.column(c)[0].as_py() for c in "abcd"))
    bounds = starts(sizes)
    found = [np.frombuffer(x, "<i8").reshape(3, -1) for x in more.column("a").to_pylist()]
    ranges = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    ranges = ranges[:, np.argsort(ranges[0], kind="stable")]
    edges = np.searchsorted(ranges[0], np.arange(len(ids) + 1))
    for i, d in enumerate(ids.tolist()):
        runs = united(ranges[1:, edges[i] : edges[i + 1]].T)
        yield None if nulls[i] else d, data[bounds[i] : bounds[i + 1]], runs


def _without(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in runs:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def _report(home: pa.Table, more: pa.Table) -> pa.Table:
    rows = [(d, len(t), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_without(t, runs)).hexdigest()) for d, t, runs in _removed((home, more))]
    types = [pa.int64()] * 4 + [pa.string()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _texts(columns: list[str]):
    """The documents' rows with what is kept of their texts. Whole characters only: a character goes if all of its bytes go."""

    def finish(home: pa.Table, more: pa.Table) -> pa.Table:
        kept = []
        for _, t, runs in _removed((home, more)):
            whole = []
            for a, b in runs:
                while a < b and t[a] & 0xC0 == 0x80:
                    a += 1
                while b > a and b < len(t) and t[b] & 0xC0 == 0x80:
                    b -= 1
                whole.append((a, b))
            kept.append(_without(t, whole).decode())
        rows = pa.ipc.open_stream(unsqueezed(home.column("d")[0].as_py())).read_all().column(0).combine_chunks()
        rest = dict(zip((f.name for f in rows.type), rows.flatten(), strict=True))
        return pa.table([pa.array(kept, pa.string()) if c == "text" else rest[f"c{k}"] for k, c in enumerate(columns)], names=columns)

    return finish


def _run(docs: DataFrame, length: int, finish, schema, carried: bool = False) -> DataFrame:
    if not GRAM <= length < 1 << 15:
        raise ValueError(f"length isn't from {GRAM} to {(1 << 15) - 1}")  # an anchor's string lies in its windows, and a context's size takes 16 bits
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    size = text_bytes(docs)
    bits, shard_bits = bucket_bits(size, 32 << 20), bucket_bits(size, 2 << 20)
    if carried:
        columns.append(F.struct(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns) if c != "text")).alias("row"))
    sketch = cut(docs.select(columns).mapInArrow(lean(_sketch(length, bits)), ROWS))
    contexts = with_counts(sketch, _contexts(length, shard_bits), ROWS)
    ranges = contexts.groupBy("bucket").applyInArrow(lean_group(_judge(length)), ROWS)
    return by_batch(homes(sketch), ranges, finish, schema)


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row of docs."""
    return _run(docs, length, _report, REMOVED)


def strip_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """The rows of docs, all columns as they are, but the text without its repeated strings. A null text becomes an empty one."""
    return _run(docs, length, _texts(docs.columns), docs.schema, carried=True)
