"""N-gram Jaccard join by prefix trees, with connected components.

A document's set holds its distinct word n-grams as 64-bit hashes. Documents with equal sets form a class, and one of them
stands for it. Then, all exact:

1. A set with more than a fifth of n-grams that no other set has can have no partner (at a threshold of 0.8). A sample of the n-grams
   (those whose hash has two low zero bits) shows most of these; of the rest all n-grams are counted, and the
   others drop out.
2. What is left is ordered globally, rare n-grams first. Linked sets share an n-gram of their prefixes, so sets that share
   a prefix n-gram, directly or over others, form a block. Links never leave a block.
3. A block is joined with a prefix tree. Its sets, ordered by the block's frequent n-grams first, are put into the tree
   one by one; each set first walks the tree, with the overlap so far shared by all sets below a node. A subtree is left if the overlap
   and what can still come (the rest of either side) are too little for its lengths, or if all of its sets are already in the set's
   component. Links join components (union-find), so a group of thousands of near copies costs one or a few links a set.
4. A block of more than `block_sets` sets is dealt to chunks. Each chunk is joined with itself and with the block's `pivots`; then sets
   outside of the block's largest component are joined with all chunks, chunk by chunk. So every pair in different components has met.

Documents with no words have an empty set and are linked with nothing. A null text is an empty text; a null doc_id counts as larger than any other, so a
component's id is null only if all of its rows have none. Rows that repeat a doc_id are documents of their own: inside, classes have numbers, and ids are only looked up for
the result. Classes with many rows are split in that join. Columns other than doc_id and text are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grapheon.llm.common import cut, forget, lean, lean_group, slices, spread_join, text_bytes
from grapheon.llm.components import components
from grapheon.llm.fingerprints import ROWS, batch_ids, batch_rows, bucket_bits, mix, squeezed, starts, unsqueezed, with_counts

FACTOR = np.uint64(0x9E3779B97F4A7C15)
SETS = "doc_id long, n_shingles long, set_key binary, text_key long"
SMALL = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("text_key", pa.int64())])
CLASS = pa.schema([("set_key", pa.binary()), ("packed", pa.binary())])


class Words(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        out = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = out
        return out


def shingle_set(text: bytes, held: Words, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a UTF-8 text."""
    words = text.lower().split()  # on bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(held.__getitem__, words), np.uint64, len(words))
    if len(h) < n:
        out = np.uint64(len(h))
        with np.errstate(over="ignore"):
            for x in h:
                out = out * FACTOR + x
        return mix(np.array([out], np.uint64))
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * FACTOR + h[k : len(h) - n + 1 + k]
    return np.unique(mix(out))


def overlap_needed(n: int, percent: int) -> int:
    """The least overlap of a set of n with any linked set."""
    return -(-percent * n // 100)


def _sketch(n: int, bits: int):
    """Batches of documents; home: ids, sizes, set keys, and the squeezed texts with the sampled n-grams' documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names = Words(), batch_ids()
        for part in slices(batches):
            nulls = part.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
            sizes, keys, sample, owner = [], [], [], []
            for i, t in enumerate(texts):
                s = shingle_set(t, held, n)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                s = s[(s & np.uint64(3)) == 0]
                sample.append(s)
                owner.append(np.full(len(s), i, "<u2"))
            h, d = np.concatenate(sample), np.concatenate(owner)
            order = np.argsort(h, kind="stable")
            h, d = h[order], d[order]
            found, at, times = np.unique(h, return_index=True, return_counts=True)
            lone = np.where(times == 1, d[at], 65535).astype("<u2")  # the one document that has it
            lengths = np.array([len(t) for t in texts], "<i8")
            meta = np.array([ids, sizes, lengths, nulls, part.column(2).to_numpy(zero_copy_only=False)], "<i8").tobytes()
            yield batch_rows(next(names), (meta, b"".join(keys), squeezed(b"".join(texts)), lone.tobytes()), found, None, bits)

    return run


def _parts(home: tuple[bytes, ...]):
    """Ids, set sizes, text lengths, whether the id is null, and text keys of a batch's documents, and their sets' keys."""
    meta = np.frombuffer(home[0], "<i8").reshape(5, -1)
    keys = home[1]
    return *meta, [keys[16 * i : 16 * i + 16] for i in range(meta.shape[1])]


def _all_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        for a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            ids, sizes, _, nulls, text, keys = _parts((a, b))
            yield pa.RecordBatch.from_arrays([pa.array(ids, mask=nulls.astype(bool)), pa.array(sizes), pa.array(keys, pa.binary()), pa.array(text)], schema=SMALL)


def may_differ(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether a set of so many n-grams can be linked with another one: at best with one that has one n-gram more or less."""
    return 100 * sizes >= percent * (sizes + 1)


def _left_over(percent: int):
    """Of a batch: the sets that the sample leaves, one of each class."""

    def finish(batch: int, home: tuple[bytes, ...], lengths: np.ndarray) -> pa.Table:
        _, sizes, texts, _, _, keys = _parts(home)
        count = len(sizes)
        lone = np.frombuffer(home[3], "<u2")
        unique = np.bincount(lone[(lengths == 1) & (lone != 65535)], minlength=count)[:count]
        most = sizes - np.array([overlap_needed(int(s), percent) for s in sizes], np.int64)
        stay = (unique <= most) & may_differ(sizes, percent) & (sizes > 0)
        first: dict[bytes, int] = {}
        for i in np.flatnonzero(stay):
            first.setdefault(keys[i], int(i))
        data, at = unsqueezed(home[2]), starts(texts)
        packed = [squeezed(data[at[i] : at[i + 1]]) for i in first.values()]  # a text takes less room than its set
        return pa.table([pa.array(list(first), pa.binary()), pa.array(packed, pa.binary())], schema=CLASS)

    return finish


def _second(n: int, bits: int, most: int = 1_000_000):
    """Batches of classes; home: their numbers, the texts, squeezed one by one, and the sets' keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, words = batch_ids(), Words()
        ids: list[int] = []
        keys: list[bytes] = []
        texts: list[bytes] = []
        sets: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            found, times = np.unique(np.concatenate(sets), return_counts=True)
            return batch_rows(next(names), (np.array(ids, "<i8").tobytes(), np.array([len(t) for t in texts], "<i8").tobytes(), b"".join(texts), b"".join(keys)), found, times, bits)

        for part in batches:
            for i, key, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                ids.append(i)
                keys.append(key)
                texts.append(t.as_py())
                sets.append(shingle_set(unsqueezed(texts[-1]), words, n))
                held += len(sets[-1])
                if held >= most:
                    yield flush()
                    ids, keys, texts, sets, held = [], [], [], [], 0
        if ids:
            yield flush()

    return run


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes' numbers and their sets' keys."""
    for part in batches:
        for a, d in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(a, "<i8")), pa.array([d[i : i + 16] for i in range(0, len(d), 16)], pa.binary())], names=["node", "set_key"])


ORDERED = "doc_id long, n long, shared binary, prefix array<long>"


def _ordered(n_words: int, percent: int):
    """Sets that may have partners: shared n-grams, rare first, and those of the prefix."""

    def finish(batch: int, home: tuple[bytes, ...], lengths: np.ndarray) -> pa.Table:
        ids, at, words = np.frombuffer(home[0], "<i8"), starts(np.frombuffer(home[1], "<i8")), Words()
        sets = [shingle_set(unsqueezed(home[2][a:b]), words, n_words) for a, b in zip(at[:-1], at[1:], strict=True)]
        h = np.concatenate(sets)
        classes = lengths[np.searchsorted(np.unique(h), h)]
        at, out = starts(np.array([len(s) for s in sets])), []
        for i, s in enumerate(sets):
            c, n = classes[at[i] : at[i + 1]], len(s)
            unique, prefix = int((c == 1).sum()), n - overlap_needed(n, percent) + 1
            if unique >= prefix:
                continue
            shared = s[np.lexsort((s, c))[unique:]]
            out.append((int(ids[i]), n, shared.tobytes(), shared[: prefix - unique].view(np.int64).tolist()))
        types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, types, strict=True)], names=["doc_id", "n", "shared", "prefix"])

    return finish


class Node:
    """A run of n-grams of the prefix tree, and what lies below it."""

    __slots__ = ("run", "down", "ends", "least", "most", "rest", "one", "mixed")

    def __init__(self, run: np.ndarray):
        self.run, self.down, self.ends = run, {}, []
        self.least, self.most, self.rest = 1 << 62, 0, 0  # set sizes below, longest way down after the run
        self.one, self.mixed = -1, False  # a set below; whether others may be in other components


class PrefixTree:
    """Links sets of at least `percent` Jaccard similarity, and unites their components."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int], components: list[int] | None = None, percent: int = 80):
        self.percent, self.sizes = percent, sizes
        self.parent = list(range(len(sets)))
        if components is not None:
            first: dict[int, int] = {}
            for i, c in enumerate(components):
                self.parent[i] = first.setdefault(c, i)
        everything = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        found, inverse, times = np.unique(everything, return_inverse=True, return_counts=True)
        place = np.empty(len(found), np.int64)
        place[np.lexsort((found, -times))] = np.arange(len(found))
        alive = int((times > 1).sum())  # the others match nothing; they come last
        at = starts(np.array([len(s) for s in sets]))
        ranked = place[inverse]
        self.paths = []
        for i in range(len(sets)):
            p = np.sort(ranked[at[i] : at[i + 1]])
            self.paths.append(p[: np.searchsorted(p, alive)])
        self.mask = np.zeros(alive, bool)
        self.root = Node(np.zeros(0, np.int64))
        self.compared = 0

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def probe(self, q: int) -> None:
        """Unite q with the sets of the tree that it is linked with, once for each component."""
        path, size, percent = self.paths[q], self.sizes[q], self.percent
        if len(path) * 100 < percent * size:
            return
        mask, low, high = self.mask, overlap_needed(size, percent), 100 * size // percent
        mask[path] = True
        mine = self.find(q)
        stack = [(self.root, 0)]
        while stack:
            node, over = stack.pop()
            if node.most < low or node.least > high:
                continue
            if not node.mixed and node.one >= 0 and self.find(node.one) == mine:
                continue
            run = node.run
            self.compared += 1
            left = len(path)
            if len(run):
                over += int(np.count_nonzero(mask[run]))
                left -= int(np.searchsorted(path, run[-1], "right"))
            smallest = max(node.least, low)
            if 100 * (over + min(left, node.rest)) * 1 < percent * (size + smallest - (over + min(left, node.rest))):
                continue
            for y in node.ends:
                if 100 * over >= percent * (size + self.sizes[y] - over):
                    r = self.find(y)
                    if r != mine:
                        self.parent[r] = mine
            stack.extend((child, over) for child in node.down.values())
        mask[path] = False

    def insert(self, q: int) -> None:
        path, size = self.paths[q], self.sizes[q]
        node, at = self.root, 0
        mine = self.find(q)
        while True:
            node.least, node.most = min(node.least, size), max(node.most, size)
            node.rest = max(node.rest, len(path) - at)
            if node.one < 0:
                node.one = q
            elif not node.mixed and self.find(node.one) != mine:
                node.mixed = True
            if at == len(path):
                node.ends.append(q)
                return
            child = node.down.get(int(path[at]))
            if child is None:
                leaf = Node(path[at:])
                leaf.least = leaf.most = size
                leaf.one = q
                leaf.ends.append(q)
                node.down[int(path[at])] = leaf
                return
            run = child.run
            n = min(len(run), len(path) - at)
            differ = np.flatnonzero(run[:n] != path[at : at + n])
            same = int(differ[0]) if len(differ) else n
            if same < len(run):  # split the run
                upper = Node(run[:same])
                upper.least, upper.most, upper.one, upper.mixed = child.least, child.most, child.one, child.mixed
                upper.rest = child.rest + len(run) - same
                upper.down[int(run[same])] = child
                child.run = run[same:]
                node.down[int(path[at])] = upper
                child = upper
            node, at = child, at + same

    def join(self) -> list[int]:
        """All sets with each other; gives each set's root."""
        for q in sorted(range(len(self.paths)), key=lambda i: (self.sizes[i], i)):
            self.probe(q)
            self.insert(q)
        return [self.find(i) for i in range(len(self.paths))]

    def join_to(self, asked: list[int], others: list[int]) -> list[int]:
        """Only the sets `asked` with the sets `others`."""
        for q in others:
            self.insert(q)
        for q in asked:
            self.probe(q)
        return [self.find(i) for i in range(len(self.paths))]


def _arrays(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column]


def _edges(ids: np.ndarray, roots: list[int]) -> pd.DataFrame:
    """Links of sets to a set of their component."""
    r = np.asarray(roots)
    apart = np.flatnonzero(r != np.arange(len(r)))
    return pd.DataFrame({"a": ids[apart], "b": ids[r[apart]]}, dtype="int64")


def _join_blocks(percent: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"a": [], "b": []}, dtype="int64")]
        pdf = pdf.sort_values(["block", "doc_id"], kind="stable")
        for _, part in pdf.groupby("block", sort=False):
            if len(part) > 1:
                out.append(_edges(part["doc_id"].to_numpy(), PrefixTree(_arrays(part["shared"]), part["n"].tolist(), None, percent).join()))
        return pd.concat(out)

    return run


def _join_rest(percent: int):
    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        both = pd.concat([a, b])
        tree = PrefixTree(_arrays(both["shared"]), both["n"].tolist(), both["root"].tolist(), percent)
        roots = tree.join_to(list(range(len(a))), list(range(len(a), len(both)))) if len(a) and len(b) else list(range(len(both)))
        return _edges(both["doc_id"].to_numpy(), roots)

    return run


def links(ordered: DataFrame, percent: int, block_sets: int = 1024, pivots: int = 4) -> DataFrame:
    """a, b: links that connect the same sets as all links do, cut. ordered: rows of ORDERED."""
    prefixes = ordered.select("doc_id", F.explode("prefix").alias("gram"))
    hub = prefixes.groupBy("gram").agg(F.min("doc_id").alias("hub"), F.count("*").alias("times")).filter("times > 1")
    near = prefixes.join(hub, "gram").filter("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    blocks = components(near).select(F.col("node").alias("doc_id"), F.col("root").alias("block"))
    sized = blocks.groupBy("block").agg(F.count("*").alias("sets"))
    member = cut(ordered.select("doc_id", "n", "shared").join(blocks.join(sized, "block"), "doc_id"))

    pack = F.when(F.col("sets") <= block_sets, F.pmod(F.xxhash64("block"), F.lit(1024)))
    small = member.filter(F.col("sets") <= block_sets).withColumn("pack", pack).select("pack", "block", "doc_id", "n", "shared")
    found = small.groupBy("pack").applyInPandas(lean_group(_join_blocks(percent)), "a long, b long")

    large = member.filter(F.col("sets") > block_sets).withColumn("chunks", F.ceil(F.col("sets") / (block_sets // 2)).cast("long"))
    if large.isEmpty():
        out = cut(found)
        forget(member)
        return out
    large = large.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks")))
    hubs = large.withColumn("r", F.row_number().over(Window.partitionBy("block").orderBy("doc_id"))).filter(F.col("r") <= pivots)
    hubs = hubs.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    columns = ["block", "chunk", "doc_id", "n", "shared"]
    met = large.select(columns).unionByName(hubs.select(columns)).dropDuplicates(["block", "chunk", "doc_id"])
    first = cut(met.groupBy("block", "chunk").applyInPandas(lean_group(_join_blocks(percent)), "a long, b long"))

    known = components(first)
    large = large.join(known.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    by_root = large.groupBy("block", "root").agg(F.count("*").alias("c"))
    main = by_root.groupBy("block").agg(F.max(F.struct("c", "root")).alias("top")).select("block", F.col("top.root").alias("main"))
    large = cut(large.join(main, "block"))
    rest = large.filter("root <> main")
    rest_sized = rest.groupBy("block").agg(F.ceil(F.count("*") / (block_sets // 2)).cast("long").alias("parts"))
    rest = rest.join(rest_sized, "block").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("parts")))
    asked = rest.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select("block", "part", "chunk", "doc_id", "n", "shared", "root")
    others = large.join(rest_sized, "block").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    others = others.select(*(F.col(c).alias(c) for c in ("block", "part", "chunk", "doc_id", "n", "shared", "root")))  # columns of their own, not those of asked
    late = asked.groupBy("block", "part", "chunk").cogroup(others.groupBy("block", "part", "chunk")).applyInPandas(lean_group(_join_rest(percent)), "a long, b long")
    out = cut(found.unionByName(first).unionByName(late))
    forget(member, first, large)
    return out


def _classified(docs: DataFrame, n: int, percent: int, block_sets: int) -> DataFrame:
    """doc_id, n_shingles, text_key (a hash of the text), component_id and label (what names the component, also where all of its ids are null) of each row."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"))
    bits = bucket_bits(text_bytes(rows), 16 << 20)
    sketch = cut(rows.mapInArrow(lean(_sketch(n, bits)), ROWS))
    sets = cut(sketch.filter("kind = 0").select("a", "b")).mapInArrow(lean(_all_sets), SETS)  # without the texts, which go when they have been read
    classes = cut(sets.filter("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("least"), F.count("*").alias("times")))

    left = with_counts(sketch, _left_over(percent), "set_key binary, packed binary")
    reps = left.groupBy("set_key").agg(F.min("packed").alias("packed")).select(F.monotonically_increasing_id().alias("node"), "set_key", "packed")
    second = cut(reps.mapInArrow(lean(_second(n, bits)), ROWS))
    forget(sketch)
    ordered = cut(with_counts(second, _ordered(n, percent), ORDERED))
    names = cut(second.filter("kind = 0").select("a", "d")).mapInArrow(lean(_names), "node long, set_key binary")
    forget(second)
    linking = links(ordered, percent, block_sets)
    forget(ordered)
    root = components(linking)
    member = cut(root.join(names, "node").join(classes, "set_key").select("set_key", "root", "least"))
    by_root = member.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("held"))
    linked = spread_join(member.select("set_key", "root"), by_root, "root", "held", member.count())

    # only classes of several rows, or with links, say more than a row itself
    known = classes.join(linked.select("set_key", "root", "component"), "set_key", "left").filter("times > 1 or root is not null")
    known = known.select("set_key", "root", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component")).alias("component"), "times", F.lit(True).alias("known"))
    alone = F.encode(F.concat(F.lit("-"), F.xxhash64("doc_id", "text_key").cast("string")), "utf-8")
    keyed = sets.withColumn("set_key", F.when(F.col("n_shingles") > 0, F.col("set_key")).otherwise(alone))  # an empty set is no key that many rows share
    total = classes.agg(F.coalesce(F.sum("times"), F.lit(0))).head()[0]
    out = spread_join(keyed, known, "set_key", "times", total)
    label = F.when(F.col("root").isNotNull(), F.encode(F.col("root").cast("string"), "utf-8")).when(F.col("n_shingles") > 0, F.col("set_key"))
    return out.select("doc_id", "n_shingles", "text_key", F.when(F.col("known"), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), label.alias("label"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, block_sets: int = 1024) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of docs: components of links with 100 * overlap >= percent * union."""
    return _classified(docs, n, percent, block_sets).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs for each component, with all its columns: that of the smallest id (a null one is the largest), of equal ids that of the smallest hash of its text."""
    rows = _classified(docs, n, percent, 1024)
    empty = rows.filter("label is null").select(F.col("doc_id").isNull().alias("__none"), F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("text_key").alias("__text"), F.lit(None).cast("binary").alias("__label"))
    first = rows.filter("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("x"))
    keys = [F.col("x.none").alias("__none"), F.coalesce("x.doc_id", F.lit(0)).alias("__id"), F.col("x.text_key").alias("__text")]
    found = first.select(*keys, F.col("label").alias("__label")).unionByName(empty).groupBy("__none", "__id", "__text").agg(F.count("*").alias("__rows"))
    own = docs.withColumns({"__none": F.col("doc_id").isNull(), "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "__text": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    joined = own.join(found, ["__none", "__id", "__text"])
    nth = F.row_number().over(Window.partitionBy("__none", "__id", "__text").orderBy("__rows"))  # rows that repeat id and text: as many stay as there are components of them
    return joined.withColumn("__nth", nth).filter("__nth <= __rows").select(*(F.col(f"`{c}`") for c in docs.columns))
