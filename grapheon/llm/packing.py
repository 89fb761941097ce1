"""Best-fit packing of token sequences, improved by swaps.

Each document becomes the ids of its text followed by one end id. Documents longer than a
sequence are cut into pieces of full length; only the last may be shorter. Full pieces are
sequences of their own. The rest are dealt to shards by a hash of the document, so a shard
holds a bounded share of pieces however large one source is, and each shard is packed on
its own: best-fit decreasing, then a local search over all underfull bins, which are indexed by what they can take.

A move takes a piece from one bin to a fuller one, a one-for-one swap exchanges two pieces, a
two-for-one swap two pieces for one; each is made only if the sum of squared fills grows, so
nearly empty bins run empty and full ones fill up. The search stops once no bin can be
saved (the number of bins is the lower bound ceil(total / capacity)) or no step improves; nothing else bounds it.

Nulls: a null text is an empty text, so it is one piece that holds the end id; a null doc_id
counts as one more id. Rows that repeat a doc_id are documents of their own and each is packed.
An empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import bisect
import heapq
import json
import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grapheon.llm.common import KEPT, cut, lean, lean_group, slices

#: White space as the tokenizer sees it. Arrow's own split also cuts at U+001C to U+001F.
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
PIECES_SCHEMA = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


#: Words with one of these are encoded whole. Up to U+024F there are no combining marks, so other words are in normal form C, and their letters are lowered one by one (but U+0130 becomes two).
STRANGE = r"[\x1c-\x1f\x{0130}\x{0250}-\x{10ffff}]|<\|"
#: A tokenizer's own split of lower-case text, a fixed value, for texts up to U+024F, and line breaks; and the end of a piece that ends a part.
SPLIT = re.compile("'(?:s|t|re|ve|m|ll|d)|[^\\W\\d_²³¹¼½¾]+|[\\d²³¹¼½¾]|(?:[^\\w\\s]|_)+|\n")
LAST = "</w>"
#: What a tokenizer file must say for words to be encoded apart and split as above (fixed values); texts of any other are encoded whole.
BY_WORDS = {
    "truncation": None,
    "padding": None,
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class Ids:
    """The ids of texts as little-endian bytes.

    A tokenizer of the form BY_WORDS drops white space, never joins across it, and encodes each part of its own split on its own, so the ids of a text are
    those of its words, and theirs those of their parts. Arrow splits a slice of texts, finds its distinct words, and looks them up among those kept (the
    ones seen last, `keep` of them); the distinct parts of the others are encoded, many to a call, and cut apart where a part's last id says so. Arrow then puts all
    together. Texts for any other tokenizer are encoded whole.
    """

    def __init__(self, path: str, keep: int = 400_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        added = all("<|" in t["content"] and not SPACE.search(t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in said["added_tokens"])
        self.by_words = added and all(said.get(k) == v for k, v in BY_WORDS.items()) and said["model"].get("end_of_word_suffix") == LAST
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.keep = keep
        self.known, self.known_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        vocabulary = self.tokenizer.get_vocab() if self.by_words else {}
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that end a part
        self.last[[i for x, i in vocabulary.items() if x.endswith(LAST)]] = True

    def __call__(self, texts: list[str]) -> list[bytes]:
        data, at = self.joined(pa.array(texts, pa.string()))
        return [bytes(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]

    def joined(self, texts: pa.Array) -> tuple[memoryview, list[int]]:
        """The ids of all texts, end to end, and where each one's begin, and the end. A null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ids, ends = self._by_words(texts) if self.by_words else (self._each(texts.to_pylist()), np.arange(len(texts) + 1))
        return memoryview(ids.buffers()[2] or b""), _offsets(ids)[ends].tolist()

    def _each(self, texts: list[str]) -> pa.Array:
        return pa.array([array("I", e.ids).tobytes() for e in self.encode(texts, add_special_tokens=False)], pa.large_binary())

    def _by_words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ids of words, and the first word of each text, and the end."""
        chars = texts.buffers()[2]
        if chars is not None and (np.frombuffer(chars, np.uint8) - np.uint8(0x1C) < 4).any():
            split = pa.array([SPACE.split(t) for t in texts.to_pylist()], pa.list_(pa.large_string()))
        else:
            split = pc.utf8_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary
        at = pc.index_in(distinct, value_set=self.known)
        missing = at.is_null()
        places = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(missing.to_numpy(zero_copy_only=False))
        places[new] = len(self.known) + np.arange(len(new))
        ids = pa.concat_arrays([self.known_ids, self._words(distinct.filter(missing))]).take(pa.array(places))
        if len(new):
            rest = np.ones(len(self.known), bool)
            rest[at.drop_null().to_numpy()] = False
            rest = pa.array(rest)
            short = pc.less_equal(pc.binary_length(distinct), 64)
            self.known = pa.concat_arrays([distinct.filter(short), self.known.filter(rest)])[: self.keep]
            self.known_ids = pa.concat_arrays([ids.filter(short), self.known_ids.filter(rest)])[: self.keep]
        return ids.take(coded.indices), split.offsets.to_numpy() - split.offsets[0].as_py()

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words."""
        odd = pc.match_substring_regex(words, STRANGE)
        plain = words.filter(pc.invert(odd)).to_pylist()
        out = self._plain(plain) if plain else pa.array([], pa.large_binary())
        if len(plain) == len(words):
            return out
        apart = self._each(words.filter(odd).to_pylist())
        odd = odd.to_numpy(zero_copy_only=False)
        return pa.concat_arrays([out, apart]).take(pa.array(np.where(odd, len(plain) + np.cumsum(odd) - 1, np.cumsum(~odd) - 1)))

    def _plain(self, words: list[str]) -> pa.Array:
        coded = pa.array(SPLIT.findall("\n".join(words).lower())).cast(pa.large_string()).dictionary_encode()  # a line break after each word
        parts = coded.dictionary.to_pylist()
        here = [x for x in parts if x != "\n"]
        found = self.encode([" ".join(here[i : i + 512]) for i in range(0, len(here), 512)], add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, "<u4") for e in found]) if found else np.zeros(0, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(here):
            raise ValueError("the tokenizer splits a part")
        sizes = np.zeros(len(parts), np.int64)
        sizes[[x != "\n" for x in parts]] = 4 * np.diff(ends, prepend=0)
        each = _binary(np.concatenate([[0], np.cumsum(sizes)]), ids.tobytes()).take(coded.indices)
        breaks = np.flatnonzero(pc.equal(coded, "\n").to_numpy(zero_copy_only=False))
        offsets = _offsets(each)
        return _binary(np.concatenate([offsets[:1], offsets[breaks], offsets[-1:]]), each.buffers()[2])


def _offsets(a: pa.Array) -> np.ndarray:
    """Where the values of a large binary array begin in its buffer, and the end."""
    return np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)


def _binary(offsets: np.ndarray, data: bytes | pa.Buffer | None) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), data if isinstance(data, pa.Buffer) else pa.py_buffer(data or b"")])


@lru_cache(1)
def ids_of(path: str) -> Ids:
    """One for all packing tasks that a Python worker runs, so that each doesn't load the file and meet all words anew. Tasks of other operators drop it."""
    return Ids(path)


KEPT["packing"] = ids_of.cache_clear


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of documents: doc_id, row (tells rows of one doc_id apart), piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        full = 4 * capacity
        for part in slices(batches, most=16_000_000):
            which, piece, start, length, crc = [], [], [], [], []
            data, at = ids.joined(part.column(2))
            for doc, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                k = 0
                while b - a >= full:
                    which.append(doc)
                    piece.append(k)
                    start.append(k * capacity)
                    length.append(capacity)
                    crc.append(zlib.crc32(data[a : a + full]))
                    a, k = a + full, k + 1
                which.append(doc)
                piece.append(k)
                start.append(k * capacity)
                length.append((b - a) // 4 + 1)
                crc.append(zlib.crc32(end, zlib.crc32(data[a:b])))
            which = pa.array(which, pa.int64())
            columns = [part.column(0).take(which), part.column(1).take(which), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run, "packing"), PIECES_SCHEMA)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece into the fullest bin that it fits."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins with so much room
    rooms: list[int] = []  # sorted, those that have bins
    bins: list[list[int]] = []
    for i in order:
        need = lengths[i]
        at = bisect.bisect_left(rooms, need)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        room -= need
        if room:
            if not by_room[room]:
                bisect.insort(rooms, room)
            by_room[room].append(b)
    return bins


class Takers:
    """Underfull bins by what they can take: for each length that a bin could give back (nothing, a piece, or two), the bins' rooms in order.

    A bin of room r that gives back s takes a piece of length x in s + 1 .. s + r, and is fuller afterwards.
    """

    def __init__(self, capacity: int):
        self.by_back: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (room, bin), sorted
        self.most = np.full(capacity + 1, -1, np.int64)  # the largest room of each
        self.held: dict[int, tuple[int, list[int]]] = {}

    def put(self, b: int, room: int, sizes: list[int]) -> None:
        one = np.unique(np.array(sizes, np.int64))
        counts = Counter(sizes)
        first, second = np.triu_indices(len(one), 1)
        two = np.concatenate([one[first] + one[second], [2 * x for x, n in counts.items() if n > 1]]).astype(np.int64)
        backs = np.unique(np.concatenate([[0], one, two[two < len(self.most)]])).astype(np.int64).tolist()
        self.held[b] = (room, backs)
        for s in backs:
            bisect.insort(self.by_back[s], (room, b))
            self.most[s] = self.by_back[s][-1][0]

    def drop(self, b: int) -> None:
        room, backs = self.held.pop(b)
        for s in backs:
            rooms = self.by_back[s]
            rooms.pop(bisect.bisect_left(rooms, (room, b)))
            self.most[s] = rooms[-1][0] if rooms else -1

    def find(self, x: int, giver: int, room: int) -> tuple[int, int] | None:
        """The fullest bin that takes a piece of length x, no emptier than the giver (which has so much room), and the least length that it gives back."""
        best = None
        for s in np.flatnonzero(self.most[:x] >= np.arange(x, 0, -1)).tolist():
            rooms = self.by_back[s]
            at = bisect.bisect_left(rooms, (x - s, -1))
            if rooms[at][1] == giver:
                at += 1
            if at < len(rooms) and rooms[at][0] <= room and (best is None or rooms[at][0] < best[0]):
                best = (*rooms[at], s)
        return best and best[1:]


def _of_sum(held: list[int], lengths: list[int], s: int) -> list[int]:
    """At most two of the pieces, of total length s."""
    if not s:
        return []
    by_length = {lengths[j]: j for j in held}
    if s in by_length:
        return [by_length[s]]
    return next([j, by_length[s - lengths[j]]] for j in held if by_length.get(s - lengths[j], j) != j)


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Swaps and moves between underfull bins while the sum of squared fills grows.

    The emptiest bin gives: its pieces are moved to, or swapped against shorter pieces (one or
    two) of, fuller bins. Each step raises the squared fill, so the search ends.
    """
    bins = [list(b) for b in bins if b]
    fill = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    count = len(bins)
    if count <= least:
        return bins
    takers = Takers(capacity)
    for k in range(len(bins)):
        if fill[k] < capacity:
            takers.put(k, capacity - fill[k], [lengths[i] for i in bins[k]])
    giving = [(fill[k], k) for k in takers.held]  # a heap; entries of bins whose fill has changed are stale
    heapq.heapify(giving)
    stuck: dict[int, set[int]] = {}  # bins that can't give now, with their pieces' lengths
    while count > least and giving:
        at, g = heapq.heappop(giving)
        if g not in takers.held or fill[g] != at or g in stuck:
            continue
        sizes = {lengths[i]: i for i in bins[g]}
        for x in sorted(sizes, reverse=True):
            if found := takers.find(x, g, capacity - at):
                break
        else:
            stuck[g] = set(sizes)
            continue
        t, s = found
        i, back = sizes[x], _of_sum(bins[t], lengths, s)
        bins[g] = [j for j in bins[g] if j != i] + back
        bins[t] = [j for j in bins[t] if j not in back] + [i]
        fill[g] -= x - s
        fill[t] += x - s
        count -= not bins[g]
        taken: set[int] = set()
        for k in (g, t):
            takers.drop(k)
            stuck.pop(k, None)
            if bins[k] and fill[k] < capacity:
                room = capacity - fill[k]
                takers.put(k, room, [lengths[j] for j in bins[k]])
                heapq.heappush(giving, (fill[k], k))
                for y in takers.held[k][1]:
                    taken.update(range(y + 1, y + room + 1))
        for k in [k for k, has in stuck.items() if not has.isdisjoint(taken)]:  # only what has changed can take a piece that nothing took before
            del stuck[k]
            heapq.heappush(giving, (fill[k], k))
    return [b for b in bins if b]


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices into lengths: best-fit decreasing, then the local search over all underfull bins."""
    bins = best_fit(lengths, capacity)
    bins.sort(key=lambda b: -sum(lengths[i] for i in b))
    return improve(bins, lengths, capacity)


def _shards(capacity: int, digits: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        order = group.select(["doc_id", "row", "piece"]).to_pandas().sort_values(["doc_id", "row", "piece"], kind="stable").index.to_numpy()
        group = group.take(pa.array(order))
        lengths = group.column("length").to_pylist()
        n = len(lengths)
        seq, off, room = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for b, held in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in held:
                seq[i], off[i] = (key[0].as_py() << digits) + b, at
                at += lengths[i]
            room[held] = capacity - at
        for name, values in (("sequence_id", seq), ("offset", off), ("room", room)):
            group = group.append_column(name, pa.array(values))
        return group

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, shard_pieces: int = 16_384) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    shard_pieces: the pieces are counted, and dealt to shards of about so many. They are rows of numbers, so the checkpoint that the count reads is small.
    """
    found = cut(pieces(docs, tokenizer, capacity, end_id))
    shards = max(1, -(-found.count() // shard_pieces))
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(shards)).cast("long"))
    schema = PIECES_SCHEMA + ", shard long, sequence_id long, offset long, room long"
    packed = dealt.groupBy("shard").applyInArrow(lean_group(_shards(capacity, 32)), schema)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packed.select(*columns)
