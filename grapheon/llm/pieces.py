"""Piece encoding and decoding: Viterbi over a piece vocabulary, with forward scores shared by common prefixes.

A space is put before a text, and it is cut before each space that follows something else, so a word is a run of spaces and what comes after it; the
vocabulary's mark U+2581 stands for a space. The distinct words of a slice of documents that aren't known yet are sorted, which walks their trie depth-first: a
word keeps the forward scores, back links and open vocabulary matches of the prefix that it shares with the word before, and goes on from there. Open matches
walk the trie of pieces along, so a step looks only at pieces that can still end. A word's segmentation is the one of largest total score, ties to the
longer last piece; no piece of the supplied vocabulary has a mark after another character, so the words' best sums make up the text's. (Of another vocabulary such
pieces aren't used.) Characters that no piece covers, and marks that a text holds itself, become byte pieces, so that decoding gives back every text exactly.
Scores are the vocabulary's own; with a merge-ranked vocabulary the best sum of scores need not be the result of the merges.

Nulls: a null text is an empty text, without ids; a null doc_id stays null. Repeated rows are encoded each. Columns other than doc_id and text are
ignored. An empty table gives an empty result. Long texts without spaces are one word, which takes memory in proportion.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grapheon.llm.common import slices

MARK = "▁"
WORD = re.compile(" +[^ ]*")
ENCODED = "doc_id long, n_words long, n_ids long, ids_crc32 long, ids binary"
REPORT = "doc_id long, n_words long, n_ids long, ids_crc32 long, decoded_sha256 string, exact boolean"


class Pieces:
    """Vocabulary of a model file, as a trie for encoding and as bytes for decoding."""

    def __init__(self, path: str, keep: int = 300_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.trie: dict = {}
        self.byte: list[int] = [0] * 256
        self.raw: list[bytes] = []
        least = 0.0
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
                continue
            self.raw.append(piece.replace(MARK, " ").encode())
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or MARK in piece.lstrip(MARK):
                continue
            node = self.trie
            for c in piece.replace(MARK, " "):
                node = node.setdefault(c, {})
            node[""] = (sp.get_score(i), i)
            least = min(least, sp.get_score(i))
        self.rare = least - 10.0  # of a byte piece
        self.keep = keep
        self.held: dict[str, bytes] = {}

    def learn(self, words: Iterable[str]) -> None:
        """Encode words, sorted, so that neighbours share their forward passes."""
        trie, byte, rare = self.trie, self.byte, self.rare
        before = ""
        best: list[float] = [0.0]
        link: list[tuple[int, bytes]] = [(0, b"")]
        opened: list[list] = [[]]
        for word in sorted(words):
            n = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                n += 1
            del best[n + 1 :], link[n + 1 :], opened[n + 1 :]
            for j in range(n, len(word)):
                c = word[j]
                score, back, still = -1e300, None, []
                for start, node in (*opened[j], (j, trie)):
                    node = node.get(c)
                    if node is not None:
                        still.append((start, node))
                        end = node.get("")
                        if end is not None and best[start] + end[0] > score:
                            score, back = best[start] + end[0], (start, end[1].to_bytes(4, "little"))
                if score < best[j] + rare:
                    data = c.encode()
                    low = best[j] + rare * len(data)
                    if low > score:
                        score, back = low, (j, b"".join(byte[x].to_bytes(4, "little") for x in data))
                best.append(score)
                link.append(back)
                opened.append(still)
            at, out = len(word), []
            while at:
                at, ids = link[at]
                out.append(ids)
            self.held[word] = b"".join(reversed(out))
            before = word

    def encode(self, texts: list[str]) -> list[tuple[int, bytes]]:
        """For each text the number of words and the ids as little-endian uint32."""
        split = [WORD.findall(" " + t) if t else [] for t in texts]
        if len(self.held) > self.keep:
            self.held.clear()
        new = {w for ws in split for w in ws}.difference(self.held)
        self.learn(new)
        held = self.held
        out = [(len(ws), b"".join([held[w] for w in ws])) for ws in split]
        for w in new:
            if len(w) > 64:
                del held[w]
        return out

    def decode(self, ids: bytes) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
        return text[1:]  # the first mark


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_words, n_ids, ids_crc32 and ids (little-endian uint32) of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for part in slices(batches):
            got = pieces.encode([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([n for n, _ in got], pa.int64()), pa.array([len(b) // 4 for _, b in got], pa.int64()), pa.array([zlib.crc32(b) for _, b in got], pa.int64()), pa.array([b for _, b in got], pa.binary())],
                names=["doc_id", "n_words", "n_ids", "ids_crc32", "ids"],
            )

    return _columns(docs).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of each row of encoded (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for part in slices(batches, "ids"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([pieces.decode(b or b"") for b in part.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """Encode each row of docs, decode the ids again, and compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for part in slices(batches):
            texts = [t or "" for t in part.column(1).to_pylist()]
            rows: list[list] = [[], [], [], [], []]
            for text, (n, ids) in zip(texts, pieces.encode(texts), strict=True):
                again = pieces.decode(ids)
                for column, x in zip(rows, (n, len(ids) // 4, zlib.crc32(ids), hashlib.sha256(again.encode()).hexdigest(), again == text), strict=True):
                    column.append(x)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(rows, types, strict=True))], names=["doc_id", "n_words", "n_ids", "ids_crc32", "decoded_sha256", "exact"])

    return _columns(docs).mapInArrow(run, REPORT)
