"""Quality classifier without labels: a weak-label model over heuristic labellers, and a hashed linear scorer.

Labellers vote good (1), bad (0) or nothing (2) on each document. Votes of all documents are counted by pattern; there are 3 ** 7 patterns
at most, so the counts fit on the driver whatever the corpus. Expectation-maximisation over these counts estimates how often good documents are
and, for each labeller, how it votes on good and on bad documents; labellers are taken as independent given the class. Posteriors
of patterns are the labels of a bounded sample (`most` documents of at most `longest` characters, those with the least hash of their id), on which a linear scorer is trained
with hashed features: words and word shapes, averaged over the document, and what each labeller saw (its vote). It scores all documents. Texts of the same words and
votes have the same score; a tie with the threshold is kept. A text is taken whole, with a few numbers a word.

Nulls: a null text is an empty text; a text without words scores 0 and isn't kept; a null doc_id stays null. Repeated rows are scored each. With a
corpus that no labeller splits, all posteriors are one class's. Columns other than doc_id and text are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grapheon.llm.common import slices

GOOD, BAD, NONE = 1, 0, 2
LABELLERS = ("odd", "shout", "pairs", "mean", "repeated", "stops", "marked")
BITS = 16
PLAIN = bytes(range(128, 256)) + b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \t\r\n.,"
SCORES = "doc_id long, weak_label double, score double, keep boolean"


def votes(text: str) -> tuple[int, ...]:
    """One vote of each labeller."""
    words = text.split()
    n = len(words)
    if not n:
        return (NONE,) * 7
    odd = len(text.encode("utf-8", "replace").translate(None, PLAIN)) / len(text)
    shout = sum([w.isupper() and len(w) > 2 for w in words]) / n
    pairs = sum([a == b for a, b in zip(words, words[1:], strict=False)]) / n
    mean = (len(text) - n) / n
    lines = text.split("\n")
    repeated = 1 - len(set(lines)) / len(lines)
    stops = (text.count(". ") + text.count(".\n") + text.endswith(".")) / n
    marked = sum([not w[-1].isalnum() and w[-1] not in ".,;:?!\"')" for w in words]) / n
    enough = n >= 20
    return (
        BAD if odd > 0.05 else GOOD if odd < 0.02 else NONE,
        BAD if shout > 0.1 else GOOD if shout < 0.02 else NONE,
        BAD if pairs > 0.12 else GOOD if pairs < 0.06 else NONE,
        BAD if mean < 2 or mean > 14 else GOOD if 3 < mean < 10 else NONE,
        (BAD if repeated > 0.45 else GOOD if repeated < 0.35 else NONE) if len(lines) > 3 else NONE,
        (BAD if stops < 0.005 else GOOD if 0.02 < stops < 0.4 else NONE) if enough else NONE,
        BAD if marked > 0.1 else GOOD if marked < 0.02 else NONE,
    )


def pattern(text: str) -> int:
    code = 0
    for v in votes(text):
        code = 3 * code + v
    return code


def accuracies(counts: dict[int, int], post: dict[int, float], labellers: int = 7) -> list[dict[str, float]]:
    """Of each labeller the share of its votes that the posteriors take for right, on good and on bad documents, and how often it votes."""
    out = []
    for k in range(labellers):
        vote = {c: c // 3 ** (labellers - 1 - k) % 3 for c in counts}
        mass = lambda v, good, vote=vote: sum(n * (post[c] if good else 1 - post[c]) for c, n in counts.items() if vote[c] in v)
        good, bad = mass((GOOD, BAD), True), mass((GOOD, BAD), False)
        out.append({"on_good": mass((GOOD,), True) / good if good else 0.0, "on_bad": mass((BAD,), False) / bad if bad else 0.0, "votes": (good + bad) / max(1, sum(counts.values()))})
    return out


def label_model(counts: dict[int, int], labellers: int = 7, rounds: int = 100) -> dict[int, float]:
    """Posterior of good for each pattern that occurs, from the counts of patterns."""
    if not counts:
        return {}
    codes = np.array(sorted(counts))
    weight = np.array([counts[c] for c in codes], float)
    v = np.stack([codes // 3 ** (labellers - 1 - k) % 3 for k in range(labellers)], axis=1)
    # start from majority votes
    post = ((v == GOOD).sum(axis=1) + 1.0) / ((v != NONE).sum(axis=1) + 1.5)
    post = np.clip(post, 0.02, 0.98)
    for _ in range(rounds):
        share = np.clip((weight * post).sum() / weight.sum(), 0.01, 0.99)
        log_good, log_bad = np.full(len(codes), np.log(share)), np.full(len(codes), np.log(1 - share))
        for k in range(labellers):
            for to, p in ((log_good, post), (log_bad, 1 - post)):
                table = np.array([(weight * p)[v[:, k] == x].sum() + 1.0 for x in range(3)])
                to += np.log(table / table.sum())[v[:, k]]
        new = 1 / (1 + np.exp(np.clip(log_bad - log_good, -50, 50)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    # good is the class on which more labellers vote good than bad
    lean = (((v == GOOD).sum(axis=1) - (v == BAD).sum(axis=1)) * weight * (2 * post - 1)).sum()
    return dict(zip(codes.tolist(), (post if lean >= 0 else 1 - post).tolist(), strict=True))


SHAPE = (re.compile(r"[^\W\d_]+"), re.compile(r"\d+"))


def features(word: str) -> tuple[int, int]:
    """Hashed word and shape (letters to a or A, digits to 0)."""
    shape = SHAPE[1].sub("0", SHAPE[0].sub(lambda m: "A" if m.group().isupper() else "Aa" if m.group()[0].isupper() else "a", word))
    mask = (1 << BITS) - 1
    return zlib.crc32(("w" + word.lower()).encode("utf-8", "replace")) & mask, zlib.crc32(("s" + shape).encode("utf-8", "replace")) & mask


def vote_features(code: int, labellers: int = 7) -> list[int]:
    """Hashed votes of a pattern."""
    mask = (1 << BITS) - 1
    return [zlib.crc32(f"v{k}={code // 3 ** (labellers - 1 - k) % 3}".encode()) & mask for k in range(labellers)]


def train(texts: list[str], labels: np.ndarray, rounds: int = 120, rate: float = 0.3, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on averaged hashed features, with soft labels."""
    vocabulary: dict[str, int] = {}
    words = [t.split() for t in texts]
    ids = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for ws in words for w in ws), np.int64)
    sizes = np.array([len(w) for w in words])
    weights, bias = np.zeros(1 << BITS), 0.0
    if not len(ids):
        return weights, bias
    f = np.array([features(w) for w in vocabulary])
    seen = np.array([vote_features(pattern(t)) for t in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    per = 1.0 / np.maximum(sizes, 1)
    m1, m2, b1, b2 = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(doc, weights[f].sum(axis=1)[ids], len(texts)) * per + weights[seen].sum(axis=1) + bias
        error = (labels - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) / len(texts)
        g = np.bincount(ids, (error * per)[doc], len(vocabulary))
        grad = np.bincount(f.ravel(), np.repeat(g, 2), 1 << BITS) + np.bincount(seen.ravel(), np.repeat(error, seen.shape[1]), 1 << BITS) - ridge * weights / len(texts)
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        weights += rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-6)
        b1, b2 = 0.9 * b1 + 0.1 * error.sum(), 0.99 * b2 + 0.01 * error.sum() ** 2
        bias += rate * (b1 / (1 - 0.9**t)) / (np.sqrt(b2 / (1 - 0.99**t)) + 1e-6)
    return weights, float(bias)


class WordWeights(dict):
    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > 500_000:
            self.clear()
        a, b = features(word)
        out = float(self.weights[a] + self.weights[b])
        if len(word) <= 64:
            self[word] = out
        return out


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        yield pa.RecordBatch.from_arrays([pa.array([pattern(t or "") for t in part.column(1).to_pylist()], pa.int32())], names=["code"])


@dataclass(frozen=True)
class Model:
    """posteriors: of good, by pattern; accuracies: by labeller, see `accuracies`; share: of good documents; weights, bias: of the scorer."""

    posteriors: dict[int, float]
    accuracies: list[dict[str, float]]
    share: float
    weights: np.ndarray
    bias: float

    def table(self, spark: SparkSession) -> DataFrame:
        """labeller, on_good, on_bad (shares of right votes) and votes (share of documents that it votes on)."""
        rows = [(name, a["on_good"], a["on_bad"], a["votes"]) for name, a in zip(LABELLERS, self.accuracies, strict=True)]
        return spark.createDataFrame(rows, "labeller string, on_good double, on_bad double, votes double")


def fit(docs: DataFrame, most: int = 3000, longest: int = 20_000) -> Model:
    rows = _columns(docs)
    counts = {r["code"]: r["count"] for r in rows.mapInArrow(_patterns, "code int").groupBy("code").count().collect()}
    post = label_model(counts)
    # ids first, so that no more than `most` of them, and then no more than `most` texts, come to the driver
    fits = (F.length("text") > 0) & (F.length("text") <= longest)
    ids = rows.filter(fits & F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    keys = rows.sparkSession.createDataFrame([(r["doc_id"],) for r in ids], "doc_id long")
    chosen = rows.filter(fits).join(F.broadcast(keys), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id")
    texts = [r["text"] for r in chosen.collect()]
    weights, bias = train(texts, np.array([post.get(pattern(t), 0.5) for t in texts]))
    share = sum(n * post[c] for c, n in counts.items()) / max(1, sum(counts.values()))
    return Model(post, accuracies(counts, post), share, weights, bias)


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, weak_label (posterior of the labellers), score, keep of each row of docs."""
    weights, bias, post = model.weights, model.bias, model.posteriors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, voted = WordWeights(weights), {}
        for part in slices(batches):
            texts = [t or "" for t in part.column(1).to_pylist()]
            words = [t.split() for t in texts]
            sizes = np.array([len(w) for w in words])
            each = np.fromiter(map(held.__getitem__, chain.from_iterable(words)), np.float64)
            codes = [pattern(t) for t in texts]
            for code in set(codes).difference(voted):
                voted[code] = float(weights[vote_features(code)].sum())
            z = np.bincount(np.repeat(np.arange(len(texts)), sizes), each, len(texts)) / np.maximum(sizes, 1) + np.array([voted[c] for c in codes]) + bias
            score = np.where(sizes > 0, 1 / (1 + np.exp(-np.clip(z, -50, 50))), 0.0)
            weak = [post.get(c, 0.5) for c in codes]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(weak, pa.float64()), pa.array(score), pa.array(score >= threshold)], names=["doc_id", "weak_label", "score", "keep"])

    return _columns(docs).mapInArrow(run, SCORES)


def quality_scores(docs: DataFrame, most: int = 3000, longest: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """Fit on docs, and score them."""
    return score(docs, fit(docs, most, longest), threshold)
