"""Toxicity: a two-state linear-chain CRF over words; marginals give document scores and spans.

Training reads a bounded sample (`most` labelled documents of each class, those with the least hash of
their id, of at most `longest` characters). Document labels are turned to word labels with a lexicon of the sample: a
word of a toxic document is labelled toxic if it, or one of its beginnings, is far more frequent among toxic documents' words than
among those of others. The CRF has hashed features of a word (the word, its beginnings and endings, whether it holds digits), one weight vector of
fixed size, a start weight and a 2 x 2 transition matrix; it is trained on log-likelihood by gradients from
forward-backward marginals. A document's score is a logistic function of its largest marginal and of its expected number of
toxic words, in all and for each word, fitted on the same sample.

Forward and backward passes run over a flat array of words of many documents: the passes are products of
2 x 2 matrices, taken in blocks, with a matrix that forgets the past at each document's start. A text of more than SLICE characters is taken on its own, block by
block, so beyond the text and its offsets it takes a few numbers a word.

Nulls: a null text is an empty text and gets the score of a text without words; a null label is no label; a null doc_id
is scored. Texts with the same words get the same score: a tie has no order. Offsets are those of the text as given. Labels of a repeated doc_id are united (toxic if any is). Repeated rows are scored each. With no label of either class
all scores are 0. Empty tables give empty results. Labels, language, source and ids are no input of a score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grapheon.llm.common import lean, slices

WORD = re.compile(r"[^\W_]+")
BITS = 18
#: Lengths of the beginnings that the lexicon looks at.
LENGTHS = (3, 4, 5, 6, 7)
#: Bytes of text that are scored together; their words' matrices take some 100 times as much.
SLICE = 1_500_000
SCORES_SCHEMA = "doc_id long, score double, n_toxic long, spans string"


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word."""
    mask = (1 << BITS) - 1
    names = ["w" + word, "p3" + word[:3], "p4" + word[:4], "p5" + word[:5], "p6" + word[:6], "s3" + word[-3:], "d" + str(word.isalpha())]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) & mask for x in names]


@dataclass
class Model:
    weights: np.ndarray  # of the features, for the toxic state; the other state has none
    chain: np.ndarray  # log weights of transitions, [from, to]
    start: np.ndarray
    head: np.ndarray  # of the document score: bias, largest marginal's logit, log1p of the expected count

    def emission(self, word: str) -> float:
        return float(self.weights[features(word)].sum())


class Emissions(dict):
    """Emissions of the words seen so far."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        out = self[word] = self.model.emission(word)
        return out


def _products(m: np.ndarray) -> np.ndarray:
    """Prefix products m[0] @ ... @ m[i], each scaled to a largest entry of 1. m: n x 2 x 2, as (4, n)."""
    n = m.shape[1]
    if n <= 64:
        out = m.copy()
        for i in range(1, n):
            out[:, i] = _mul(out[:, i - 1], m[:, i])
        return out
    width = 64
    blocks = -(-n // width)
    padded = np.zeros((4, blocks * width))
    padded[0], padded[3] = 1, 1
    padded[:, :n] = m
    x = np.ascontiguousarray(padded.reshape(4, blocks, width).transpose(2, 0, 1))
    for i in range(1, width):
        x[i] = _mul(x[i - 1], x[i])
    ends = _products(x[-1])
    before = np.concatenate([np.array([[1.0], [0], [0], [1]]), ends[:, :-1]], axis=1)
    x = _mul(before[None].transpose(1, 0, 2), x.transpose(1, 0, 2))
    return x.transpose(0, 2, 1).reshape(4, -1)[:, :n]


def _mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.stack([a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3]])
    return out / np.maximum(out.max(axis=0, keepdims=True), 1e-300)


def marginals(e: np.ndarray, first: np.ndarray, chain: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each word, and the expected transitions (n x 4) into it (0 at a document's first word).

    e: emissions of the toxic state; first: whether the word starts a document.
    """
    n = len(e)
    c, s = np.exp(chain - chain.max()), np.exp(start - start.max())
    e = np.clip(e, -30, 30)
    emit = np.stack([np.exp(-np.maximum(e, 0)), np.exp(np.minimum(e, 0))])  # (1, exp e), scaled
    m = np.empty((4, n))
    for i in range(2):
        for j in range(2):
            m[2 * i + j] = np.where(first, s[j], c[i, j]) * emit[j]
    ahead = _products(m)
    alpha = ahead[:2] + ahead[2:]  # (1, 1) times the product; the first word's matrix forgets which
    alpha /= alpha.sum(axis=0)
    # backward: beta[t] = M[t+1] beta[t+1]; past a document's end 1
    back = np.empty((4, n))
    last = np.append(first[1:], True)
    for i in range(2):
        for j in range(2):
            step = np.append(c[i, j] * emit[j][1:], 1.0)
            back[2 * j + i] = np.where(last, 1.0, step)  # transposed, for products from the right end
    behind = _products(back[:, ::-1])[:, ::-1]
    beta = behind[:2] + behind[2:]
    beta /= beta.sum(axis=0)
    both = alpha * beta
    p = both[1] / both.sum(axis=0)
    pair = np.zeros((4, n))
    for i in range(2):
        for j in range(2):
            pair[2 * i + j, 1:] = alpha[i, :-1] * c[i, j] * emit[j][1:] * beta[j, 1:]
    pair[:, first] = 0
    total = pair.sum(axis=0)
    return p, pair / np.where(total > 0, total, 1)


def _summary(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Features of the document score: a bias, the largest marginal's logit, and how many toxic words are expected, in all and for each word. bounds: first word of each document, and the end."""
    words = np.diff(bounds)
    top, sums = np.zeros(len(words)), np.zeros(len(words))
    full = np.flatnonzero(words > 0)
    if len(full):
        top[full] = np.maximum.reduceat(p, bounds[full])
        sums[full] = np.add.reduceat(np.where(p > 0.05, p, 0), bounds[full])
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(len(top)), np.log(top / (1 - top)) / 4, np.log1p(sums), np.log(sums / (words + 10) + 1e-3)], axis=1)


def lexicon(documents: list[list[str]], toxic: np.ndarray, least: int = 3, times: float = 10.0, surprise: float = 3.0, most: int = 3) -> set[str]:
    """Words and beginnings (with a trailing *) that mark toxic documents.

    A word's occurrences (`most` of a document at most, so that no long document decides) are split between the classes by the classes' shares
    of all words if it marks nothing. It is taken if it is `times` as frequent among toxic documents' words as among the others', and its split is so unlikely
    (Chernoff bound) that over the whole vocabulary fewer than exp(-surprise) such words are expected by chance.
    """
    counts: dict[str, list[int]] = {}
    holders: Counter[str] = Counter()
    mass = [1, 1]
    for words, bad in zip(documents, toxic, strict=True):
        mass[int(bad)] += len(words)
        held: Counter[str] = Counter()
        for w, n in Counter(words).items():
            held[w] += n
            for k in LENGTHS:
                if len(w) > k:
                    held[w[:k] + "*"] += n
        for x, n in held.items():
            counts.setdefault(x, [0, 0])[int(bad)] += min(n, most)
        if bad:
            holders.update(held.keys())
    share = mass[1] / sum(mass)
    need = np.log(max(1, len(counts))) + surprise
    out = set()
    for x, (clean, bad) in counts.items():
        n, seen = clean + bad, bad / (clean + bad)
        if holders[x] >= least and bad * mass[0] >= times * clean * mass[1]:
            far = seen * np.log(seen / share) + ((1 - seen) * np.log((1 - seen) / (1 - share)) if clean else 0)
            if n * far > need:
                out.add(x)
    return out


def train(texts: list[str], toxic: list[bool], rounds: int = 40, rate: float = 0.2, ridge: float = 1e-6) -> Model:
    bad = np.array(toxic, bool)
    words = [_words(t) for t in texts]
    model = Model(np.zeros(1 << BITS), np.array([[0.0, -30], [0, -30]]), np.array([0.0, -30]), np.array([-30.0, 0, 0, 0]))  # without labels nothing is toxic
    if not bad.any() or bad.all():
        return model
    marks = lexicon(words, bad)
    vocabulary: dict[str, int] = {}
    ids = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for ws in words for w in ws), np.int64)
    if not len(ids):
        return model
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    hit = np.array([w in marks or any(w[:k] + "*" in marks for k in LENGTHS if len(w) > k) for w in vocabulary])
    y = hit[ids] & np.repeat(bad, np.diff(bounds))
    first = np.zeros(len(ids), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    f = np.array([features(w) for w in vocabulary])
    n = len(ids)
    pairs = np.bincount((2 * y[:-1] + y[1:])[~first[1:]], minlength=4).reshape(2, 2)
    starts = np.bincount(y[first], minlength=2)
    model.chain = np.log((pairs + 0.5) / n)
    model.start = np.log((starts + 0.5) / max(1, first.sum()))
    # gradients scaled per parameter (Adam); the classes are far from balanced, so steps aren't by raw counts
    w, m1, m2 = model.weights, np.zeros(1 << BITS), np.zeros(1 << BITS)
    v1, v2 = np.zeros(6), np.zeros(6)
    size = max(1, int(y.sum()))
    for t in range(1, rounds + 1):
        p, pair = marginals(w[f].sum(axis=1)[ids], first, model.chain, model.start)
        g = np.bincount(ids, y - p, len(vocabulary)) / size
        grad = np.bincount(f.ravel(), np.repeat(g, f.shape[1]), 1 << BITS) - ridge * w
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        w += rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-5)
        extra = np.concatenate([(pairs.ravel() - pair.sum(axis=1)) / n, [(starts[0] - (1 - p[first]).sum()) / n, (starts[1] - p[first].sum()) / n]])
        v1, v2 = 0.9 * v1 + 0.1 * extra, 0.99 * v2 + 0.01 * extra**2
        step = 0.05 * (v1 / (1 - 0.9**t)) / (np.sqrt(v2 / (1 - 0.99**t)) + 1e-5)
        model.chain = model.chain + step[:4].reshape(2, 2)
        model.start = model.start + step[4:]
    p, _ = marginals(w[f].sum(axis=1)[ids], first, model.chain, model.start)
    x = _summary(p, bounds)
    weight = np.where(bad, 0.5 / bad.sum(), 0.5 / (~bad).sum())
    h = np.zeros(4)
    for _ in range(30):  # Newton steps of a weighted logistic regression with a small ridge
        q = 1 / (1 + np.exp(-np.clip(x @ h, -30, 30)))
        hess = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(4)
        h = h + np.linalg.solve(hess, x.T @ (weight * (bad - q)) - 1e-4 * h)
    model.head = h
    return model


def _places(text: str) -> Iterator[re.Match]:
    """Words of a text as matches, in lower case where that keeps all offsets (a letter that grows when lowered stays as it is)."""
    low = text.lower()
    return WORD.finditer(low if len(low) == len(text) else text)


def _words(text: str | None) -> list[str]:
    low = (text or "").lower()
    return WORD.findall(low) if len(low) == len(text or "") else [w.lower() for w in WORD.findall(text)]


def long_marginals(e: np.ndarray, chain: np.ndarray, start: np.ndarray, width: int = 1 << 16) -> np.ndarray:
    """P(toxic) of each word of one document: the same as `marginals`, with memory for `width` words at a time. Messages from the right are kept at the ends of blocks."""
    c, s = np.exp(chain - chain.max()), np.exp(start - start.max())

    def matrices(a: int) -> np.ndarray:
        x = np.clip(e[a : a + width], -30, 30)
        emit = np.stack([np.exp(-np.maximum(x, 0)), np.exp(np.minimum(x, 0))])
        m = np.stack([c[i, j] * emit[j] for i in range(2) for j in range(2)])
        if a == 0:
            m[:, 0] = [s[j] * emit[j][0] for _ in range(2) for j in range(2)]
        return m

    cuts = range(0, len(e), width)
    right, beta = {}, np.ones(2)
    for a in reversed(cuts):
        right[a] = beta
        m = _products(matrices(a))[:, -1]
        beta = np.array([m[0] * beta[0] + m[1] * beta[1], m[2] * beta[0] + m[3] * beta[1]])
        beta /= beta.sum()
    out, left = np.empty(len(e)), np.ones(2)
    for a in cuts:
        m = matrices(a)
        ahead = _products(m)
        alpha = left[0] * ahead[:2] + left[1] * ahead[2:]
        alpha /= alpha.sum(axis=0)
        last = np.array([[right[a][0]], [right[a][1]], [0.0], [0.0]])
        back = np.concatenate([m[[0, 2, 1, 3], 1:], last], axis=1)  # transposed, for products from the right end
        behind = _products(back[:, ::-1])[:, ::-1]
        both = alpha * (behind[:2] + behind[2:])
        out[a : a + width] = both[1] / both.sum(axis=0)
        left = alpha[:, -1]
    return out


def scored(texts: list[str | None], model: Model, cache: Emissions, spans: bool = False):
    """Scores, and for each text the number of toxic words and their offsets (start, end) in code points."""
    if len(cache) > 500_000:
        cache.clear()
    at, bounds, probabilities = [], [0], []
    short: list[np.ndarray] = []

    def flush() -> None:
        """Texts of usual length are taken together."""
        if short:
            e = np.concatenate(short)
            if len(e):
                ends = np.cumsum([0, *map(len, short)])
                first = np.zeros(len(e), bool)
                first[ends[:-1][np.diff(ends) > 0]] = True
                e, _ = marginals(e, first, model.chain, model.start)
            probabilities.append(e)
            short.clear()

    for t in texts:
        if t and len(t) > SLICE:
            e = np.fromiter((cache[m.group().lower()] for m in _places(t)), np.float64)
            flush()
            probabilities.append(long_marginals(e, model.chain, model.start))
        else:
            e = np.fromiter(map(cache.__getitem__, _words(t)), np.float64)
            short.append(e)
        bounds.append(bounds[-1] + len(e))
    flush()
    p, ends = np.concatenate(probabilities) if probabilities else np.zeros(0), np.array(bounds, np.int64)
    score = 1 / (1 + np.exp(-np.clip(_summary(p, ends) @ model.head, -50, 50)))
    for k, t in enumerate(texts):
        hit = p[ends[k] : ends[k + 1]] >= 0.5
        n = int(hit.sum())
        at.append((n, [m.span() for m, x in zip(_places(t), hit, strict=True) if x] if n and spans else []))
    return score, at


def fit(docs: DataFrame, labels: DataFrame, most: int = 800, longest: int = 10_000) -> Model:
    """Train on labelled rows of docs. labels: doc_id, toxic; the caller leaves out held-out rows."""
    given = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = None
    for kind in (0, 1):
        part = given.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    ids = {r["doc_id"]: bool(r["toxic"]) for r in chosen.collect()}  # 2 * most at most
    spark = docs.sparkSession
    keys = spark.createDataFrame([(k, v) for k, v in ids.items()], "doc_id long, toxic boolean")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter(F.length("text") <= longest)
    # one text of each id, so the sample's size stays bounded
    rows = texts.join(F.broadcast(keys), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


def score_documents(docs: DataFrame, model: Model, spans: bool = True) -> DataFrame:
    """doc_id, score, n_toxic and spans (start:end of toxic words, comma-joined) of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Emissions(model)
        for part in slices(batches, most=SLICE):
            score, found = scored(part.column(1).to_pylist(), model, cache, spans)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(score), pa.array([n for n, _ in found], pa.int64()), pa.array([",".join(f"{a}:{b}" for a, b in w) for _, w in found], pa.string())],
                names=["doc_id", "score", "n_toxic", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), SCORES_SCHEMA)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of docs whose score is under the threshold, with all their columns."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Emissions(model)
        for part in slices(batches, most=SLICE):
            score, _ = scored(part.column(part.schema.get_field_index("text")).to_pylist(), model, cache)
            yield part.filter(pa.array(score < threshold))

    return docs.mapInArrow(lean(run), schema)
