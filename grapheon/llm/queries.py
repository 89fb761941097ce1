"""The queries of the training-data operators, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grapheon.llm import ann, exact, infill, jaccard, lexical, oracles, packing, pieces, quality, secrets, substrings, topk, toxicity, urls
from grapheon.llm.common import table

URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def remainder(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.fit(docs, labels.filter(remainder(F.col("doc_id")) != 1))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score_documents(docs, toxicity_model(spark, docs, sf_dir))
    return scores.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_toxic", "spans")


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), length=100)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), n=5, percent=80)


def queries_of(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("vec_id") % 50 == 0)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, queries_of(rows), k=5, scale=256)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, queries_of(rows), k=5)


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(table(spark, sf_dir, "documents"), seed=1, plain=10, spm=20)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_toxicity": op2_toxicity,
    "op3_repeats": op3_repeats,
    "op4_quality": op4_quality,
    "op5_pieces": op5_pieces,
    "op6_jaccard": op6_jaccard,
    "op7_topk": op7_topk,
    "op8_neighbours": op8_neighbours,
    "op9_urls": op9_urls,
    "op10_packing": op10_packing,
    "op11_infill": op11_infill,
    "op12_lexical": op12_lexical,
    "op13_exact": op13_exact,
}
ORACLE_SQL: dict[str, str] = oracles.SQL | {"op9_urls": oracles.urls(URL_RULES)}
