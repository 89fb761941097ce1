"""The corpus pipeline: toxicity, near duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written and read again as the next stage's docs. All but the last give the
columns of documents; n_chars follows the text. The last gives the packed pieces.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grapheon.llm import jaccard, packing, secrets, substrings, toxicity
from grapheon.llm.common import remove, shared_folder
from grapheon.llm.queries import tokenizer_path, toxicity_model


def _counted(docs: DataFrame) -> DataFrame:
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind)) if "n_chars" in docs.columns else docs


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go."""
    return toxicity.drop_toxic(docs, toxicity_model(spark, docs, sf_dir), 0.7)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, the one with the smallest id."""
    return jaccard.keep_one(docs)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages that also start earlier; documents stay."""
    return _counted(substrings.strip_repeats(docs))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; documents stay."""
    return _counted(secrets.redact_secrets(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeated_passage_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: Suffix arrays, components, the toxicity model and packing have no SQL form; plain versions of the stages are in tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents. Each result is written below the session's shared folder and read again; a stage's input goes once its output is written, so only the last one's stays."""
    base = posixpath.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        out = posixpath.join(base, name)
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(out)
        docs = spark.read.parquet(out)
        if before:
            remove(spark, before)
        before = out
    return docs
