"""From raw documents to packed sequences: the stages of a corpus run."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from outlay.llm.exact_dedup import drop_exact_duplicates
from outlay.llm.ngram_join import drop_similar
from outlay.llm.packing import pack
from outlay.llm.substrings import drop_repeated_passages
from outlay.llm.toxicity import drop_toxic
from outlay.sources.scratch import new_table_path, scope

# Pieces of text a worker keeps the ids of: the executors of a run have grown by its other stages.
KNOWN_PIECES = 100_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of the run, calls toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingle sets alike to 80 %, the one with the smallest id stays."""
    return drop_similar(docs, k=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once stay in one place; no document goes."""
    return drop_repeated_passages(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, in sequences of 1024 ids."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, known=KNOWN_PIECES)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_join", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

# The classifier of the first stage is not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read by the next.

    What a stage wrote for itself is removed when its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_table_path(spark, name)
        with scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
