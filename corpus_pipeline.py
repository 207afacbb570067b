"""The training-data pipeline: which documents stay, and the sequences they are packed into."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import decontamination, language, near_duplicates, packing, quality
from parcelflow.llm.columns import fold, free_name, table
from parcelflow.session import new_work_dir

#: Least score that a document needs.
GOOD = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is ``GOOD`` or better; learned as op1 learns."""
    model = quality.fit(docs.where(fold(3) != 1), table(spark, sf_dir, "labels"))
    score = free_name(docs, "_score")
    return quality.with_scores(docs, model, score).where(F.col(score) >= GOOD).select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in learned languages, by the margin that their words have on other languages; learned as op8 learns."""
    model = language.fit(docs.where(fold(4) != 2))
    name = free_name(docs, "_found")
    return language.with_languages(docs, model, name).where(language.in_learned(F.col(name))).select(docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the least doc_id."""
    return near_duplicates.one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2,048 tokens at most."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Classifiers, hashed signatures and tokenizers have no SQL form; the tests compare the quality stage
#: with its operator and run every stage on odd rows and clashing names.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    folder = new_work_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
