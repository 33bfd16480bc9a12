"""Corpus pipeline: quality, exact copies, near copies, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet in the shared folder and reads it back as the next stage's
documents.  All but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabula.llm import decontam, jaccard_join, ordinal, packing, radix_dedup
from tabula.llm.common import read_table, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is one half or more stay."""
    ratings = read_table(spark, sf_dir, "labels").withColumn("grade", ordinal.document_grade())
    return ordinal.grade_texts(docs, ordinal.fit_on_labels(docs, ratings), only_kept=True)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return radix_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: the smallest id of each group stays."""
    return jaccard_join.one_per_component(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", packed),
]

ORACLE_SQL = None  # classifier, tokenizer and overlap search are not SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
