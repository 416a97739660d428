"""The corpus pipeline: documents in, cleaned and tokenised documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storecast.llm import decontaminate, pieces, quality, simhash, suffix
from storecast.llm.frames import release, scratch_path, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels of `sf_dir`."""
    return quality.good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs, shingle_words=4, max_bits=4)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Text without the 100-byte strings that occurred before."""
    return suffix.without_repeats(docs, length=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of 10 words of a benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as tokens, and the text that the tokens give back."""
    return pieces.retold(docs, pieces.load(spark, pieces.MODEL))


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("tokenization", tokenization),
]

#: Hash links, a suffix transform, a fitted model and a tokenizer have no SQL form; tests hold run() to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of `sf_dir`, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != STAGES[0][0]:
            release(before)  # an earlier stage's folder, which nothing reads any more
    return docs
