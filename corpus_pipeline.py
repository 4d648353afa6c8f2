"""The corpus pipeline: language ID, near duplicates, decontamination, private data, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlspan.llm import decontam, jaccard, langid, mixing, pii


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its error budget go."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private data are redacted; n_chars follows."""
    return pii.keep_redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are selected to each source's budget: 0.7 of all tokens, by the roots of the sources' tokens."""
    return mixing.keep_mixed(docs)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("private data", private_data),
    ("source mixing", source_mixing),
]
#: Compression sizes, edit distances, boosted trees and subset sums can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again, and what it was made of removed."""
    from marlspan.shared import cut, discard, scratch

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with scratch(spark):
            made = cut(stage(spark, docs, sf_dir), kept=True)
        if k:
            discard(docs)
        docs = made
    return STAGES[-1][1](spark, docs, sf_dir)
