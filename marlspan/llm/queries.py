"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marlspan.llm import decontam, jaccard, langid, licenses, lmscore, media, mixing, pii, repeats, tokens

#: Folder of public tokenizers; another may be named in the environment.
TOKENIZERS = os.environ.get("MARLSPAN_TOKENIZERS", "/opt/tokenizers")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op6_ngram_jaccard": jaccard.ORACLE}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_language_id(spark, sf_dir):
    return langid.language_id(table(spark, sf_dir, "documents"))


@query
def op6_ngram_jaccard(spark, sf_dir):
    return jaccard.near_classes(table(spark, sf_dir, "documents"))


@query
def op5_source_mixing(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query
def op7_decontamination(spark, sf_dir):
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_private_data(spark, sf_dir):
    return pii.private_data(table(spark, sf_dir, "documents"))


@query
def op2_maximal_repeats(spark, sf_dir):
    return repeats.maximal_repeats(table(spark, sf_dir, "documents"))


@query
def op10_cross_parsing(spark, sf_dir):
    return lmscore.cross_parse(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


@query
def op1_media_tiles(spark, sf_dir):
    return media.media_tiles(media.rendered(table(spark, sf_dir, "documents")))


@query
def op8_license_scan(spark, sf_dir):
    return licenses.license_scan(licenses.with_paths(table(spark, sf_dir, "documents").select("doc_id", "text")))
