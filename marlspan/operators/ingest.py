"""Ingest of sources into training rows: ordered row filters, normalised images, dense ids, prompts, shards.

Cheap filters run before images are touched. A row counts under the first rule it fails.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspan.functions import code_text
from marlspan.functions.messages import first_filled_response, single_round
from marlspan.operators.images import normalised_png
from marlspan.operators.rows import first_failing, numbered, sharded
from marlspan.shared import cut


class Source(NamedTuple):
    """rules: name and condition, in order; code: the text of a row; normalise: whether images become RGB PNGs."""

    prefix: str
    rules: list[tuple[str, Column]]
    code: Column
    normalise: bool = True


def web_pages() -> Source:
    return Source("web", [("no_image", F.col("image").isNotNull()), ("empty_text", code_text.filled(F.col("text")))], F.col("text"))


def web_code(language: str | None = None) -> Source:
    own = [("language", F.col("lang") == language)] if language else []
    return Source("crawl", [*own, ("no_image", F.col("image").isNotNull()), ("empty_text", code_text.filled(F.col("text")))], F.col("text"))


def instructions() -> Source:
    answer = F.get("conversations", F.lit(1))["value"]
    return Source("instruct", [("not_single_round", single_round(F.col("conversations"))), ("invalid_html", code_text.valid_html(answer)), ("no_image", F.col("image").isNotNull())], answer)


def multimodal_code(category: str = "html") -> Source:
    answer = first_filled_response(F.col("messages"))
    return Source("multi", [("category", F.lower("category") == category), ("no_image", F.col("image").isNotNull()), ("empty_response", code_text.filled(answer))], answer)


def parquet_pages(need_html: bool = False) -> Source:
    code = code_text.first_block(F.col("assistant_content"))
    rules = [("no_image", F.col("image").isNotNull()), ("empty_code", code_text.filled(code))]
    return Source("pair", [*rules, *([("invalid_html", code_text.valid_html(code))] if need_html else [])], code, False)


def archives() -> Source:
    code = code_text.strip_layer(F.col("code"))
    return Source("code", [("no_image_path", code_text.filled(F.col("image_path"))), ("empty_code", code_text.filled(code)), ("missing_member", F.col("image").isNotNull())], code)


def ingested(rows: DataFrame, source: Source, *order: Column, size: int = 5000, start: int = 0) -> tuple[DataFrame, DataFrame]:
    """Kept rows (idx, id, shard, member, code, image), and counts of the rejected by reason.

    Ids are given after images that can't be decoded are dropped, so that they are dense.
    """
    judged = rows.withColumn("reason", first_failing(source.rules)).withColumn("__code", source.code)
    image = F.when(F.col("reason").isNull(), normalised_png(F.col("image")) if source.normalise else F.col("image"))
    seen = cut(judged.withColumn("__image", image).withColumn("reason", F.coalesce("reason", F.when(F.col("__image").isNull(), "image_decode_failed"))))
    kept = numbered(seen.where("reason IS NULL").drop("reason"), *order)
    out = sharded(kept, source.prefix, size, start).select("idx", "id", "shard", "member", F.col("__code").alias("code"), F.col("__image").alias("image"), *[c for c in rows.columns if c not in ("idx", "id", "shard", "member", "code", "image")])
    return out, seen.where("reason IS NOT NULL").groupBy("reason").count()


def chat_rows(kept: DataFrame, prompt: Column | str, code: Column | None = None) -> DataFrame:
    """Chat rows of ingested ones; another prompt or rendering makes the second output of the same rows."""
    p = F.lit(prompt) if isinstance(prompt, str) else prompt
    turns = F.array(F.struct(F.lit("user").alias("role"), p.alias("content")), F.struct(F.lit("assistant").alias("role"), (code if code is not None else F.col("code")).alias("content")))
    return kept.select("idx", turns.alias("messages"), F.array(F.concat("shard", F.lit("/"), "member")).alias("images"))


def coded_rows(kept: DataFrame, source: str, language: str) -> DataFrame:
    """source, code_language, image_path and fenced code."""
    return kept.select(F.lit(source).alias("source"), F.lit(language).alias("code_language"), F.concat(F.lit("images/"), "id", F.lit(".png")).alias("image_path"), code_text.fenced(F.col("code"), language).alias("code"))
