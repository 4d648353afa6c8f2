"""Conversions between chat rows, conversation rows, flat code rows and preference rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspan.functions import code_text, messages
from marlspan.operators.preferences import pair_id


def sharded_conversations(chat: DataFrame) -> DataFrame:
    """id, shard, image_in_tar and conversations of chat rows, of their first image; an id that is there stays."""
    ref = messages.image_reference(F.get("images", F.lit(0)))
    own = F.coalesce(F.col("id"), ref["id"]) if "id" in chat.columns else ref["id"]
    return chat.select(own.alias("id"), ref["shard"].alias("shard"), ref["image_in_tar"].alias("image_in_tar"), messages.as_conversations(F.col("messages")).alias("conversations"))


def chat_from_conversations(rows: DataFrame) -> DataFrame:
    """Chat rows of conversation rows; the image is shard/member, or the image alone."""
    who = lambda r: F.when(r == "human", "user").when(r == "gpt", "assistant").otherwise(r)
    turns = F.transform("conversations", lambda t: F.struct(who(t["from"]).alias("role"), t["value"].alias("content")))
    parts = [F.concat("shard", F.lit("/"), "image_in_tar")] if {"shard", "image_in_tar"} <= set(rows.columns) else []
    image = F.coalesce(*parts, *([F.col("image")] if "image" in rows.columns else []), F.lit(None).cast("string"))
    return rows.select("id", turns.alias("messages"), F.array_compact(F.array(image)).alias("images"))


def code_rows(chat: DataFrame, source: str, language: str, *order: Column, start: int = 0) -> DataFrame:
    """source, code_language, image_path, code (fenced) and name, of rows with code and an image, numbered without gaps."""
    from marlspan.operators.rows import numbered

    kept = chat.withColumn("__code", messages.first_filled_response(F.col("messages"))).where(F.col("__code").isNotNull() & (F.size("images") > 0))
    own = numbered(kept, *order)
    name = F.format_string("web_%06d", F.col("pos") + start)
    raw = code_text.strip_outer(F.col("__code"))
    return own.select(F.lit(source).alias("source"), F.lit(language).alias("code_language"), F.concat(F.lit("images/"), name, F.lit(".png")).alias("image_path"), code_text.fenced(raw, language).alias("code"), name.alias("name"), F.get("images", F.lit(0)).alias("image_ref"))


def both_prompts(rows: DataFrame, fixed: Column | str, original: Column) -> tuple[DataFrame, DataFrame]:
    """The same chat rows with their own prompt and with a fixed one."""
    m = F.col("messages")
    return rows.withColumn("messages", messages.with_prompt(m, original)), rows.withColumn("messages", messages.with_prompt(m, fixed))


def preference_rows(pairs: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """id, image, prompt, chosen and rejected; the id is derived from the seed and the row's key."""

    @F.arrow_udf("string")
    def ids(keys: pa.Array) -> pa.Array:
        return pa.array([pair_id(seed, k) for k in keys.to_pylist()], pa.string())

    kept = pairs.where("reason IS NULL")
    return kept.select(ids(F.col(key).cast("string")).alias("id"), F.get("images", F.lit(0)).alias("image"), F.col("query").alias("prompt"), F.col("response").alias("chosen"), F.col("rejected_response").alias("rejected"))


def as_pairs(rows: DataFrame) -> DataFrame:
    """prompt and chosen of rows that have them, or of conversations: the last human and the last gpt turn."""
    given = {"prompt", "chosen"} <= set(rows.columns)
    turns = F.col("conversations") if "conversations" in rows.columns else None
    if turns is None:
        return rows
    human, gpt = messages.last_of(turns, "human", "from", "value"), messages.last_of(turns, "gpt", "from", "value")
    return rows.withColumns({"prompt": F.coalesce("prompt", human) if given else human, "chosen": F.coalesce("chosen", gpt) if given else gpt})


def verify_report(rows: DataFrame, members: DataFrame, *order: Column, samples: int = 3) -> DataFrame:
    """Rows, members, whether they are as many, and the first rows as JSON, in ascending order."""
    n = rows.agg(F.count("*").alias("n_rows")).crossJoin(members.agg(F.count("*").alias("n_members")))
    keyed = rows.orderBy(*order).limit(samples).select(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.to_json(F.struct(*rows.columns)).alias("j")).alias("s"))
    first = keyed.agg(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["j"]).alias("samples"))
    return n.crossJoin(first).withColumn("equal", F.col("n_rows") == F.col("n_members"))
