"""Preference pairs: a query, its response, and a rejected response made from it.

Every row has its own random generator, seeded by (seed, operation, row key): results don't depend on
partitions or on other rows.
"""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspan.functions.degenerate import DISPATCHERS, equal_share, weighted
from marlspan.functions.messages import last_of
from marlspan.functions.perturb import perturbed
from marlspan.shared import in_slices

#: Draws of a repetition until it differs from the response.
DRAWS = 20

RESULT = T.StructType([T.StructField(n, T.StringType()) for n in ("rejected", "label", "mode", "reason")])


def generator(seed: int, operation: str, key: object) -> random.Random:
    return random.Random(hashlib.blake2b(f"{seed}\x1f{operation}\x1f{key}".encode(), digest_size=16).digest())


def pair_id(seed: int, key: object) -> str:
    """A UUID that is the row's own."""
    h = hashlib.blake2b(f"{seed}\x1fid\x1f{key}".encode(), digest_size=16).hexdigest()
    return f"{h[:8]}-{h[8:12]}-4{h[13:16]}-8{h[17:20]}-{h[20:]}"


def one(query: str | None, response: str | None, how: str, rng: random.Random, rate: float, axes: str | None, split: float) -> tuple:
    """(rejected, label, mode, reason) of a row; split: the share that begins with a perturbation, where both are asked for."""
    if not query:
        return None, None, None, "no_user_message"
    if not response:
        return None, None, None, "no_assistant_response"
    try:
        if how.startswith("semantic"):
            out, label = perturbed(response, rng, rate, axes, int(how.removeprefix("semantic_")))
            return (out, label, "semantic", None) if out is not None else (None, None, None, label)
        if how.startswith("combined"):
            if rng.random() < split:
                out, label = perturbed(response, rng, rate, axes)
                if out is not None:
                    return out, label, "semantic", None
        # A unit that is all the rest of the page, taken once, gives the page again: such a draw doesn't count.
        for _ in range(DRAWS):
            if how.startswith("combined"):
                text, label = equal_share(response, rng) if how == "combined_equal_share" else weighted(response, rng, True)
            else:
                text, label = DISPATCHERS[how](response, rng)
            if text != response:
                return text, label, "repetition", None
        return None, None, None, "repetition_no_op"
    except Exception as e:  # a row that fails is counted, and doesn't end the job
        return None, None, None, f"error: {e}"


def rejected(key: Column, query: Column, response: Column, how: str, seed: int = 42, rate: float = 0.7, axes: str | None = None, split: float = 0.5) -> Column:
    """struct(rejected, label, mode, reason)."""

    def some(k: pa.Array, q: pa.Array, r: pa.Array) -> pa.Array:
        rows = [one(b, c, how, generator(seed, how, a), rate, axes, split) for a, b, c in zip(k.to_pylist(), q.to_pylist(), r.to_pylist())]
        return pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in (list(zip(*rows)) or [()] * 4)], names=RESULT.names)

    @F.arrow_udf(RESULT)
    def run(k: pa.Array, q: pa.Array, r: pa.Array) -> pa.Array:
        return in_slices(some, k, q, r)

    return run(key.cast("string"), query, response)


def pairs(df: DataFrame, key: str, query: Column, response: Column, how: str, images: Column | None = None, **options) -> DataFrame:
    """key, query, response, rejected_response, images, rejection_mode, rejection_sub_pattern and reason; rejects have a reason."""
    made = df.select(F.col(key), query.alias("query"), response.alias("response"), (images if images is not None else F.array().cast("array<string>")).alias("images"))
    got = made.withColumn("__r", rejected(F.col(key), F.col("query"), F.col("response"), how, **options))
    return got.select(key, "query", "response", F.col("__r.rejected").alias("rejected_response"), "images", F.col("__r.mode").alias("rejection_mode"), F.col("__r.label").alias("rejection_sub_pattern"), F.col("__r.reason").alias("reason"))


def chat_pairs(df: DataFrame, key: str, how: str, **options) -> DataFrame:
    """Pairs of chat rows, of their last user and last assistant messages."""
    m = F.col("messages")
    return pairs(df, key, last_of(m, "user"), last_of(m, "assistant"), how, **options)
