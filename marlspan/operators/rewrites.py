"""Rewriting pages of a column, with the reason of each skip and the statistics."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspan.functions.rewriting import REWRITERS

RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("processed", T.BooleanType()), T.StructField("reason", T.StringType()), T.StructField("stats", T.MapType(T.StringType(), T.LongType()))])


def rewritten(html: Column, how: str, need_html: bool = True, missing: str = "no_gpt_response") -> Column:
    """struct(text, processed, reason, stats). A page that is skipped keeps its text.

    An empty response counts as missing; one without <html or <body is no page, where that is asked for.
    """
    rewrite = REWRITERS[how]

    def one(text: str | None) -> tuple:
        if not text:
            return text, False, missing, None
        if need_html and "<html" not in text.lower() and "<body" not in text.lower():
            return text, False, "no_html_content", None
        try:
            out, reason, stats = rewrite(text)
        except Exception:
            return text, False, "error", None
        return out, reason is None, reason, list(stats.items())

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        cols = list(zip(*map(one, texts.to_pylist()))) or [()] * 4
        kinds = (pa.string(), pa.bool_(), pa.string(), pa.map_(pa.string(), pa.int64()))
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=RESULT.names)

    return run(html)


def rewritten_turns(turns: Column, text: Column, role: str = "from", value: str = "value", who: tuple[str, ...] = ("gpt", "assistant")) -> Column:
    """Every response turn with the rewritten first response."""
    return F.transform(turns, lambda t: F.struct(t[role].alias(role), F.when(t[role].isin(*who), text).otherwise(t[value]).alias(value)))


def rewrite(df: DataFrame, column: str, how: str, **options) -> DataFrame:
    """df with the column rewritten, and processed, reason and stats."""
    return df.withColumn("__r", rewritten(F.col(column), how, **options)).withColumns({column: F.col("__r.text"), "processed": F.col("__r.processed"), "reason": F.col("__r.reason"), "stats": F.col("__r.stats")}).drop("__r")
