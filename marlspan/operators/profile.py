"""Numeric summaries and counts of a profiled dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspan.shared import cut

PERCENTILES = (1, 5, 25, 50, 75, 95, 99)


def summary(df: DataFrame, *columns: str) -> DataFrame:
    """A row for each column: count, min, max, mean, median, population deviation and exact percentiles; nulls are left out.

    Values are counted before the shuffle and ranked by ranges of the value, so that no task holds a column;
    a percentile lies between the values at the two ranks next to it. An empty column has a count of 0 and nulls.
    """
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("v")) for c in columns])
    values = df.select(F.explode(each).alias("x")).select("x.field", "x.v")
    plain = values.groupBy("field").agg(F.count("v").alias("count"), F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    counted = values.where("v IS NOT NULL").groupBy("field", "v").agg(F.count("*").alias("c"))
    ranged = cut(counted.repartitionByRange("field", "v").sortWithinPartitions("field", "v").withColumn("part", F.spark_partition_id()))
    size = ranged.groupBy("field", "part").agg(F.sum("c").alias("n"))
    before = size.select("field", "part", (F.sum("n").over(Window.partitionBy("field").orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("c").over(Window.partitionBy("field", "part").orderBy("v"))
    ranked = ranged.join(F.broadcast(before), ["field", "part"]).withColumn("last", F.col("before") + inside - 1).withColumn("first", F.col("last") - F.col("c") + 1)
    # The ranks that the percentiles lie between, a few for each field.
    place = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), (F.lit(p / 100) * (F.col("count") - 1)).alias("at")) for p in PERCENTILES]))
    asked = plain.where("count > 0").select("field", place.alias("q")).select("field", "q.p", "q.at")
    hit = ranked.join(F.broadcast(asked), "field").where((F.ceil("at") >= F.col("first")) & (F.floor("at") <= F.col("last")))
    low = F.max(F.when(F.floor("at") >= F.col("first"), F.col("v")))
    high = F.min(F.when(F.ceil("at") <= F.col("last"), F.col("v")))
    got = hit.groupBy("field", "p", "at").agg(low.alias("low"), high.alias("high")).select("field", "p", (F.col("low") + (F.col("at") - F.floor("at")) * (F.col("high") - F.col("low"))).alias("x"))
    wide = got.groupBy("field").agg(*[F.max(F.when(F.col("p") == p, F.col("x"))).alias(f"p{p}") for p in PERCENTILES])
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "field string")
    out = every.join(plain, "field", "left").join(wide, "field", "left")
    return out.select("field", F.coalesce("count", F.lit(0)).alias("count"), "min", "max", "mean", "std", F.col("p50").alias("median"), *[f"p{p}" for p in PERCENTILES])


def kept_report(kept: DataFrame, ratio: str, *ties: Column, n: int = 10) -> DataFrame:
    """The best n rows by ratio, and beside them the mean of all."""
    mean = kept.agg(F.avg(ratio).alias("mean_ratio"))
    return kept.orderBy(F.desc(ratio), *ties).limit(n).crossJoin(F.broadcast(mean))


def write_statistics(stats: DataFrame, folder: str, *columns: str) -> None:
    """stats.jsonl, a line a row, and summary.json, the numeric summary of some columns; both folders of files."""
    stats.write.json(f"{folder}/stats.jsonl")
    summary(stats, *columns).coalesce(1).write.json(f"{folder}/summary.json")


def byte_savings(stats: DataFrame, *columns: str) -> DataFrame:
    return stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in columns])


def verification(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Rows and members, and whether they are as many."""
    a, b = rows.agg(F.count("*").alias("n_rows")), members.agg(F.count("*").alias("n_members"))
    return a.crossJoin(b).withColumn("equal", F.col("n_rows") == F.col("n_members"))
