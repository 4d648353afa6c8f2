"""Positions, limits, splits, routing, rejects and set operations on ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspan.sources.records import with_position


def first_failing(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that a row fails, in order; null if it passes all. A null condition fails."""
    out = F.lit(None).cast("string")
    for name, ok in reversed(rules):
        out = F.when(~F.coalesce(ok, F.lit(False)), name).otherwise(out)
    return out


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """Rows with a dense `pos` from 0: ids are given after filtering, so that they have no gaps."""
    return with_position(df, *order)


def sharded(df: DataFrame, prefix: str, size: int = 5000, start: int = 0) -> DataFrame:
    """idx, id, shard and member of numbered rows."""
    idx = F.col("pos") + start
    return df.withColumns({"idx": idx, "id": F.format_string(f"{prefix}_%06d", idx), "shard": F.format_string("images-%05d.tar", F.floor(idx / size).cast("bigint")), "member": F.format_string(f"{prefix}_%06d.png", idx)})


def limit_input(df: DataFrame, n: int | None) -> DataFrame:
    """The first n numbered rows, before anything is filtered."""
    return df if n is None else df.where(F.col("pos") < n)


def limit_output(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """The first n rows that are left."""
    return df if n is None else df.orderBy(*(order or (F.col("pos"),))).limit(n)


def first_valid(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n valid lines, as they were read."""
    if n <= 0:
        raise ValueError("n must be positive")
    return df.where("valid").orderBy(*order).limit(n)


def subset(df: DataFrame, n: int = 100_000) -> DataFrame:
    return df.where(F.col("pos") < n)


def routed(df: DataFrame, share: float, seed: int, *key: str) -> DataFrame:
    """route: true for a share of the rows, by a seeded hash of the key, whatever the partitioning."""
    return df.withColumn("route", F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1_000_000)) < int(share * 1_000_000))


def rejects(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Rows without a reason, and {reason, entry} of the others."""
    others = [c for c in df.columns if c != reason]
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull()).select(reason, F.struct(*others).alias("entry"))


def skipped_entries(df: DataFrame, entry: Column | None = None, reason: str = "reason") -> DataFrame:
    """reason and entry of each skipped row; the report's list, a row an entry, however many there are."""
    own = F.struct(*[F.col(c) for c in df.columns if c != reason]) if entry is None else entry
    return df.where(F.col(reason).isNotNull()).select(F.col(reason).alias("reason"), own.alias("entry"))


def skip_report(df: DataFrame, reason: str = "reason") -> DataFrame:
    """total_skipped and skip_reasons in one row, counted before the shuffle; no row when nothing was skipped."""
    by = df.where(F.col(reason).isNotNull()).groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("n"))
    return by.agg(F.sum("n").alias("total_skipped"), F.map_from_entries(F.collect_list(F.struct("reason", "n"))).alias("skip_reasons")).where("total_skipped > 0")


def counted(df: DataFrame, key: str) -> DataFrame:
    """Rows of each value, and their percentage of all, to two places."""
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return n.crossJoin(F.broadcast(total)).select(key, "n", F.round(F.col("n") * 100.0 / F.col("total"), 2).alias("percent"))


def top_of_each(df: DataFrame, group: str, k: int, *order: Column) -> DataFrame:
    """The first k rows of each group; the group limit runs before the shuffle too."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of all; all of them if n is negative, none if it is 0."""
    return df.orderBy(*order) if n < 0 else df.orderBy(*order).limit(n)


def missing_ranges(present: DataFrame, last: int, idx: str = "idx") -> DataFrame:
    """first, last and n of the runs of 0..last that aren't present: gaps between neighbours, without listing them."""
    bounded = present.select(F.col(idx).cast("bigint").alias("i")).where(f"i BETWEEN 0 AND {int(last)}").distinct()
    edged = bounded.union(present.sparkSession.range(1).select(F.lit(int(last) + 1).cast("bigint")))
    # Ranges of indices are cut into buckets, so that no window holds them all.
    wide = max(1, int(last) // 10_000 + 1)
    b = edged.withColumn("b", F.floor(F.col("i") / wide))
    edge = b.groupBy("b").agg(F.max("i").alias("m"))
    carried = edge.select("b", F.lag("m").over(Window.orderBy("b")).alias("carried"))
    prev = F.lag("i").over(Window.partitionBy("b").orderBy("i"))
    gaps = b.withColumn("p", prev).join(F.broadcast(carried), "b").withColumn("p", F.coalesce("p", "carried", F.lit(-1)))
    return gaps.where("i - p > 1").select((F.col("p") + 1).alias("first"), (F.col("i") - 1).alias("last"), (F.col("i") - F.col("p") - 1).alias("n"))


def sequence_errors(members: DataFrame, size: int) -> DataFrame:
    """Of (shard_no, tar order, idx): shards that aren't full (but the last), too full, or out of sequence.

    first_divergence is the place in the tar where the index isn't shard_no * size + place.
    """
    place = F.row_number().over(Window.partitionBy("shard_no").orderBy("pos")) - 1
    off = members.withColumn("place", place).withColumn("wrong", F.col("idx") != F.col("shard_no") * size + F.col("place"))
    by = off.groupBy("shard_no").agg(F.count("*").alias("n"), F.min(F.when(F.col("wrong"), F.col("place"))).alias("first_divergence"))
    last = by.agg(F.max("shard_no").alias("last"))
    problem = F.when(F.col("n") > size, "too many").when((F.col("n") < size) & (F.col("shard_no") < F.col("last")), "incomplete").when(F.col("first_divergence").isNotNull(), "out of sequence")
    return by.crossJoin(F.broadcast(last)).select("shard_no", "n", "first_divergence", problem.alias("problem")).where("problem IS NOT NULL")


def reconciled(rows: DataFrame, members: DataFrame, checkpoint: int) -> DataFrame:
    """Ranges of rows without a member. The rows are authoritative; fewer of them than the checkpoint says is an error."""
    n = rows.count()
    if n < checkpoint:
        raise ValueError(f"{n} rows, but the checkpoint has {checkpoint}")
    return missing_ranges(members, n - 1)
