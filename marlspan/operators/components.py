"""Connected components of an edge list by alternating large-star and small-star (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspan.shared import cut


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): component is the least node that is reachable. Self-loops and nulls are ignored.

    Each round shuffles pairs of ids only, and writes them to the shared folder.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where((F.col("u") != F.col("v")) & F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    last = None
    for _ in range(rounds):
        both = e.union(e.select("v", "u"))
        # Least neighbours are counted up before the shuffle, so that a star's centre is no task's burden.
        large = both.where("v > u").join(both.groupBy("u").agg(F.min("v").alias("m")), "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        seen = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        e = cut(seen.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct())
        now = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.lit(0))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", F.col("v")).distinct())
