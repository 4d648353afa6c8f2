"""Near duplicates by banded hashes: candidates share a band, links are near enough, clusters are components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspan.functions.hashes import bands, hamming
from marlspan.functions.markup import value_density
from marlspan.operators.components import connected_components
from marlspan.operators.rows import top_of_each
from marlspan.shared import cut

#: Distances of a link: text alone, text with structure, structure, image.
PROFILES = {"strict": (2, 4, 4, 6), "balanced": (3, 6, 6, 8), "loose": (4, 8, 8, 10)}
#: Rows of a cell's side, about, pairs that are compared at once, and pairs of a task.
CELL, TILE, PAIRS = 32_768, 1_000_000, 1e9


def candidate_pairs(df: DataFrame, key: str, hashes: list[str], bits: int = 16) -> DataFrame:
    """a < b of rows that share a band of one hash. The hashes ride along, so that no later join fetches them."""
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(h).alias("h")) for i, h in enumerate(hashes)])
    own = df.where(F.col(hashes[0]).isNotNull()).select(F.col(key).alias("k"), *hashes, F.explode(kinds).alias("x"))
    keyed = own.select("k", *hashes, "x.kind", F.explode(bands("x.h", bits)).alias("band"))
    left = keyed.select(F.col("k").alias("a"), *[F.col(h).alias(f"a_{h}") for h in hashes], "kind", "band")
    right = keyed.select(F.col("k").alias("b"), *[F.col(h).alias(f"b_{h}") for h in hashes], "kind", "band")
    return left.join(right, ["kind", "band"]).where("a < b").drop("kind", "band")


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which two arrays of hashes differ."""
    return np.bitwise_count(x ^ y)


def _band_alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether two arrays of hashes share a band of 16 bits."""
    d = x ^ y
    return ((d & np.uint64(0xFFFF)) == 0) | ((d >> np.uint64(16) & np.uint64(0xFFFF)) == 0) | ((d >> np.uint64(32) & np.uint64(0xFFFF)) == 0) | ((d >> np.uint64(48)) == 0)


def _forest(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of edges those that join what parent, each node's root, has apart, none too many. parent is changed to have them together."""
    kept: list[np.ndarray] = []
    at = np.arange(len(a))
    while len(at := at[parent[a[at]] != parent[b[at]]]):
        x, y = parent[a[at]], parent[b[at]]
        # Each root that an edge joins to a lesser one takes one such edge.
        high, first = np.unique(np.maximum(x, y), return_index=True)
        parent[high] = np.minimum(x, y)[first]
        kept.append(at[first])
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up
    own = np.concatenate(kept) if kept else at
    return a[own], b[own]


def cell_links(left: np.ndarray, right: np.ndarray | None, most: int, rule: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links within left, or between left and right where it is given, that connect what all of them would: places in both one after the other.

    left and right have a row a hash; pairs whose first hashes differ in more than so many bits are no links, rule tells of the others.
    """
    own = left if right is None else np.concatenate([left, right], axis=1)
    n = left.shape[1]
    parent = np.arange(own.shape[1])
    found = []
    step = max(1, TILE // own.shape[1])
    for i in range(0, n, step):
        lo = i if right is None else n
        near = _near(own[0, i : min(i + step, n), None], own[0, None, lo:]) <= most
        a, b = np.divmod(np.flatnonzero(near), near.shape[1])
        a, b = a + i, b + lo
        # Only those that join something new are looked at.
        on = (a < b) & (parent[a] != parent[b])
        a, b = a[on], b[on]
        on = rule(own[:, a], own[:, b])
        found.append(_forest(parent, a[on], b[on]))
    return tuple(np.concatenate([np.zeros(0, dtype=np.int64), *(f[k] for f in found)]) for k in (0, 1))


def _of_distinct(df: DataFrame, key: str, hashes: list[str], blocks: int, most: int, rule: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Links that connect what all pairs would: rows of equal hashes by a star, and pairs of different hashes by their least keys.

    So a hash that very many rows have, such as that of pages without text and tags, is one row. The first hash is cut
    into blocks; pairs that rule may link share one. What shares a block is compared in cells of at most CELL rows with
    as many, one task's work each, in numpy; a cell gives no more links than it takes to connect its rows, as
    the links of all pairs grow with the square of the pages.
    """
    own = df.where(F.col(hashes[0]).isNotNull())
    kind = df.schema[key].dataType.simpleString()
    least = cut(own.groupBy(*hashes).agg(F.min(key).alias("least"), F.count("*").alias("n")))
    star = own.join(least.where("n > 1").select(*hashes, "least"), hashes).select(F.col("least").alias("a"), F.col(key).alias("b")).where("a <> b")
    edge = [64 * i // blocks for i in range(blocks + 1)]
    cuts = F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(F.col(hashes[0]), lo).bitwiseAND((1 << hi - lo) - 1).alias("value")) for i, (lo, hi) in enumerate(zip(edge, edge[1:]))])
    keyed = least.select(F.col("least").alias("k"), *hashes, F.explode(cuts).alias("x")).select("k", *hashes, "x.*")
    alike = cut(keyed.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1"))
    size = alike.agg(F.coalesce(F.sum(F.col("n") * F.col("n") / 2), F.lit(0.0))).first()[0]
    parts = F.ceil(F.col("n") / CELL).cast("int")
    dealt = keyed.join(F.broadcast(alike), ["block", "value"]).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
    # A row is in the cells of its part with each part, its own too.
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("block", "value", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), (F.col("part") > F.col("other")).alias("late"), "k", *hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            late = cell.column("late").to_numpy(zero_copy_only=False)
            by = np.argsort(late, kind="stable")
            h = np.stack([cell.column(c).to_numpy().view(np.uint64) for c in hashes])[:, by]
            n = len(late) - int(late.sum())
            whole = cell.column("i")[0] == cell.column("j")[0]
            a, b = cell_links(h, None, most, rule) if whole else cell_links(h[:, :n], h[:, n:], most, rule)
            keys = cell.column("k").take(pa.array(by))
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(a)), keys.take(pa.array(b))], names=["a", "b"])

    by = ["block", "value", "i", "j"]
    tasks = min(5000, max(df.sparkSession.sparkContext.defaultParallelism, int(size / PAIRS)))
    found = cells.repartition(tasks, *by).sortWithinPartitions(*by).mapInArrow(run, f"a {kind}, b {kind}")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().union(star)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one cell after the other; batches may end within one."""
    left: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        ids = np.stack([b.column(c).to_numpy() for c in ("block", "value", "i", "j")])
        begin = np.flatnonzero(np.r_[True, (ids[:, 1:] != ids[:, :-1]).any(0)])
        if left and any(left[0].column(c)[0] != b.column(c)[0] for c in ("block", "value", "i", "j")):
            yield pa.concat_batches(left)
            left = []
        for lo, hi in zip(begin, begin[1:]):
            yield pa.concat_batches([*left, b.slice(lo, hi - lo)])
            left = []
        left.append(b.slice(begin[-1]))
    if left:
        yield pa.concat_batches(left)


def page_links(df: DataFrame, key: str = "page_id", profile: str = "balanced") -> DataFrame:
    t, t2, d, _ = PROFILES[profile]

    def rule(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        text = _near(x[0], y[0])
        return ((text <= t) | ((text <= t2) & (_near(x[1], y[1]) <= d))) & (_band_alike(x[0], y[0]) | _band_alike(x[1], y[1]))

    # Of so many blocks of the text's hash that differ in t2 bits one is the same.
    return _of_distinct(df, key, ["text_hash", "dom_hash"], max(t, t2) + 1, max(t, t2), rule)


def image_links(df: DataFrame, key: str, h: str = "image_hash", profile: str = "balanced") -> DataFrame:
    most = PROFILES[profile][3]
    return _of_distinct(df, key, [h], 4, most, lambda x, y: _band_alike(x[0], y[0]))


def clustered(df: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """df with cluster: the least key that a row is linked to, its own if it has no link."""
    own = connected_components(cut(links)).select(F.col("node").alias("__n"), F.col("component").alias("__c"))
    return df.join(own, F.col(key) == F.col("__n"), "left").withColumn("cluster", F.coalesce("__c", key)).drop("__n", "__c")


def quality(given: Column, ratio: Column) -> Column:
    """A given quality where it is a number, else the density."""
    return F.coalesce(given.try_cast("double"), ratio)


def curated(pages: DataFrame, key: str = "page_id", k: int = 1, profile: str = "balanced", top_n: int = -1, given: str | None = None, image: str | None = None, missing: str = "keep") -> DataFrame:
    """The k best pages of each cluster, by quality, tags and key; then the best top_n of all (all if negative).

    given names a column that goes before the density where it is a number; image names one of image hashes, by
    which pages are linked too; a page without one is kept, dropped or an error, as missing says.
    """
    from marlspan.functions.hashes import page_simhash
    from marlspan.operators.images import missing_image_policy

    if image:
        pages = missing_image_policy(pages, F.col(image).isNull(), missing)
    beside = [F.col(c).alias(n) for c, n in ((given, "given"), (image, "image_hash")) if c]
    scored = pages.select(key, page_simhash("html").alias("h"), value_density("html").alias("d"), *beside).select(key, "h.*", "d.*", *[n for c, n in ((given, "given"), (image, "image_hash")) if c])
    scored = cut(scored.withColumn("quality", quality(F.col("given"), F.col("ratio")) if given else F.col("ratio")))
    links = page_links(scored, key, profile)
    found = clustered(scored, links.union(image_links(scored, key, profile=profile)) if image else links, key)
    order = (F.desc("quality"), F.desc("total_tags"), F.asc(key))
    best = top_of_each(found, "cluster", k, *order)
    return best.orderBy(*order) if top_n < 0 else best.orderBy(*order).limit(top_n)
