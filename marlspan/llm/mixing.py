"""Mixing sources to target weights by fitting token budgets as subset sums.

The tokens of a text are its runs without white space, counted over the whole text. All documents
are counted by (source, exact length). The total, SHARE of all tokens unless it is given, is spread
over the sources by weight; a source that has less than its part gives all it has, and what it lacks
is spread over the others by their weights. Without weights a source weighs its tokens to the power
SMOOTH, so that small sources count for more than their share.

Of a source, a proportional number of each length is taken, rounded down, and further documents in a
seeded order of lengths while much budget is left; bounded-knapsack dynamic programming over the
counts that remain fills the rest. If that misses the budget, documents are given back and a larger
rest is filled, until the budget is met (or the nearest multiple of the lengths' common divisor) or all
was given back: the sum is then the largest of all. Only a rest of over WIDE times the first, after
RETRIES doublings that brought nothing nearer, ends the search before that. Of each length the documents of least
seeded hash are selected.

Cases: a null source is a source of its own, "" another; texts without a token (null, empty) have
length 0 and are left out; weights of absent sources are spread over those present, and a source
without a weight gives nothing; hash ties fall by the text's hash; a null doc_id is a document like
others; repeated rows count as several documents and are selected row by row; an empty table gives an
empty mix; texts of any length are counted whole. Other columns pass through whatever their names:
names that begin with "__marlspan_mix_" alone are taken.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlspan.llm.words import buffers, parts
from marlspan.shared import cut, sized_join

SEED = 11
#: The total as a part of all tokens, and the power of a source's tokens that is its weight.
SHARE, SMOOTH = 0.7, 0.5
#: Budget that is left to the first dynamic programme: so many times the longest length.
DP_LENGTHS = 4
#: Doublings of that rest that may bring nothing, once it is so many times the first.
RETRIES, WIDE = 3, 64
P = "__marlspan_mix_"
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 13, 32]] = True


def _lengths(text: pa.Array) -> np.ndarray:
    out = [np.zeros(0, dtype=np.int64)]
    for part in parts(text):
        off, data = buffers(part)
        solid = ~_SPACE[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        first = off[:-1][np.diff(off) > 0]
        begins[first] = solid[first]
        total = np.concatenate([[0], np.cumsum(begins, dtype=np.int64)])
        out.append(total[off[1:]] - total[off[:-1]])
    return np.concatenate(out)


def token_length(text="text"):
    """Tokens of a text: runs of characters other than space, tab, line feed and carriage return."""

    @F.arrow_udf("bigint")
    def tokens(text: pa.Array) -> pa.Array:
        return pa.array(_lengths(text))

    return tokens(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _knapsack(length: np.ndarray, left: np.ndarray, rest: int, order: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of what is left make the largest sum up to rest, and that sum."""
    take = np.zeros_like(left)
    # first[s]: the item that first reached the sum s; items are powers of two of a length's count.
    first = np.full(rest + 1, -1, dtype=np.int32)
    first[0] = 0
    items: list[tuple[int, int]] = [(-1, 0)]
    most = 0
    for i in order:
        n_left, step = int(min(left[i], rest // length[i])), 1
        while n_left > 0:
            n = min(step, n_left)
            w = n * int(length[i])
            items.append((int(i), n))
            most = min(rest, most + w)
            reach = np.flatnonzero((first[: most + 1 - w] >= 0) & (first[w : most + 1] < 0)) + w
            first[reach] = len(items) - 1
            n_left -= n
            step *= 2
        if first[rest] >= 0:
            break
    best = s = int(np.flatnonzero(first >= 0)[-1])
    while s:
        i, n = items[first[s]]
        take[i] += n
        s -= n * int(length[i])
    return take, best


def fit(length: np.ndarray, count: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length make the largest sum up to budget (see the module's text)."""
    total = int((length.astype(object) * count).sum()) if len(length) else 0
    if budget >= total:
        return count.copy()
    if budget <= 0 or not total:
        return np.zeros_like(count)
    unit = int(np.gcd.reduce(length))
    length, budget, total = length // unit, budget // unit, total // unit
    order = np.random.default_rng(seed).permutation(len(length))
    window = DP_LENGTHS * int(length.max())
    take = (count.astype(object) * budget // total).astype(np.int64) if budget > window else np.zeros_like(count)
    rest = budget - int((take.astype(object) * length).sum())
    while rest > window:
        moved = False
        for i in order:
            # As many as leave half of the window: the rest is filled exactly.
            n = min(int(count[i] - take[i]), max(0, (rest - window // 2) // int(length[i])), max(1, int(count[i]) // 8))
            if n > 0:
                take[i] += n
                rest -= n * int(length[i])
                moved = True
            if rest <= window:
                break
        if not moved:
            break
    near, idle = None, 0
    while True:
        more, reached = _knapsack(length, count - take, rest, order)
        if near is None or rest - reached < near[0]:
            near, idle = (rest - reached, take + more), 0
        else:
            idle += 1
        if not near[0] or not take.any() or (idle >= RETRIES and rest > WIDE * window):
            return near[1]
        aim = 2 * rest
        for i in order[::-1]:
            n = min(int(take[i]), -(-(aim - rest) // int(length[i])))
            take[i] -= n
            rest += n * int(length[i])
            if rest >= aim:
                break


def budgets(total: dict, weights: dict | None = None, tokens: int | None = None) -> dict:
    """Each present source's budget; a source that has less than its part gives all, the others share what it lacks."""
    whole = sum(total.values())
    rest = Fraction(whole) * Fraction(SHARE).limit_denominator(1000) if tokens is None else Fraction(min(tokens, whole))
    w = {s: Fraction(weights.get(s, 0)) if weights else Fraction(n**SMOOTH) for s, n in total.items()}
    out = {s: 0 for s in total}
    open_ = {s for s in total if w[s] > 0}
    while open_:
        z = sum(w[s] for s in open_)
        full = {s for s in open_ if total[s] * z <= rest * w[s]}
        if not full:
            return out | {s: math.floor(rest * w[s] / z) for s in open_}
        out |= {s: total[s] for s in full}
        rest -= sum(total[s] for s in full)
        open_ -= full
    return out


def _keys() -> dict:
    own = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    return {f"{P}source": own, f"{P}len": token_length(), f"{P}text": F.xxhash64("text")}


def edges(lean: DataFrame, weights: dict | None, tokens: int | None, seed: int) -> DataFrame:
    """Of each source and length that gives documents: the last selected hash and text (null: all are),
    and how many of those equal to it are selected (null: all)."""
    by = [f"{P}source", f"{P}len"]
    counts = cut(lean.groupBy(*by).agg(F.count("*").alias("n")))
    total = {r[0]: int(r[1]) for r in counts.groupBy(by[0]).agg(F.sum((F.col(by[1]) * F.col("n")).cast("decimal(38,0)"))).collect()}
    share = budgets(total, {f"={s}" if s is not None else "": w for s, w in weights.items()} if weights else None, tokens)

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(f"{P}len")
        take = fit(pdf[f"{P}len"].to_numpy(), pdf["n"].to_numpy(), share[pdf[f"{P}source"].iloc[0]], seed)
        return pd.DataFrame({f"{P}source": pdf[f"{P}source"], f"{P}len": pdf[f"{P}len"], "take": take, "n": pdf["n"]})

    takes = cut(counts.groupBy(by[0]).applyInPandas(fitted, f"{P}source string, {P}len bigint, take bigint, n bigint").where("take > 0"))
    # A length that is taken whole has no edge. Elsewhere the edge is sought in ranges of the hash first,
    # so that a length of very many documents is no task's burden.
    some = takes.where("take < n").select(*by, "take")
    ranged = sized_join(lean, some, by, "inner").withColumn("range", F.shiftright(f"{P}hash", 52))
    sizes = ranged.groupBy(*by, "range", "take").agg(F.count("*").alias("c"))
    up_to = sizes.withColumn("k", F.sum("c").over(Window.partitionBy(*by).orderBy("range")))
    target = cut(up_to.where("k >= take AND k - c < take").select(*by, "range", (F.col("k") - F.col("c")).alias("before")))
    alike = sized_join(ranged, target, [*by, "range"], "inner").groupBy(*by, f"{P}hash", f"{P}text", "take", "before").agg(F.count("*").alias("c"))
    place = alike.withColumn("k", F.col("before") + F.sum("c").over(Window.partitionBy(*by).orderBy(f"{P}hash", f"{P}text")))
    edge = place.where("k >= take AND k - c < take").select(*by, F.col(f"{P}hash").alias(f"{P}eh"), F.col(f"{P}text").alias(f"{P}et"), F.when(F.col("k") > F.col("take"), F.col("take") - F.col("k") + F.col("c")).alias(f"{P}last"))
    return cut(takes.select(*by).join(edge, by, "left"))


def selected(rows: DataFrame, edge: DataFrame, columns: list[str]) -> DataFrame:
    """The rows up to their edges; of equal rows at an edge as many as are selected."""
    got = sized_join(rows, edge, [f"{P}source", f"{P}len"], "inner")
    h, t, eh, et = (F.col(f"{P}{c}") for c in ("hash", "text", "eh", "et"))
    inside = got.where(eh.isNull() | (h < eh) | ((h == eh) & (t <= et)))
    if edge.where(F.col(f"{P}last").isNotNull()).isEmpty():
        return inside.select(columns)
    tied = (h == eh) & (t == et) & F.col(f"{P}last").isNotNull()
    ranked = inside.where(tied).withColumn(f"{P}k", F.row_number().over(Window.partitionBy(f"{P}source", f"{P}len", f"{P}hash", f"{P}text").orderBy("doc_id")))
    return inside.where(~F.coalesce(tied, F.lit(False))).select(columns).union(ranked.where(F.col(f"{P}k") <= F.col(f"{P}last")).select(columns))


def _lean(docs: DataFrame, seed: int) -> DataFrame:
    """Texts are read once; these few bytes of each document are written."""
    key = _keys() | {f"{P}hash": F.xxhash64(F.col("doc_id"), F.lit(seed))}
    return cut(docs.select("doc_id", "source", *[c.alias(n) for n, c in key.items()]).where(F.col(f"{P}len") > 0))


def mix_sources(docs: DataFrame, weights: dict | None = None, tokens: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, source and tokens of the selected documents."""
    lean = _lean(docs.select("doc_id", "source", "text"), seed)
    got = selected(lean, edges(lean, weights, tokens, seed), ["doc_id", "source", f"{P}len"])
    return got.withColumnRenamed(f"{P}len", "tokens")


def keep_mixed(docs: DataFrame, weights: dict | None = None, tokens: int | None = None, seed: int = SEED) -> DataFrame:
    """The selected rows of docs, their columns as they came."""
    edge = edges(_lean(docs, seed), weights, tokens, seed)
    # A document's edge is joined to it where it is: whole texts aren't shuffled.
    return selected(docs.withColumns(_keys() | {f"{P}hash": F.xxhash64(F.col("doc_id"), F.lit(seed))}), edge, docs.columns)
