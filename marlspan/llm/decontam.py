"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are normalised alike: lower case, every run of bytes outside words is one space, and
a space stands at both ends, so that whole words are compared. An item of m characters within these
may differ by k = floor(ERRORS m) edits. It is split into k + 1 pieces; if
some part of a document is within k edits, one piece at least occurs in it exactly. An Aho-Corasick
automaton finds all piece hits in the whole document, and Myers' bit-parallel algorithm measures the
window that a hit allows. The distance is the least over all windows, and equals that of the best
substring of the document.

Cases: null or empty texts and texts without words never match, nor do items without words; items
that normalise alike each get their rows; repeated documents each get theirs; a null doc_id matches
in the filter and is left out of the pairs; an empty benchmark matches nothing, an empty table gives no
pairs; texts of any length are searched whole. The benchmark is sent to the tasks in parts of
PART_CHARS characters at most (or one item): a larger one is searched in several passes over the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspan.llm.words import WORD, _IS_WORD, buffers, slices
from marlspan.llm.words import parts as small_parts

ERRORS = 0.05
PART_CHARS = 8_000_000
_WORD = re.compile(WORD)


def normal(text: str) -> str:
    """The words, a space before and after each; "" without a word."""
    found = _WORD.findall(text.lower())
    return f" {' '.join(found)} " if found else ""


def distance(item: str, text: str, most: int) -> int:
    """Least edit distance of item to a substring of text; most + 1 when it is over most."""
    m = len(item)
    if not m:
        return 0
    peq: dict[str, int] = {}
    for i, c in enumerate(item):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = mask, 0, m, most + 1 if m > most else m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (mask & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = ph << 1 & mask, mh << 1 & mask
        pv = mh | (mask & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best = score
            if not best:
                break
    return best


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces that make up the item, and where they begin."""
    edge = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edge, edge[1:])]


def parts(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """The normalised items, in parts of at most PART_CHARS characters or one item."""
    out: list[list[tuple[int, str]]] = [[]]
    n = 0
    for r in benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text").distinct().orderBy("item_id", "text").toLocalIterator():
        text = normal(r["text"])
        if text:
            if out[-1] and n + len(text) > PART_CHARS:
                out.append([])
                n = 0
            out[-1].append((r["item_id"], text))
            n += len(text)
    return out


def budget(item: str, errors: float) -> int:
    """Edits that a normalised item may differ by."""
    return int(errors * (len(item) - 2))


class Items:
    """Items with the automaton of their pieces, which each process builds once."""

    def __init__(self, items: list[tuple[int, str]], errors: float) -> None:
        self.items, self.errors, self.built = items, errors, None

    def __getstate__(self) -> tuple:
        return self.items, self.errors, None

    def __setstate__(self, state: tuple) -> None:
        self.items, self.errors, self.built = state

    def automaton(self):
        """Pieces as the bytes that they are in UTF-8, each with (item's place, bytes before the piece)."""
        if self.built is None:
            where: dict[str, list[tuple[int, int]]] = {}
            for i, (_, text) in enumerate(self.items):
                for at, piece in pieces(text, budget(text, self.errors)):
                    where.setdefault(piece.encode().decode("latin-1"), []).append((i, len(text[:at].encode())))
            self.built = ahocorasick.Automaton()
            for piece, own in where.items():
                self.built.add_word(piece, (len(piece), own))
            self.built.make_automaton()
        return self.built


def normal_bytes(arr: pa.Array) -> Iterator[str]:
    """Each row's normalised text, its UTF-8 bytes as characters; the text must be in lower case."""
    off, data = buffers(arr)
    word = _IS_WORD[data]
    keep = word.copy()
    keep[1:] |= word[:-1]
    keep[off[:-1][off[:-1] < len(data)]] = word[off[:-1][off[:-1] < len(data)]]
    at = np.concatenate([[0], np.cumsum(keep)])[off]
    raw = np.where(word, data, 32)[keep].astype(np.uint8).tobytes().decode("latin-1")
    for a, b in zip(at[:-1], at[1:]):
        own = raw[a:b].rstrip(" ")
        yield f" {own} " if own else ""


def search(text: str, given: Items) -> dict[int, int]:
    """Place of each matching item, and its distance; text as of normal_bytes."""
    best: dict[int, int] = {}
    done: dict[int, list[tuple[int, int]]] = {}
    items = given.items
    for end, (length, own) in given.automaton().iter(text) if items else ():
        for i, before in own:
            item = items[i][1]
            k = budget(item, given.errors)
            if best.get(i, k + 1) == 0:
                continue
            # In bytes an edit is 4 at most.
            begin = end + 1 - length - before
            lo, hi = max(0, begin - 4 * k), begin + len(item.encode()) + 4 * k
            if any(a <= lo and hi <= b for a, b in done.get(i, ())):
                continue
            # Nearby hits share one window.
            hi += 64
            done.setdefault(i, []).append((lo, hi))
            d = distance(item, text[lo:hi].encode("latin-1").decode("utf-8", "ignore"), best.get(i, k + 1) - 1)
            if d < best.get(i, k + 1):
                best[i] = d
    return best


def matches(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS) -> DataFrame:
    """doc_id, item_id, distance: every document and item within the item's error budget."""
    text = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower("text").alias("text"))
    found = None
    for sent in _sent(benchmark, errors):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            given = sent.value
            for b in slices(batches):
                rows = [(d, given.items[i][0], n) for d, t in zip(b.column("doc_id").to_pylist(), normal_bytes(b.column("text"))) for i, n in search(t, given).items()]
                doc, item, n = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(n, pa.int32())], names=["doc_id", "item_id", "distance"])

        one = text.mapInArrow(run, "doc_id bigint, item_id bigint, distance int")
        found = one if found is None else found.union(one)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS) -> DataFrame:
    """docs without the documents that match an item; their columns as they came."""
    for sent in _sent(benchmark, errors):
        docs = docs.where(_clean(sent)(F.lower("text")))
    return docs


def _sent(benchmark: DataFrame, errors: float) -> list:
    """The benchmark's parts as broadcasts, each of a bounded size."""
    return [benchmark.sparkSession.sparkContext.broadcast(Items(items, errors)) for items in parts(benchmark)]


def _clean(sent):
    @F.arrow_udf("boolean")
    def clean(text: pa.Array) -> pa.Array:
        return pa.array([not search(t, sent.value) for part in small_parts(text) for t in normal_bytes(part)], pa.bool_())

    return clean
