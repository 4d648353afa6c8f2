"""N-gram Jaccard self-join: a blocked sparse product of the document by n-gram incidence matrix.

Documents of one n-gram set are one row of the matrix, a node (a 64-bit hash of the set). Blocks are
what two searches connect. 3-row bands of minimum hashes over all n-grams of each whole text: nodes that
share a band key. This misses a pair of Jaccard J with probability (1 - J^3)^BANDS, 0.005 at the
threshold 0.5, so that a second search is exact. With the n-grams of all sets in one order, the rarest
first, a pair at the threshold t shares one of the first |a| - t|a| + 1 n-grams of either, and the first
that it shares, at places p and q, leaves room for the overlap: 1 + min(|a| - p - 1, |b| - q - 1) is
t / (1 + t) (|a| + |b|) at least. Nodes of which this is true are connected, as are all that share one of
these n-grams where they are more than LIST. Within a block the product is exact:
overlaps are summed over all n-grams, columns of one node are dropped, and pairs are discarded
when sizes alone rule them out (t|a| > |b|) or the overlap is under t / (1 + t) (|a| + |b|).

Skew: band keys are reduced to stars in each slice of the input, so that a key that all rows have is
one row a slice; a block of more than CELL incidences is split into slots, and each pair of slots is a
cell, a task's work of its own. No document, partner or candidate is capped. Copies are never
expanded to pairs: a document's links are counted, and its class is named by its least document.

Cases: null or empty texts and texts without a word have no n-gram, so no link and a class of their
own; a null doc_id has no row; a text shorter than the n-gram has one n-gram, of all its words;
repeated rows (one doc_id, one text) are one document, while one doc_id with several texts has a row
for each; an empty table gives no rows; pairs at the threshold count. Only doc_id and text are read,
whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspan.llm.words import Words, grams, lean, mix, slices, words
from marlspan.operators.components import connected_components
from marlspan.shared import cut, sized_join

N, THRESHOLD, BANDS, ROWS = 3, 0.5, 40, 3
#: Distinct sets from which a block is multiplied in tiles, rows and columns of a tile, documents of a light column.
DENSE, TILE, COLUMNS, LIGHT = 24, 512, 4096, 32
#: Incidences after which whole blocks that were gathered are multiplied.
FLUSH = 1_500_000
#: Incidences of a slot: heavier blocks are multiplied in several cells.
CELL = 4_000_000
#: Postings of one n-gram up to which pairs are held against the bounds; more become a star.
LIST = 64
#: n-grams, repeated ones too, that are counted at once.
COUNTED = 1_000_000
#: Names beside the columns of documents that pass through.
AGAIN, GONE = "__marlspan_again_b7c2", "__marlspan_gone_b7c2"
_MULTIPLIER = np.random.default_rng(7).integers(1, 2**63, ROWS * 64, dtype=np.uint64) | np.uint64(1)


def _row_grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-gram hashes and the first of each row, with the count at the end."""
    h, at = grams(w, n)
    return h, np.searchsorted(at, w.first)


def band_keys(h: np.ndarray, first: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have n-grams, and their keys: a matrix of int64."""
    rows = np.flatnonzero(np.diff(first))
    keys = np.empty((len(rows), bands), dtype=np.int64)
    if len(rows):
        at = first[rows]
        low = [np.minimum.reduceat((h * m) >> np.uint64(20), at) for m in _MULTIPLIER[: ROWS * bands]]
        for k in range(bands):
            key = np.full(len(rows), k * 0x9E3779B9, dtype=np.uint64)
            for x in low[ROWS * k : ROWS * k + ROWS]:
                key = mix(key + x)
            keys[:, k] = key.view(np.int64)
    return rows, keys


#: Rows of the search for blocks: a document and its node; a node and one of its block; a band key and a node that has it.
MEMBER, EDGE, KEY = 0, 1, 2
_FOUND = "kind tinyint, a bigint, b bigint, c int"


def _distinct(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's distinct n-grams in order, the first of each row (and the count), and each row's node: a hash of its set."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    by = np.lexsort((h, row))
    h, row = h[by], row[by]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    edge = np.searchsorted(row, np.arange(len(first)))
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(mix(h + np.uint64(0x51ED270B)), out=total[1:])
    return h, edge, mix(total[edge[1:]] - total[edge[:-1]] + np.diff(edge).astype(np.uint64)).view(np.int64)


def _rows(kind: int, a: np.ndarray, b: pa.Array | np.ndarray, c: np.ndarray | None = None) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, dtype=np.int8)), pa.array(a), pa.array(b), pa.array(np.zeros(n, dtype=np.int32) if c is None else c.astype(np.int32))], names=["kind", "a", "b", "c"])


def _starred_runs(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (key, node) sorted by both: the keys' first places, each entry's least node, and whether it is another."""
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    least = np.repeat(node[start], np.diff(np.r_[start, len(key)]))
    return start, least, least != node


def _keyed(n: int, bands: int):
    """Members, and, of each slice, stars of the nodes of one band key, whose centre alone goes on with the key."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            h, first = _row_grams(words(b.column("text")), n)
            h, first, node = _distinct(h, first)
            size = np.diff(first)
            yield _rows(MEMBER, b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), pa.array(node, mask=size == 0), size)
            rows, keys = band_keys(h, first, bands)
            if not len(rows):
                continue
            key, own = keys.ravel(), np.repeat(node[rows], bands)
            by = np.lexsort((own, key))
            key, own = key[by], own[by]
            start, least, other = _starred_runs(key, own)
            yield _rows(KEY, key[start], own[start])
            if other.any():
                a, c = np.unique(np.stack([own[other], least[other]]), axis=1)
                yield _rows(EDGE, a, c)

    return run


@lean
def _starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by a and b: keys become stars of the nodes that have them."""
    last, centre = None, 0
    for b in batches:
        kind, a, c = (b.column(x).to_numpy(zero_copy_only=False) for x in ("kind", "a", "c"))
        yield b.filter(pa.array(kind != KEY))
        at = kind == KEY
        key, node = a[at].astype(np.int64), b.column("b").filter(pa.array(at)).to_numpy().astype(np.int64)
        if not len(key):
            continue
        start, least, _ = _starred_runs(key, node)
        if key[0] == last:  # the run began in an earlier batch
            least[: start[1] if len(start) > 1 else len(key)] = centre
        last, centre = key[-1], least[-1]
        other = least != node
        if other.any():
            yield _rows(EDGE, node[other], least[other])


#: Rows of the exact search: a slice's nodes and their sizes; n-grams of a slice and the rows that have them.
_COUNTED = "bucket int, slice bigint, nodes binary, rows binary, grams binary, counts binary"


def _packed(x: np.ndarray, width: int) -> bytes:
    """The low bytes of numbers, first bytes first, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())


def _unpacked(x: bytes, width: int) -> np.ndarray:
    low = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=np.uint8).reshape(width, -1)
    out = np.zeros((low.shape[1], 8), dtype=np.uint8)
    out[:, :width] = low.T
    return out.view("<u8").ravel()


def _grams_part(bucket: int, at: int, rows: np.ndarray, grams: np.ndarray, counts: np.ndarray | None = None) -> dict:
    """n-grams of a bucket, whose number is their last bits, by ascending rows."""
    return {
        "bucket": bucket, "slice": at, "rows": _packed(np.diff(rows, prepend=0), 4), "grams": _packed(grams >> np.uint64(8), 7), "counts": None if counts is None else _packed(counts, 8)
    }


def _rows_and_grams(x: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_unpacked(x["rows"], 4).astype(np.int64)), _unpacked(x["grams"], 7) << np.uint64(8) | np.uint64(x["bucket"] & 255)


_COUNTED_ARROW = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), *((c, pa.binary()) for c in ("nodes", "rows", "grams", "counts"))])


def _bucketed(n: int, buckets: int):
    """Of each slice its nodes, and its n-grams by buckets of their hashes."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for b in slices(batches):
            h, first, node = _distinct(*_row_grams(words(b.column("text")), n))
            size = np.diff(first)
            row = np.repeat(np.arange(len(node)), size)
            bucket = h & np.uint64(buckets - 1)
            by = np.argsort(bucket, kind="stable")
            h, row, bucket = h[by], row[by], bucket[by]
            edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(h) else np.zeros(1, dtype=np.int64)
            out = [_grams_part(int(bucket[x]), at, row[x:y], h[x:y]) for x, y in zip(edge[:-1], edge[1:])]
            out.append({"bucket": at % buckets, "slice": at, "nodes": np.stack([node, size]).tobytes()})
            yield pa.RecordBatch.from_pylist(out, _COUNTED_ARROW)
            at += 1

    return run


@lean
def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: the n-grams that occur again, with their counts, for the slices that they came from."""

    def counted(held: list[dict]) -> pa.RecordBatch:
        own = [_rows_and_grams(x) for x in held]
        gram = np.concatenate([g for _, g in own])
        by = np.argsort(gram)
        start = np.flatnonzero(np.r_[True, gram[by][1:] != gram[by][:-1]])
        df = np.diff(np.r_[start, len(gram)])
        count = np.empty(len(gram), dtype=np.int64)
        count[by] = np.repeat(df, df)
        out, lo = [], 0
        for x, (row, g) in zip(held, own):
            c = count[lo : lo + len(row)]
            at = np.flatnonzero(c > 1)
            if len(at):
                out.append(_grams_part(x["bucket"], x["slice"], row[at], g[at], c[at]))
            lo += len(row)
        return pa.RecordBatch.from_pylist(out, _COUNTED_ARROW)

    held: list[dict] = []
    for b in batches:
        yield b.filter(b.column("nodes").is_valid())
        for x in b.filter(b.column("nodes").is_null()).to_pylist():
            if held and held[0]["bucket"] != x["bucket"]:
                yield counted(held)
                held = []
            held.append(x)
    if held:
        yield counted(held)


def _prefixes(t: float):
    """Rows sorted by slice: each node's first n-grams, those that occur once left out, with their places in the order."""

    def posted(held: list[dict]) -> pa.RecordBatch:
        node, size = next(np.frombuffer(x["nodes"], dtype=np.int64).reshape(2, -1) for x in held if x["nodes"] is not None)
        own = [(*_rows_and_grams(x), _unpacked(x["counts"], 8)) for x in held if x["nodes"] is None]
        row, gram, count = (np.concatenate(x) for x in zip(*own)) if own else (np.zeros(0, dtype=kind) for kind in (np.int64, np.uint64, np.uint64))
        by = np.lexsort((gram, count, row))
        row, gram = row[by], gram[by]
        many = np.bincount(row, minlength=len(node))
        # n-grams that occur once come first.
        place = np.arange(len(row)) - (np.cumsum(many) - many)[row] + (size - many)[row]
        at = np.flatnonzero(place <= size[row] - np.ceil(t * size[row] - 1e-9))
        cols = [pa.array(gram[at].view(np.int64)), pa.array(node[row[at]]), pa.array(size[row[at]].astype(np.int32)), pa.array(place[at].astype(np.int32))]
        return pa.RecordBatch.from_arrays(cols, names=["gram", "node", "size", "place"])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:
            for x in b.to_pylist():
                if held and held[0]["slice"] != x["slice"]:
                    yield posted(held)
                    held = []
                held.append(x)
        if held:
            yield posted(held)

    return run


def _index_pairs(start: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places within each run, some 100,000 or more at a time."""
    i, j, held = [], [], 0
    for m in np.unique(length[length > 1]).tolist():
        x, y = np.triu_indices(m, 1)
        at = start[length == m]
        most = max(1, 200_000 // len(x))
        for lo in range(0, len(at), most):
            i.append((at[lo : lo + most, None] + x).ravel())
            j.append((at[lo : lo + most, None] + y).ravel())
            held += len(i[-1])
            if held > 100_000:
                yield np.concatenate(i), np.concatenate(j)
                i, j, held = [], [], 0
    if held:
        yield np.concatenate(i), np.concatenate(j)


def _possible(t: float):
    """Postings sorted by gram and node: pairs of nodes that the bounds allow, or stars of those of a gram that many have."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), dtype=np.int64)
        long = None  # the n-gram of a star that goes on
        for b in chain(batches, [None]):
            if b is not None:
                held = np.concatenate([held, np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("gram", "node", "size", "place")])], axis=1)
            gram, node, size, place = held
            if not len(gram):
                continue
            start = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
            length = np.diff(np.r_[start, len(gram)])
            # The last run may go on in the next batch, unless it is a star already: then its centre is enough.
            star = (length > LIST) | (gram[start] == long)
            whole = np.ones(len(start), dtype=bool)
            whole[-1] = b is None or star[-1]
            found = []
            for x, m in zip(start[star & whole].tolist(), length[star & whole].tolist()):
                found.append((np.full(m - 1, node[x]), node[x + 1 : x + m]))
            short = ~star & whole
            for i, j in _index_pairs(start[short], length[short]):
                small, large = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
                room = 1 + np.minimum(size[i] - place[i] - 1, size[j] - place[j] - 1)
                ok = (small >= t * large - 1e-9) & (room * (1 + t) >= t * (small + large) - 1e-9) & (node[i] != node[j])
                found.append((node[i[ok]], node[j[ok]]))
            if found:
                a, c = np.unique(np.stack([np.concatenate(x) for x in zip(*found)]), axis=1)
                yield _rows(EDGE, c, a)
            last = int(start[-1])
            long = int(gram[-1]) if star[-1] else None
            held = held[:, last : last + 1] if star[-1] else held[:, last:]

    return run


def exact_edges(text: DataFrame, n: int, t: float, total: int) -> DataFrame:
    """(a, b): nodes that may be at the threshold t, and all pairs of nodes that are. total: n-grams of all sets."""
    parts = int(text.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 1 << max(8, (4 * parts - 1).bit_length(), (-(-total // COUNTED)).bit_length())
    counted = text.mapInArrow(_bucketed(n, buckets), _COUNTED).repartition(parts, "bucket").sortWithinPartitions("bucket")
    again = counted.mapInArrow(_frequent, _COUNTED).repartition(parts, "slice").sortWithinPartitions("slice")
    postings = again.mapInArrow(_prefixes(t), "gram bigint, node bigint, size int, place int").repartition(parts, "gram").sortWithinPartitions("gram", "node")
    return postings.mapInArrow(_possible(t), _FOUND).where("a != b").select("a", "b")


def _sets(n: int):
    """Sets of the rows whose node is the one that is looked for."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            h, first, node = _distinct(*_row_grams(words(b.column("text")), n))
            same = b.column("node").to_numpy() == node
            grams = pa.array([h[x:y].tobytes() for x, y in zip(first[:-1], first[1:])], pa.binary())
            out = pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "node", "m", "slot", "cells")), grams], names=["doc_id", "node", "m", "slot", "cells", "grams"])
            yield out.filter(pa.array(same))

    return run


def _pairs_of_runs(row: np.ndarray, start: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries within each run of a sorted incidence list."""
    for m in np.unique(length[length > 1]):
        at = start[length == m]
        for x in range(m):
            for y in range(x + 1, m):
                yield row[at + x], row[at + y]


def _tiled(sets: list[np.ndarray], size: np.ndarray, t: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of one large block: light columns are multiplied entry by entry, heavy ones as dense tiles."""
    n = len(sets)
    order = np.argsort(size, kind="stable")  # sizes alone then rule out whole tiles
    ranked = size[order]
    values = np.concatenate([sets[k] for k in order])
    row = np.repeat(np.arange(n), ranked)
    by = np.argsort(values, kind="stable")
    values, row = values[by], row[by]
    start = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    df = np.diff(np.r_[start, len(values)])
    tiles = -(-n // TILE)
    light = [np.minimum(i, j) * n + np.maximum(i, j) for i, j in _pairs_of_runs(row, start[df <= LIGHT], df[df <= LIGHT])]
    code, count = np.unique(np.concatenate(light), return_counts=True) if light else (np.zeros(0, dtype=np.int64),) * 2
    li, lj = code // n, code % n
    by_tile = np.argsort((li // TILE) * tiles + lj // TILE, kind="stable")
    li, lj, count = li[by_tile], lj[by_tile], count[by_tile]
    tile_of = (li // TILE) * tiles + lj // TILE
    many = np.repeat(df > LIGHT, df)
    column = (np.cumsum(df > LIGHT) - 1)[np.repeat(np.arange(len(df)), df)[many]]
    row = row[many]
    width = int((df > LIGHT).sum())
    by = np.argsort(row, kind="stable")
    row, column = row[by], column[by]
    at = np.searchsorted(row, np.minimum(np.arange(tiles + 1) * TILE, n))

    def dense(z: int, c0: int) -> np.ndarray:
        r, c = row[at[z] : at[z + 1]] - z * TILE, column[at[z] : at[z + 1]] - c0
        inside = (c >= 0) & (c < COLUMNS)
        out = np.zeros((min(TILE, n - z * TILE), min(COLUMNS, width - c0)), dtype=np.float32)
        out[r[inside], c[inside]] = 1
        return out

    for x in range(tiles):
        a = ranked[x * TILE : (x + 1) * TILE]
        for y in range(x, tiles):
            b = ranked[y * TILE : (y + 1) * TILE]
            if a[-1] < t * b[0]:
                break
            total = np.zeros((len(a), len(b)), dtype=np.float32)
            if at[x] < at[x + 1] and at[y] < at[y + 1]:
                for c0 in range(0, width, COLUMNS):
                    left = dense(x, c0)
                    total += left @ (left if x == y else dense(y, c0)).T
            lo, hi = np.searchsorted(tile_of, [x * tiles + y, x * tiles + y + 1])
            total[li[lo:hi] - x * TILE, lj[lo:hi] - y * TILE] += count[lo:hi]
            # The bound that sizes set on the overlap; most of the tile ends here.
            i, j = np.nonzero((total > 0) & (total * (1 + t) >= t * (a[:, None] + b[None, :]) - 1e-4))
            if x == y:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield order[i + x * TILE], order[j + y * TILE], total[i, j].astype(np.int64)


def overlaps(sets: list[np.ndarray], block: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs i < j of one block with Jaccard t at least, and their overlaps. block must be sorted."""
    size = np.array([len(s) for s in sets])
    edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def keep(i: np.ndarray, j: np.ndarray, c: np.ndarray) -> None:
        a, b = size[i], size[j]
        ok = (np.minimum(a, b) >= t * np.maximum(a, b)) & (c * (1 + t) >= t * (a + b) - 1e-9) & (c > 0)
        found.append((i[ok], j[ok], c[ok]))

    small = []
    for lo, hi in zip(edge[:-1], edge[1:]):
        if hi - lo < 2:
            continue
        if hi - lo < DENSE:
            small.append(np.arange(lo, hi))
            continue
        for i, j, c in _tiled([sets[k] for k in range(lo, hi)], size[lo:hi], t):
            keep(np.minimum(i, j) + lo, np.maximum(i, j) + lo, c)
    if small:
        # All small blocks at once: entries sorted by (block, n-gram), pairs within each run.
        members = np.concatenate(small)
        row = np.repeat(members, size[members])
        key = mix(np.concatenate([sets[k] for k in members])) + mix(block[row].astype(np.uint64) + np.uint64(99991))
        by = np.argsort(key, kind="stable")
        key, row = key[by], row[by]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        length = np.diff(np.r_[start, len(key)])
        codes = [i * len(sets) + j for i, j in _pairs_of_runs(row, start, length)]
        if codes:
            code, c = np.unique(np.concatenate(codes), return_counts=True)
            keep(code // len(sets), code % len(sets), c)
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Whole cells, of rows sorted by cell, as columns; repeated nodes of a cell are left out."""
    names = ("cell", "crossed", "slot", "node", "rep", "m", "grams")
    held: dict[str, list] = {c: [] for c in names}
    size, last = 0, None
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in names)):
            if size >= FLUSH and row[0] != held["cell"][-1]:
                yield held
                held, size = {c: [] for c in names}, 0
            if (row[0], row[3]) == last:
                continue
            last = (row[0], row[3])
            for c, x in zip(names[:-1], row):
                held[c].append(x)
            held["grams"].append(np.frombuffer(row[-1], dtype=np.uint64))
            size += len(row[-1]) >> 3
    if held["cell"]:
        yield held


def _products(batches: Iterator[pa.RecordBatch], t: float) -> Iterator[tuple[dict[str, list], np.ndarray, np.ndarray, np.ndarray]]:
    """Cells, and their pairs with overlaps; of a cell of two slots the pairs across them."""
    for held in _gathered(batches):
        i, j, c = overlaps(held["grams"], np.unique(np.array(held["cell"]), return_inverse=True)[1], t)
        slot = np.array(held["slot"])
        ok = ~np.array(held["crossed"])[i] | (slot[i] != slot[j])
        yield held, i[ok], j[ok], c[ok]


def _linked(t: float):
    """Each node that has a partner in its cell: the documents that it is linked to there, and its root there."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, i, j, _ in _products(batches, t):
            rep, m = np.array(held["rep"]), np.array(held["m"])
            links = np.zeros(len(rep), dtype=np.int64)
            np.add.at(links, i, m[j])
            np.add.at(links, j, m[i])
            root = rep.copy()
            while True:
                low = root.copy()
                np.minimum.at(low, i, root[j])
                np.minimum.at(low, j, root[i])
                if (low == root).all():
                    break
                root = low
            at = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(held["node"], pa.int64()).take(pa.array(at)), pa.array(rep[at]), pa.array(links[at]), pa.array(root[at])], names=["node", "rep", "links", "root"])

    return run


def _paired(t: float):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, i, j, c in _products(batches, t):
            rep, size = np.array(held["rep"]), np.array([len(g) for g in held["grams"]])
            a, b = rep[i], rep[j]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(c), pa.array(np.round(c / (size[i] + size[j] - c), 6))], names=["doc_id_a", "doc_id_b", "overlap", "jaccard"])

    return run


class Blocks(NamedTuple):
    """members: doc_id and node (its n-gram set; null without n-gram); copies: rep and m of the nodes of several documents; cells: what is multiplied; split: whether any block is several cells."""

    members: DataFrame
    copies: DataFrame
    cells: DataFrame
    split: bool


def blocks(docs: DataFrame, n: int, threshold: float, bands: int, cell: int) -> Blocks:
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    found = text.mapInArrow(_keyed(n, bands), _FOUND).repartition(parts, "a").sortWithinPartitions("a", "b")
    kinds = cut(found.mapInArrow(_starred, _FOUND))
    members = kinds.where(F.col("kind") == MEMBER).select(F.col("a").alias("doc_id"), F.col("b").alias("node"), F.col("c").alias("size")).distinct()
    nodes = members.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("m"), F.max("size").alias("size"))
    edges = kinds.where((F.col("kind") == EDGE) & (F.col("a") != F.col("b"))).select("a", "b")
    total = members.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    edges = edges.union(exact_edges(text, n, threshold, total)).distinct()
    block = connected_components(cut(edges)).select("node", F.col("component").alias("block"))
    # Each block's incidences tell into how many slots it is split; its cells are the pairs of slots.
    member = cut(block.join(nodes, "node"))
    weight = member.groupBy("block").agg(F.sum("size").alias("w")).select("block", F.ceil(F.col("w") / cell).cast("int").alias("slots"))
    heavy = cut(weight.where("slots > 1"))
    split = heavy.count()
    placed = sized_join(member, heavy, "block", "left", split).withColumn("slots", F.coalesce("slots", F.lit(1)))
    slot = F.pmod(F.xxhash64("node"), F.col("slots")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("other")
    each = placed.withColumn("slot", slot).select("node", "rep", "m", "block", "slot", other).select(
        "node", "rep", "m", "slot", (F.col("slot") != F.col("other")).alias("crossed"), F.xxhash64("block", F.least("slot", "other"), F.greatest("slot", "other")).alias("cell")
    )
    lean = cut(each.groupBy("rep", "node").agg(F.first("m").alias("m"), F.first("slot").alias("slot"), F.collect_list(F.struct("cell", "crossed")).alias("cells")))
    sets = sized_join(text, lean.withColumnRenamed("rep", "doc_id"), "doc_id", "inner").mapInArrow(_sets(n), "doc_id bigint, node bigint, m bigint, slot int, cells array<struct<cell:bigint,crossed:boolean>>, grams binary")
    cells = sets.select(F.explode("cells").alias("x"), "slot", "node", F.col("doc_id").alias("rep"), "m", "grams").select("x.cell", "x.crossed", "slot", "node", "rep", "m", "grams")
    return Blocks(members.select("doc_id", "node"), nodes.where("m > 1").select("node", "rep", "m"), cells.repartition(parts, "cell").sortWithinPartitions("cell", "node"), split > 0)


def near_classes(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, bands: int = BANDS, cell: int = CELL) -> DataFrame:
    """doc_id, class_id (the least doc_id that links lead to) and n_links, the other documents at or over the threshold."""
    b = blocks(docs, n, threshold, bands, cell)
    linked = cut(b.cells.mapInArrow(_linked(threshold), "node bigint, rep bigint, links bigint, root bigint"))
    if b.split:  # the cells of one block tell parts of a class: the roots are joined
        edges = linked.select(F.col("rep").alias("a"), F.col("root").alias("b"))
        low = connected_components(cut(edges.where("a != b").distinct())).select(F.col("node").alias("rep"), "component")
        linked = linked.groupBy("node", "rep").agg(F.sum("links").alias("links"), F.min("root").alias("root")).join(low, "rep", "left").select("node", "rep", "links", F.coalesce("component", "root").alias("root"))
    pairs = linked.select("node", "links", "root")
    side = cut(pairs.join(b.copies, "node", "full").select("node", F.least("root", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.coalesce("m", F.lit(1)) - 1).alias("n_links")))
    return sized_join(b.members, side, "node", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def representative_pairs(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, bands: int = BANDS, cell: int = CELL) -> DataFrame:
    """doc_id_a < doc_id_b, overlap in distinct n-grams, jaccard (6 places): all pairs of different n-gram sets, by their least documents."""
    return blocks(docs, n, threshold, bands, cell).cells.mapInArrow(_paired(threshold), "doc_id_a bigint, doc_id_b bigint, overlap bigint, jaccard double")


def keep_one(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, bands: int = BANDS, cell: int = CELL) -> DataFrame:
    """docs with one document of each near-duplicate class, the one of the least doc_id.

    First, of several rows with one doc_id the one of the least text stays (a null text is the least;
    of equal rows any); rows without a doc_id stay.
    """
    again = cut(docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(AGAIN)))
    rows = again.count()
    if rows:
        same = F.col("doc_id") == F.col(AGAIN)
        once = sized_join(docs, again, same, "left_anti", rows)
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        first = sized_join(docs, again, same, "left_semi", rows).groupBy("doc_id").agg(F.min_by(whole, F.struct("text", *[F.col(f"`{c}`").cast("string") for c, kind in docs.dtypes if c not in ("text", "doc_id")])).alias(AGAIN))
        docs = once.unionByName(cut(first.select(f"{AGAIN}.*")).select(docs.columns))
    gone = cut(near_classes(docs, n, threshold, bands, cell).where("doc_id != class_id").select(F.col("doc_id").alias(GONE)))
    return sized_join(docs, gone, F.col("doc_id").cast("bigint") == F.col(GONE), "left_anti")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z_\x{80}-\x{10FFFF}]+') AS ws FROM documents WHERE doc_id IS NOT NULL),
p AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS gram FROM p),
s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
m AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS overlap FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id != b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM m JOIN s sa ON sa.doc_id = x JOIN s sb ON sb.doc_id = y WHERE overlap * 1.5 >= 0.5 * (sa.n + sb.n)),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x, least(x, min(y)) AS class_id FROM r GROUP BY x),
k AS (SELECT x, count(*) AS n_links FROM e GROUP BY x)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(n_links, 0) AS n_links
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) d LEFT JOIN c ON c.x = d.doc_id LEFT JOIN k ON k.x = d.doc_id
"""
