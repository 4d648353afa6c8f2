"""Maximal repeats of the corpus: an interval tree over an enhanced suffix array, built where text repeats.

A maximal repeat is a sequence of MIN_WORDS words at least, with two occurrences that differ (or end)
on the left and two that differ on the right. All repeats are given with all of their occurrences, but
not one by one: a passage in g documents that vary after it is g occurrences, of each of up to g
repeats. The result is the interval tree itself: suffixes that begin alike, in order, a row each; a
repeat is an interval of them, and its occurrences are where they start. occurrences() lists them.

1. Winnowing: of every MIN_WORDS words the least k-gram is an anchor, so that all occurrences of a
   repeat hold its first anchor at the same offset. Anchors that occur once can't start a repeat, nor
   can those before which all occurrences have the same words: what they lie in began further left.
2. The suffixes at and before the remaining anchors, up to where repetition ends, go to the task of
   their anchor, those of a run (three copies at least) as one: it is a contiguous part of the corpus'
   suffix array. There they are sorted, and a
   stack scan over the longest common prefixes yields the interval tree; intervals with one left
   extension only are dropped.

An anchor of more than HOT occurrences isn't one task's: what begins before it is put in order by a range
sort over all tasks, each of which finds the intervals within it; those that span several are found from
the few places where an interval can end (see below). So no task holds all occurrences of a passage.

Nothing is sampled or capped. Shuffled are one anchor in about 18 words, and repeated passages as
compressed text: words are compared by 64-bit hashes, those of all the words of a passage.

Cases: null or empty texts and texts of under MIN_WORDS words have no repeat, nor have rows without
doc_id; repeated rows of one doc_id are one document; a repeat may occur several times in one
document; in a run (one passage again and again, copy after copy) the number of repeats and occurrences
grows with the square of its length, so that a row may stand for several: where period > 0, suffixes
begin at start and a period after each other, as long as their words lie within reach words from start,
and where a repeat has fewer > 0, it without its last period words is one too, at all of these
occurrences and period words after each, and so on, fewer times; an empty table gives no repeats. Only doc_id and
text are read, whatever other columns there are. Ties: occurrences have no order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspan.llm.words import SLICE_BYTES, Words, _grown, lean, mix, slices, words
from marlspan.shared import cut, sized_join

MIN_WORDS = 50
#: Bytes of a word's hash where suffixes are compared.
UNIT = 8
_TOP = np.uint64(2**64 - 1)


def _sizes(min_words: int) -> tuple[int, int]:
    """Words of an anchor, and k-grams of a window."""
    k = max(1, min_words // 3)
    return k, min_words - k + 1


def anchors(w: Words, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """k-gram hashes by word (2^64 - 1: none), and the anchors' words."""
    k, width = _sizes(min_words)
    m = len(w.hash)
    none = np.zeros(0, dtype=np.int64)
    if not m:
        return np.zeros(0, dtype=np.uint64), none
    left = w.first[w.doc + 1] - np.arange(m)
    up, down = _grown(m + 1)
    total = np.zeros(m + 1, dtype=np.uint64)
    np.cumsum(w.hash * up[:m], out=total[1:])
    g = np.full(m, _TOP, dtype=np.uint64)
    at = np.flatnonzero(left >= k)
    g[at] = mix((total[at + k] - total[at]) * down[at]) >> np.uint64(1)
    # Place of the first least k-gram of each window, by doubling.
    padded = np.concatenate([g, np.full(width, _TOP, dtype=np.uint64)])
    place, size = np.arange(m), 1
    while size < width:
        step = min(size, width - size)
        ahead = np.minimum(place[np.minimum(np.arange(m) + step, m - 1)], m - 1)
        place = np.where(padded[ahead] < padded[place], ahead, place)
        size += step
    chosen = np.zeros(m, dtype=bool)
    chosen[place[left >= min_words]] = True
    return g, np.flatnonzero(chosen)


def sums(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two arrays by which a stretch of words is hashed: (total[end] - total[start]) * down[start]."""
    up, down = _grown(len(w.hash) + 1)
    total = np.zeros(len(w.hash) + 1, dtype=np.uint64)
    np.cumsum(w.hash * up[: len(w.hash)], out=total[1:])
    return total, down


def runs(w: Words, g: np.ndarray, p: np.ndarray, total: np.ndarray, down: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """The anchors p in groups with a period: copies that follow each other, three at least; else one, period 0."""
    if len(p) < 3:
        for x in p:
            yield np.array([x]), 0
        return
    q = p[np.lexsort((p, g[p], w.doc[p]))]
    # Between neighbours of one anchor: their distance (0: others), and the words that it spans.
    step = np.where((w.doc[q[1:]] == w.doc[q[:-1]]) & (g[q[1:]] == g[q[:-1]]), np.diff(q), 0)
    span = (total[q[1:]] - total[q[:-1]]) * down[q[:-1]]
    goes_on = (step[1:] > 0) & (step[1:] == step[:-1]) & (span[1:] == span[:-1])
    i = 0
    ends = np.flatnonzero(~goes_on)
    while i < len(q):
        n = 1
        if i < len(goes_on) and goes_on[i]:
            at = np.searchsorted(ends, i)
            n = (int(ends[at]) if at < len(ends) else len(goes_on)) - i + 2
        yield q[i : i + n], int(step[i]) if n > 1 else 0
        i += n


def _anchored(min_words: int):
    _, width = _sizes(min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            w = words(b.column("text"))
            g, p = anchors(w, min_words)
            ids = b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            doc, pos = w.doc[p], p - w.first[w.doc[p]]
            full = pos >= width
            total, down = sums(w)
            back = np.where(full, p - width, p)
            before = mix((total[p] - total[back]) * down[back])
            alone = mix(ids[doc].astype(np.uint64) * np.uint64(2654435761) + pos.astype(np.uint64) + np.uint64(77))
            sig = np.where(full, before, alone)
            yield pa.RecordBatch.from_arrays([pa.array(g[p].view(np.int64)), pa.array(ids[doc]), pa.array(pos.astype(np.int32)), pa.array(sig.view(np.int64))], names=["h", "doc_id", "pos", "sig"])

    return run


#: Bits beside an anchor's place: what precedes its occurrences differs; it is in more than HOT places.
DIVERSE, OFTEN = 1, 2
#: Occurrences from which an anchor's suffixes are ordered by several tasks.
HOT = 20_000
#: Suffixes from which on a task's trees become rows.
LISTED = 100_000


def _plain(w: Words) -> tuple[bytes, np.ndarray]:
    """The words, a space after each, and where each begins (and the end)."""
    size = w.end - w.start
    at = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(int(at[-1]), 32, dtype=np.uint8)
    own = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at[:-1], size) + own] = w.data[np.repeat(w.start, size) + own]
    return out.tobytes(), at


def _sent(b: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    h, p, masks, period, left, body, r = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), b.column("doc_id").take(pa.array(r)), pa.array(p, pa.int32()), pa.array(masks, pa.list_(pa.int64())), pa.array(period, pa.int32()), pa.array(left, pa.int32()), pa.array(body, pa.binary())], names=["h", "doc_id", "pos", "masks", "period", "n_left", "body"])


def _received(b: pa.RecordBatch) -> Iterator[tuple[int, "Row"]]:
    """The anchors and suffixes of what _sent made."""
    unpack = zstandard.ZstdDecompressor().decompress
    for lo, bodies in _unpacked(map(unpack, (x.as_py() for x in b.column("body")))):
        part = b.slice(lo, len(bodies))
        w = words(pa.array(bodies, pa.large_binary()))
        raw = w.hash.astype(">u8").tobytes()
        back = w.hash[::-1].astype(">u8").tobytes()
        first, end = w.first.tolist(), UNIT * len(w.hash)
        rows = zip(*(part.column(c).to_pylist() for c in ("h", "doc_id", "pos", "masks", "period", "n_left")))
        for r, (h, doc, pos, masks, period, n) in enumerate(rows):
            a, z = UNIT * first[r], UNIT * first[r + 1]
            yield h, Row(doc, pos, tuple(masks), period, back[end - a - UNIT * n : end - a], raw[a + UNIT * n : z])


def _unpacked(bodies: Iterator[bytes], most: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Bodies in lists of at most so many bytes, or a body more, and the number of each list's first."""
    lo, own, held = 0, [], 0
    for x in bodies:
        own.append(x)
        held += len(x)
        if held > most:
            yield lo, own
            lo, own, held = lo + len(own), [], 0
    if own:
        yield lo, own


def starts_of(a: int, g: np.ndarray, lo: int, hi: int, width: int, min_words: int) -> range:
    """How far before anchor a the starts lie whose first anchor it is: those whose window holds no lesser
    k-gram, and none as little before it, and from which min_words are left."""
    ahead = np.flatnonzero(g[a + 1 : min(hi, a + width)] < g[a])
    before = np.flatnonzero(g[max(lo, a - width + 1) : a][::-1] <= g[a])
    first = max(0, min_words - (hi - a), a + width - (a + 1 + int(ahead[0])) if len(ahead) else 0)
    return range(first, int(before[0]) + 1 if len(before) else min(width, a - lo + 1))


def _chains(at: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row's anchors in order, their words, and the last ones of chains: repetition ends there, but for what no anchor witnesses."""
    at = np.sort(at)
    pos = at >> 2
    at, pos = at[pos < n], pos[pos < n]
    return at, pos, np.r_[np.flatnonzero(np.diff(pos) > width), len(pos) - 1]


def _suffixes(min_words: int):
    k, width = _sizes(min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches):
            w = words(b.column("text"))
            g, _ = anchors(w, min_words)
            plain, place = _plain(w)
            total, down = sums(w)
            rows: list[tuple] = []
            held = 0
            lists = b.column("at")
            for r in range(b.num_rows):
                lo, hi = int(w.first[r]), int(w.first[r + 1])
                at, pos, end = _chains(lists[r].values.to_numpy(), hi - lo, width)
                for own, period in runs(w, g, lo + pos[(at & 3) == DIVERSE], total, down):
                    masks = [max(0, (1 << x.stop) - (1 << x.start)) for x in (starts_of(a, g, lo, hi, width, min_words) for a in own.tolist())]
                    a = int(own[0])
                    p = a - lo
                    if any(masks):
                        stop = min(hi, lo + int(pos[end[np.searchsorted(end, np.searchsorted(pos, own[-1] - lo))]]) + width + k)
                        begin = max(lo, a - width)
                        rows.append((int(g[a].view(np.int64)), p, masks, period, a - begin, pack(plain[place[begin] : place[stop]]), r))
                        held += len(rows[-1][5])
                        if held > 16_000_000:
                            yield _sent(b, rows)
                            rows, held = [], 0
            if rows:
                yield _sent(b, rows)

    return run


def _common(x: bytes, y: bytes) -> int:
    """Words that begin both."""
    n = min(len(x), len(y))
    differ = np.frombuffer(x, dtype=np.uint8, count=n) != np.frombuffer(y, dtype=np.uint8, count=n)
    i = int(differ.argmax()) if n else 0
    return (i if n and differ[i] else n) // UNIT


def intervals(lcp: list[int], left: list, least: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan: (first, last, length) of the intervals of a suffix array with two left extensions.

    lcp[i] is that of the suffixes i - 1 and i; left[i] is what precedes suffix i, None if nothing does.
    """
    many = object()

    def joined(a, b):
        return many if a is many or b is many or a is None or b is None or a != b else a

    stack: list[list] = []  # [length, first, left]
    for i in range(1, len(left) + 1):
        now = lcp[i] if i < len(left) else -1
        first, seen = i - 1, left[i - 1]
        single = True
        while stack and stack[-1][0] > now:
            length, first, above = stack.pop()
            seen = joined(above, seen)
            single = False
            if length >= least and seen is many:
                yield first, i - 1, length
        if stack and stack[-1][0] == now:
            stack[-1][2] = joined(stack[-1][2], seen)
        elif now >= 0:
            stack.append([now, i - 1 if single else first, seen])


class Row(NamedTuple):
    """Suffixes of one anchor: of each copy of a run, period words apart, or of one place (period 0).

    masks: the starts before each copy's anchor; left: words before the first, reversed; right: words from it on.
    """

    doc: int
    pos: int
    masks: tuple[int, ...]
    period: int
    left: bytes
    right: bytes

    def copy(self, i: int, width: int) -> tuple[bytes, bytes]:
        """left and right of one copy."""
        at = UNIT * i * self.period
        near = np.frombuffer(self.right[max(0, at - UNIT * width) : at], dtype=np.uint8).reshape(-1, UNIT)[::-1].tobytes()
        return (near + self.left)[: UNIT * width], self.right[at:]

    def extent(self, period: int, i: int = 0) -> int:
        """How many words from a copy on have a period."""
        x = self.right[UNIT * i * self.period :]
        return period + _common(x[UNIT * period :], x) if len(x) > UNIT * period else len(x) // UNIT


def needed(rows: list[Row]) -> list[list[int]]:
    """Of each row the copies to compare: all that are as far from their run's end as another row's first copies.

    Repeats of other copies are these, less whole periods at their ends.
    """
    periods = {r.period for r in rows if r.period}
    if not periods:
        return [[0]] * len(rows)
    far = {p: {r.extent(p, i) for r in rows for i in {0, min(1, len(r.masks) - 1), max(0, len(r.masks) - 2), len(r.masks) - 1}} for p in periods}
    out = []
    for r in rows:
        n = len(r.masks)
        own = {0, n - 1}
        if r.period:
            e = r.extent(r.period)
            for x in far[r.period]:
                t = max(0, -((x - e) // r.period))
                own |= {t, t + 1}
            others = periods - {r.period}
            if others:  # what is shorter than two periods may have both
                own |= set(range(max(0, (e - r.period - max(others)) // r.period), n))
        out.append(sorted(i for i in own if i < n))
    return out


class Tree(NamedTuple):
    """The suffixes of one start before one anchor, in order, and their intervals that are maximal repeats.

    suffixes: (doc, start, period, reach): in a run, further suffixes begin a period after each other, and
    so many words from the first start on have the period. repeats: (first and last suffix, words,
    occurrences, period, fewer).
    """

    name: int
    suffixes: list[tuple[int, int, int, int]]
    repeats: list[tuple[int, int, int, int, int, int]]


def trees(h: int, found: list[Row], min_words: int) -> Iterator[Tree]:
    """The trees of one anchor's suffixes."""
    _, width = _sizes(min_words)
    rows_of = sorted(set(found))
    own = []  # (right, doc, pos, mask, left, row, copy)
    for r, (row, copies) in enumerate(zip(rows_of, needed(rows_of))):
        for i in copies:
            if row.masks[i]:
                left, right = row.copy(i, width)
                own.append((right, row.doc, row.pos + i * row.period, row.masks[i], left, r, i))
    own.sort()
    if len(own) < 2:
        return
    extent = [r.extent(r.period) if r.period else 0 for r in rows_of]
    second = [r.copy(1, width)[0] if r.period else b"" for r in rows_of]
    lcp = [0] + [_common(x[0], y[0]) for x, y in zip(own, own[1:])]
    todo = [(0, list(range(len(own))))]
    while todo:
        d, rows = todo.pop()
        # While one word precedes all, nothing starts here that could not start further left.
        while d < width:
            before = [own[i][4][UNIT * d : UNIT * d + UNIT] or None for i in rows]
            if before[0] is None or any(x != before[0] for x in before):
                break
            d += 1
        if d >= width:
            continue
        start = [i for i in rows if own[i][3] >> d & 1]
        if len(start) > 1:
            inner = [0] * len(start)
            if len(start) == len(rows) and rows[-1] - rows[0] + 1 == len(rows):
                inner[1:] = lcp[rows[0] + 1 : rows[-1] + 1]
            else:
                for j in range(1, len(start)):
                    inner[j] = min(lcp[start[j - 1] + 1 : start[j] + 1])
            got = list(intervals(inner, [own[i][4][UNIT * d : UNIT * d + UNIT] or None for i in start], min_words - d))
            if got:
                name = hashlib.blake2b(own[start[0]][4][: UNIT * d], digest_size=8, key=(h & 0xFFFFFFFFFFFFFFFF).to_bytes(8)).digest()
                yield _tree(int.from_bytes(name, signed=True), d, [own[i] for i in start], inner, got, rows_of, extent, second, min_words)
        parts: dict[bytes, list[int]] = {}
        for i, x in zip(rows, before):
            if x is not None:
                parts.setdefault(x, []).append(i)
        todo += [(d + 1, p) for p in parts.values() if len(p) > 1]


def _tree(name: int, d: int, own: list[tuple], inner: list[int], got: list[tuple[int, int, int]], rows_of: list[Row], extent: list[int], second: list[bytes], min_words: int) -> Tree:
    suffixes, run = [], False
    for _, doc, pos, _, left, r, i in own:
        period = rows_of[r].period
        # Copies after the second are like it; they are told by the first and the second.
        inside = extent[r] and d < period and i < 2 and second[r][: UNIT * d] == left[: UNIT * d]
        suffixes.append((doc, pos - d, period, extent[r] - i * period + d) if inside else (doc, pos - d, 0, 0))
        run = run or bool(inside)
    if not run:
        return Tree(name, suffixes, [(a, b, n + d, b - a + 1, 0, 0) for a, b, n in got])
    repeats = []
    # The longest first: they tell which shorter ones they stand for.
    implied: set[tuple] = set()
    for a, b, n in sorted(got, key=lambda x: -x[2]):
        where = {(doc, s + j * p) for doc, s, p, reach in suffixes[a : b + 1] for j in (range((reach - n - d) // p + 1) if p and reach >= n + d else (0,))}
        if (min(where), n) in implied:
            continue
        inside = {own[j][5] for j in range(a, b + 1) if suffixes[j][2] and suffixes[j][3] >= n + d}
        period = fewer = 0
        periods = {rows_of[r].period for r in inside}
        if len(periods) == 1:
            [period] = periods
            # The next row that holds as much of it as is left.
            far = np.minimum.accumulate(np.array(inner[a::-1])) if a else np.zeros(0, dtype=np.int64)
            near = np.minimum.accumulate(np.array(inner[b + 1 :])) if b + 1 < len(own) else np.zeros(0, dtype=np.int64)
            joins = max([int(x) for x, j in zip(far, range(a - 1, -1, -1)) if own[j][5] not in inside][:1] + [int(x) for x, j in zip(near, range(b + 1, len(own))) if own[j][5] not in inside][:1] + [0])
            fewer = max(0, min((n + d - min_words) // period, (n - 1 - joins) // period))
            implied |= {(min(where), n - t * period) for t in range(1, fewer + 1)}
        repeats.append((a, b, n + d, len(where), period if fewer else 0, fewer))
    return Tree(name, suffixes, repeats)


_REPEAT = [("last", pa.int64()), ("n_words", pa.int32()), ("n_occurrences", pa.int32()), ("period", pa.int32()), ("fewer", pa.int32())]
_RESULT = "group_id bigint, place bigint, doc_id bigint, start int, period int, reach int, repeats array<struct<last: bigint, n_words: int, n_occurrences: int, period: int, fewer: int>>"


def _listed(many: list[Tree]) -> pa.RecordBatch:
    """Rows of the trees' suffixes that are in a repeat; each repeat stands at its first suffix."""
    name, place, suffix, opens, repeats = [], [], [], [], []
    for t in many:
        covered = np.zeros(len(t.suffixes) + 1, dtype=np.int64)
        for a, b, *_ in t.repeats:
            covered[a] += 1
            covered[b + 1] -= 1
        at = np.flatnonzero(np.cumsum(covered)[:-1]).tolist()
        own: dict[int, list[tuple]] = {}
        for a, *rest in t.repeats:
            own.setdefault(a, []).append(rest)
        name += [t.name] * len(at)
        place += at
        suffix += [t.suffixes[i] for i in at]
        for i in at:
            x = own.get(i, ())
            opens.append(len(x))
            repeats += x
    doc, start, period, reach = np.array(suffix, dtype=np.int64).reshape(-1, 4).T
    inner = np.array(repeats, dtype=np.int64).reshape(-1, 5).T
    fields = pa.StructArray.from_arrays([pa.array(x).cast(kind) for x, (_, kind) in zip(inner, _REPEAT)], names=[n for n, _ in _REPEAT])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(opens)]).astype(np.int32)), fields)
    return pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), pa.array(place, pa.int64()), pa.array(doc), *(pa.array(x.astype(np.int32)) for x in (start, period, reach)), lists], names=["group_id", "place", "doc_id", "start", "period", "reach", "repeats"])


def _grouped(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own, made, held = None, [], [], 0
        alike: dict[bytes, bytes] = {}  # copies of a passage are held once
        for h, row in chain((x for b in batches for x in _received(b)), [(None, None)]):
            if h != last:
                for t in trees(last, own, min_words) if len(own) > 0 else ():
                    made.append(t)
                    held += len(t.suffixes)
                    if held > LISTED:
                        yield _listed(made)
                        made, held = [], 0
                last, own, alike = h, [], {}
            if row:
                own.append(row._replace(left=alike.setdefault(row.left, row.left), right=alike.setdefault(row.right, row.right)))
        if made:
            yield _listed(made)

    return run


# Anchors of very many occurrences. Each start before them is a suffix of its own; those of one start (one
# anchor, distance and words between) are put in order by a range sort, so that they may lie in several tasks.
# Each task finds the intervals that end within it, and reduces its suffixes to segments, whose borders are the
# places where the common prefix is the shortest seen from its first or from its last suffix: only there can an
# interval end that goes on in another task. The segments of all tasks are few; a second scan finds the others.


def _hot_starts(min_words: int):
    """(g, before, doc_id, at) of each start before a hot anchor. g names the start's words, before is the word before it."""
    _, width = _sizes(min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            w = words(b.column("text"))
            grams, _ = anchors(w, min_words)
            ids = b.column("doc_id").to_pylist()
            rows = []
            for r, at in enumerate(b.column("at").to_pylist()):
                lo, hi = int(w.first[r]), int(w.first[r + 1])
                for pos in sorted(x >> 2 for x in at if x & 3 == DIVERSE | OFTEN):
                    a = lo + pos
                    for d in starts_of(a, grams, lo, hi, width, min_words) if a < hi else ():
                        name = hashlib.blake2b(w.hash[a - d : a].tobytes(), digest_size=8, key=int(grams[a]).to_bytes(8)).digest()
                        rows.append((int.from_bytes(name, signed=True), int(w.hash[a - d - 1].view(np.int64)) if a - d > lo else None, ids[r], pos * 64 + d))
            g, before, doc, at = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(before, pa.int64()), pa.array(doc, pa.int64()), pa.array(at, pa.int64())], names=["g", "before", "doc_id", "at"])

    return run


def _hot_suffixes(min_words: int):
    """(g, d, before, doc_id, start, body) of the starts that are given; body: the words from the anchor on, a space after each."""
    k, width = _sizes(min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=["g", "d", "before", "doc_id", "start", "body"])

        for b in slices(batches):
            w = words(b.column("text"))
            plain, place = _plain(w)
            rows, held = [], 0
            for r, (doc, at, given) in enumerate(zip(*(b.column(c).to_pylist() for c in ("doc_id", "at", "starts")))):
                lo, hi = int(w.first[r]), int(w.first[r + 1])
                _, pos, end = _chains(np.array(at, dtype=np.int64), hi - lo, width)
                for x in given:
                    a, d = x["at"] >> 6, x["at"] & 63
                    if a >= hi - lo:
                        continue
                    stop = min(hi, lo + int(pos[end[np.searchsorted(end, np.searchsorted(pos, a))]]) + width + k)
                    rows.append((x["g"], d, x["before"], doc, a - d, plain[place[lo + a] : place[stop]].decode("utf-8", "surrogatepass")))
                    held += len(rows[-1][5])
                    if held > 16_000_000:
                        yield out(rows)
                        rows, held = [], 0
            if rows:
                yield out(rows)

    return run


def _alike(x: bytes, y: bytes) -> int:
    """Words that begin both bodies."""
    n = min(len(x), len(y))
    differ = np.frombuffer(x, dtype=np.uint8, count=n) != np.frombuffer(y, dtype=np.uint8, count=n)
    i = int(differ.argmax()) if n else 0
    return x.count(b" ", 0, i if n and differ[i] else n)


_SEGMENT = "segment boolean, head string, tail string, d int, n_rows bigint, last bigint, before bigint, diverse boolean, above int, pending bigint"
_HOT = f"group_id bigint, place bigint, doc_id bigint, start int, period int, reach int, repeats array<struct<last: bigint, n_words: int, n_occurrences: int, period: int, fewer: int>>, {_SEGMENT}"
_HOT_ARROW = pa.schema(
    [("group_id", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()), ("period", pa.int32()), ("reach", pa.int32()), ("repeats", pa.list_(pa.struct(_REPEAT)))]
    + [("segment", pa.bool_()), ("head", pa.string()), ("tail", pa.string()), ("d", pa.int32()), ("n_rows", pa.int64()), ("last", pa.int64()), ("before", pa.int64()), ("diverse", pa.bool_()), ("above", pa.int32()), ("pending", pa.int64())]
)


def _repeat(last: int, n_words: int, count: int) -> dict:
    return {"last": last, "n_words": n_words, "n_occurrences": count, "period": 0, "fewer": 0}


def _ordered(min_words: int):
    """Of suffixes in order, those of one g together: those that are in a repeat, with the repeats that lie within this task,
    and the segments of the g that may go on in another."""

    def closed(g: int, own: list[tuple], lcp: list[int], base: int, edge: bool, ends: tuple[str, str]) -> Iterator[dict]:
        d = own[0][0]
        left = [x[1] for x in own]
        opens: dict[int, list[dict]] = {}
        inside = np.zeros(len(own) + 1, dtype=np.int64)
        for a, b, n in intervals(lcp, left, min_words - d):
            if not edge or (a > 0 and b < len(own) - 1):
                opens.setdefault(a, []).append(_repeat(base + b, n + d, b - a + 1))
                inside[a] += 1
                inside[b + 1] -= 1
        inside = np.cumsum(inside)
        cuts, low = {0}, None
        for i in range(1, len(own)) if edge else ():
            if low is None or lcp[i] < low:
                cuts.add(i)
                low = lcp[i]
        low = None
        for i in range(len(own) - 1, 0, -1) if edge else ():
            if low is None or lcp[i] < low:
                cuts.add(i)
                low = lcp[i]
        # What is in no repeat here may be in one that goes on in another task: its segment will tell.
        least, at = min_words - d, 0
        for i, (_, _, doc, start) in enumerate(own):
            at = i if i in cuts else at
            if inside[i] or edge and (i in (0, len(own) - 1) or max(lcp[i], lcp[i + 1]) >= least):
                yield {"group_id": g, "place": base + i, "doc_id": doc, "start": start, "period": 0, "reach": 0, "repeats": opens.get(i, []), "segment": False, "pending": None if inside[i] else base + at}
        if not edge:
            return
        cut_ = sorted(cuts) + [len(own)]
        for a, b in zip(cut_, cut_[1:]):
            same = left[a] is not None and all(x == left[a] for x in left[a:b])
            yield {
                "group_id": g, "place": base + a, "doc_id": own[a][2], "start": own[a][3], "period": 0, "reach": 0, "repeats": [], "segment": True, "d": d, "n_rows": b - a, "last": base + b - 1,
                "before": left[a] if same else None, "diverse": not same, "above": lcp[a] if a else None, "head": None if a else ends[0], "tail": ends[1] if b == len(own) else None,
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        g_now, own, lcp, head, last, first = None, [], [], None, None, True
        out: list[dict] = []
        for b in batches:
            for g, d, before, doc, start, body in zip(*(b.column(c).to_pylist() for c in ("g", "d", "before", "doc_id", "start", "body"))):
                if g != g_now:
                    if own:
                        out += closed(g_now, own, lcp, base, first, (head, last))
                        base += len(own)
                        first = False
                        if len(out) > 50_000:
                            yield pa.RecordBatch.from_pylist(out, _HOT_ARROW)
                            out = []
                    g_now, own, lcp, head, last = g, [], [], body, None
                elif own and own[-1][2:] == (doc, start):
                    continue  # a repeated row
                lcp.append(_alike(last.encode(), body.encode()) if own else 0)
                own.append((d, before, doc, start))
                last = body
        if own:
            out += closed(g_now, own, lcp, base, True, (head, last))
        if out:
            yield pa.RecordBatch.from_pylist(out, _HOT_ARROW)

    return run


def _joined(min_words: int):
    """The repeats of several segments of one g, each in a row of its first suffix, and the segments that are in one."""

    def found(own: list[dict]) -> Iterator[dict]:
        lcp = [0]
        for x, y in zip(own, own[1:]):
            lcp.append(y["above"] if y["above"] is not None else _alike(x["tail"].encode(), y["head"].encode()))
        d, total = own[0]["d"], np.cumsum([0] + [x["n_rows"] for x in own]).tolist()
        left = [None if x["diverse"] else x["before"] for x in own]
        opens: dict[int, list[dict]] = {}
        inside = np.zeros(len(own) + 1, dtype=np.int64)
        for a, b, n in intervals(lcp, left, min_words - d):
            opens.setdefault(a, []).append(_repeat(own[b]["last"], n + d, total[b + 1] - total[a]))
            inside[a] += 1
            inside[b + 1] -= 1
        for a, repeats in opens.items():
            yield {k: own[a][k] for k in ("group_id", "place", "doc_id", "start", "period", "reach")} | {"repeats": repeats, "segment": False}
        for a in np.flatnonzero(np.cumsum(inside)[:-1]).tolist():
            yield {"group_id": own[a]["group_id"], "segment": True, "pending": own[a]["place"]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[dict] = []
        for b in batches:
            out: list[dict] = []
            for x in b.to_pylist():
                if own and own[0]["group_id"] != x["group_id"]:
                    out += found(own)
                    own = []
                own.append(x)
            yield pa.RecordBatch.from_pylist(out, _HOT_ARROW)
        yield pa.RecordBatch.from_pylist(list(found(own)) if own else [], _HOT_ARROW)

    return run


def _hot_repeats(own: DataFrame, min_words: int) -> DataFrame:
    """The rows of maximal_repeats for hot anchors; own: doc_id, text, at."""
    parts = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = own.where(F.exists("at", lambda x: x.bitwiseAND(3) == DIVERSE | OFTEN))
    starts = cut(own.mapInArrow(lean(_hot_starts(min_words)), "g bigint, before bigint, doc_id bigint, at bigint"))
    # Starts that occur once, or always after the same word, begin no repeat.
    differ = (F.count("before") < F.count("*")) | (F.min("before") != F.max("before"))
    kept = cut(starts.groupBy("g").agg(F.count("*").alias("n"), differ.alias("differ")).where("n > 1 AND differ").select("g"))
    given = cut(sized_join(starts, kept, "g", "left_semi").groupBy("doc_id").agg(F.collect_set(F.struct("at", "g", "before")).alias("starts")))
    bodies = sized_join(own, given, "doc_id", "inner").select("doc_id", "text", "at", "starts").mapInArrow(lean(_hot_suffixes(min_words)), "g bigint, d int, before bigint, doc_id bigint, start int, body string")
    order = ("g", "body", "doc_id", "start")
    scanned = cut(bodies.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(lean(_ordered(min_words)), _HOT))
    segments = scanned.where("segment").repartition(parts, "group_id").sortWithinPartitions("group_id", "place")
    across = cut(segments.mapInArrow(lean(_joined(min_words)), _HOT))
    # A suffix is a row where a repeat holds it, as elsewhere.
    rows = scanned.where("NOT segment")
    held = sized_join(rows.where("pending IS NOT NULL"), across.where("segment").select("group_id", "pending"), ["group_id", "pending"], "left_semi")
    found = rows.where("pending IS NULL").unionByName(held).drop(*[c.split()[0] for c in _SEGMENT.split(", ")])
    opened = across.where("NOT segment").select("group_id", "place", F.col("repeats").alias("more"))
    return sized_join(found, opened, ["group_id", "place"], "left").withColumn("repeats", F.concat("repeats", F.coalesce("more", F.array()))).drop("more")


def occurrences(found: DataFrame) -> DataFrame:
    """Of maximal_repeats' rows every occurrence of every repeat: group_id, first (the repeat's place), whole_words
    (of the row that it is of), n_words, doc_id, start. Their number may grow with the square of the rows."""
    repeat = found.select("group_id", F.col("place").alias("first"), F.explode("repeats").alias("r")).select("group_id", "first", "r.last", "r.n_words", F.col("r.period").alias("step"), "r.fewer")
    both = repeat.join(found.select("group_id", "place", "doc_id", "start", "period", "reach"), "group_id").where("place BETWEEN first AND last")
    copies = F.when((F.col("period") > 0) & (F.col("reach") >= F.col("n_words")), F.expr("(reach - n_words) div period")).otherwise(0).cast("int")
    less = both.select("*", F.explode(F.sequence(F.lit(0), copies)).alias("j")).select("*", F.explode(F.sequence(F.lit(0), F.col("fewer"))).alias("t")).select("*", F.explode(F.sequence(F.lit(0), F.col("t"))).alias("u"))
    return less.select("group_id", "first", F.col("n_words").alias("whole_words"), F.expr("n_words - t * step").alias("n_words"), "doc_id", F.expr("start + j * period + u * step").alias("start")).distinct()


def maximal_repeats(docs: DataFrame, min_words: int = MIN_WORDS, hot: int = HOT) -> DataFrame:
    """Groups of suffixes in order, and the intervals of them that are repeats: group_id, place (in the order), doc_id, start
    (the suffix's first word, from 0), period and reach, repeats (those whose interval begins here, to its last place)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower("text").alias("text"))
    every = cut(text.mapInArrow(lean(_anchored(min_words)), "h bigint, doc_id bigint, pos int, sig bigint"))
    often = F.when(F.col("n") > hot, OFTEN).otherwise(0)
    flags = cut(every.groupBy("h").agg(F.count("*").alias("n"), (F.min("sig") != F.max("sig")).cast("int").alias("diverse")).where("n > 1").select("h", (F.col("diverse") + often).alias("flag")))
    places = cut(sized_join(every, flags, "h", "inner").groupBy("doc_id").agg(F.collect_set(F.col("pos") * 4 + F.col("flag")).alias("at")))
    own = sized_join(text, places, "doc_id", "inner").select("doc_id", "text", "at")
    suffixes = own.mapInArrow(lean(_suffixes(min_words)), "h bigint, doc_id bigint, pos int, masks array<bigint>, period int, n_left int, body binary")
    found = suffixes.repartition(parts, "h").sortWithinPartitions("h").mapInArrow(lean(_grouped(min_words)), _RESULT)
    if flags.where(F.col("flag") == DIVERSE | OFTEN).isEmpty():
        return found
    return found.union(_hot_repeats(own, min_words))
