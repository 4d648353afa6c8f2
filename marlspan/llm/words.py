"""Words and n-grams of an Arrow string column as numpy arrays, without a Python object per word.

A word is a maximal run of bytes that are ASCII letters, ASCII digits, the underscore or part of
a non-ASCII character. Callers lower-case the text first (in the JVM), so that case never counts.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from marlspan.shared import give_back

#: The same words as a Python regular expression, for brute-force comparisons.
WORD = r"[0-9A-Za-z_\u0080-\U0010ffff]+"
#: Bytes of text that are worked on at once; a longer single text is worked on alone.
SLICE_BYTES = 2_000_000

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(int(_R), -1, 2**64))
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123)]] = True
_IS_WORD[128:] = True
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse, n of each at least."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_R, _R_INV)):
            p = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A finalizer: every bit of the result depends on every bit of h."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Words(NamedTuple):
    """start, end: byte places in data; doc: the row of each word; first: each row's first word, and the count at the end."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string array; a null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    _, at, data = arr.buffers()
    if len(arr) == 0 or at is None:
        return np.zeros(len(arr) + 1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    off = np.frombuffer(at, dtype=np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return off - off[0], raw


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, whose task gives back what it freed: else each worker that waits for its next task keeps the most it ever held."""

    @functools.wraps(run)
    def leaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return leaner


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batches with at most so many bytes of text each, or one row."""
    for b in batches:
        off, _ = buffers(b.column(column))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, side="right")) - 1)
            yield b.slice(lo, hi - lo)
            lo = hi


def parts(arr: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of a text column with at most so many bytes each, or one row."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    off, _ = buffers(arr)
    lo = 0
    while lo < len(arr):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, side="right")) - 1)
        yield arr.slice(lo, hi - lo)
        lo = hi


def words(arr: pa.Array) -> Words:
    off, data = buffers(arr)
    n = len(data)
    is_word = np.zeros(n + 2, dtype=bool)
    is_word[1:-1] = _IS_WORD[data]
    inside = is_word[1:-1] & is_word[:-2]
    cuts = off[(off > 0) & (off < n)]
    inside[cuts] = False
    start = np.flatnonzero(is_word[1:-1] & ~inside)
    goes_on = np.zeros(n, dtype=bool)
    goes_on[:-1] = inside[1:]
    end = np.flatnonzero(is_word[1:-1] & ~goes_on) + 1
    up, down = _grown(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    h = mix((total[end] - total[start]) * down[start])
    first = np.searchsorted(start, off)
    return Words(data, start, end, h, np.repeat(np.arange(len(off) - 1), np.diff(first)), first)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams and the word that each begins at.

    A row with fewer words than n has one gram, of all its words; a row without words has none.
    """
    m = len(w.hash)
    h = np.zeros(m, dtype=np.uint64)
    left = w.first[w.doc + 1] - np.arange(m) if m else np.zeros(0, dtype=np.int64)
    for k in range(n):
        c = np.uint64((2 * k + 3) * 0xC2B2AE3D27D4EB4F & (2**64 - 1))
        part = np.zeros(m, dtype=np.uint64)
        part[: m - k] = mix(w.hash[k:] + c) if m > k else 0
        h += np.where(left > k, part, np.uint64(0)) if n > 1 else part
    size = w.first[1:] - w.first[:-1]
    ok = (left >= n) | ((np.arange(m) == w.first[w.doc]) & (size[w.doc] < n) if m else False)
    at = np.flatnonzero(ok)
    return mix(h[at]), at
