"""Exact token counts of a byte-level BPE by compiled finite-state transducers.

Two deterministic transducers, each of whose transitions says how many items it completes:

- The splitter is the pre-tokenizer's pattern as a machine of ten states over classes of characters
  (with the next character's class as lookahead). Texts are cut into chunks, all chunks are walked at
  once from every state, the chunks' state maps are composed by a parallel prefix scan to find the
  state that each chunk begins in, and a second walk marks where pieces begin.
- The counter reads the bytes of a piece. A state stands for what the rest of a piece can depend on:
  the longest end that may grow into a token, and for each place in it the last token of the encoding
  up to there and its token count relative to now. Of the tokens that end at a byte one only is
  compatible with the encoding before it; the transition adds its count. States are compiled as texts
  need them, from the ranks alone, and dropped when there are too many.

Counts equal those of the tokenizer. Cases: a null or empty text has 0 tokens; texts of any length
are counted whole; special tokens' strings are ordinary text; repeated rows get equal counts; an empty
table gives none. Other columns pass through whatever their names.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspan.llm.words import _grown, buffers, mix

CHUNK = 512
#: Compiled states, and piece counts that are kept, before both start afresh.
STATES, PIECES = 250_000, 2_000_000

# Classes of characters: e l r v, one of s t m d, other letters, numbers, apostrophe, other, space, other white space, end.
_E, _LL, _RR, _V, _ONE, _L, _N, _Q, _O, _SP, _WS, _END = range(12)
_SPACES = [9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# States by what came last: nothing (or a contraction), letter, number, other, space, white space,
# an apostrophe before a one-letter and before a two-letter contraction, its first letter.
_FRESH, _IN_L, _IN_N, _IN_O, _IN_SP, _IN_WS, _Q1, _Q2, _Q3 = range(9)
_SAME = 12 * 12
_tables: list = []


def _classes() -> np.ndarray:
    out = np.full(sys.maxunicode + 1, _O, dtype=np.uint8)
    for c in range(sys.maxunicode + 1):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            out[c] = _L
        elif k == "N":
            out[c] = _N
    out[_SPACES] = _WS
    out[[ord(" "), ord("'"), ord("e"), ord("l"), ord("r"), ord("v")]] = _SP, _Q, _E, _LL, _RR, _V
    out[[ord(c) for c in "stmd"]] = _ONE
    return out


def _splitter() -> np.ndarray:
    """table[state, symbol]: 2 * next state + 1 if a piece begins at the character."""
    table = np.zeros((9, _SAME + 1), dtype=np.uint8)
    table[:, _SAME] = np.arange(9) * 2
    for state in range(9):
        for c in range(_END):
            for ahead in range(12):
                kind = _IN_L if c <= _L else {_N: _IN_N, _Q: _IN_O, _O: _IN_O, _SP: _IN_SP, _WS: _IN_WS}[c]
                spaces = state in (_IN_SP, _IN_WS)
                if state == _Q1:
                    to, begins = _FRESH, 0
                elif state == _Q3:
                    to, begins = _FRESH, 0
                elif state == _Q2 and ((c in (_RR, _V) and ahead == _E) or (c == _LL and ahead == _LL)):
                    to, begins = _Q3, 0
                else:
                    if c >= _SP:
                        begins = not spaces or (ahead < _SP)
                    elif state == _IN_SP:
                        begins = 0
                    else:
                        begins = kind != {_Q2: _IN_O}.get(state, state)
                    to = kind
                    if c == _Q and begins:
                        to = _Q1 if ahead == _ONE else _Q2 if ahead in (_RR, _V, _LL) else _IN_O
                table[state, c * 12 + ahead] = to * 2 + bool(begins)
    return table


def compose(maps: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """State in which each chunk begins, from the chunks' state maps, by a parallel prefix scan.

    maps[i, s] is the state after chunk i when it begins in s; fresh[i]: chunk i begins a text.
    """
    total = maps.copy()
    total[fresh] = maps[fresh, _FRESH][:, None]  # whatever came before, a text begins afresh
    step = 1
    while step < len(total):
        # total[i] after total[i - step]: first the earlier chunks, then these.
        total[step:] = np.take_along_axis(total[step:], total[:-step], axis=1)
        step *= 2
    entry = np.zeros(len(maps), dtype=total.dtype)
    entry[1:] = total[:-1, _FRESH]
    entry[fresh] = _FRESH
    return entry


def pieces(code: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each code point; off: where the texts begin, and the end."""
    if not _tables:
        _tables.extend([_classes(), _splitter()])
    classes, table = _tables
    n = np.diff(off)
    own = classes[code]
    ahead = np.empty(len(code), dtype=np.uint8)
    ahead[:-1] = own[1:]
    ahead[off[1:][n > 0] - 1] = _END
    symbol = own * np.uint8(12) + ahead
    chunks = -(-n // CHUNK)
    doc = np.repeat(np.arange(len(n)), chunks)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    begin = off[doc] + nth * CHUNK
    length = np.minimum(CHUNK, off[doc + 1] - begin)
    by = np.argsort(-length, kind="stable")
    active = np.searchsorted(-length[by], -np.arange(CHUNK), side="left")
    flat = table.ravel()
    wide = _SAME + 1
    state = np.tile(np.arange(9, dtype=np.int32), (len(doc), 1))
    where = begin[by]
    for t in range(CHUNK):
        k = int(active[t])
        if not k:
            break
        state[:k] = flat[state[:k] * wide + symbol[where[:k] + t].astype(np.int32)[:, None]] >> 1
    maps = np.empty_like(state)
    maps[by] = state
    now = compose(maps, nth == 0)[by]
    first = np.zeros(len(code), dtype=bool)
    for t in range(CHUNK):
        k = int(active[t])
        if not k:
            break
        got = flat[now[:k] * wide + symbol[where[:k] + t].astype(np.int32)]
        first[where[:k] + t] = got & 1
        now[:k] = got >> 1
    return first


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def splits(rank: dict[bytes, int]) -> dict[int, tuple[int, int]]:
    """The two tokens that each token was merged from; single bytes are left out, and what no merge makes."""
    out = {}
    for token, own in rank.items():
        if len(token) == 1:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min(((rank.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(own, 0))
            if best >= own:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2 and all(p in rank for p in parts):
            out[own] = (rank[parts[0]], rank[parts[1]])
    return out


class Counter:
    """Counts the tokens of pieces with lazily compiled states."""

    def __init__(self, rank: dict[bytes, int], split: dict[int, tuple[int, int]]) -> None:
        self.rank, self.split = rank, split
        self.made = {t: r for t, r in rank.items() if len(t) == 1 or r in split}
        self.merged = {pair: r for r, pair in split.items()}
        self.heads = {t[:i] for t in self.made for i in range(1, len(t))}
        self.valid: dict[tuple[int, int], bool] = {}
        self.known = np.zeros(0, dtype=np.uint64)
        self.counts = np.zeros(0, dtype=np.int32)
        self.fresh()

    def fresh(self) -> None:
        #: A state: its open end, and (last token, count relative to now) before it and after each of its bytes.
        self.states: list[tuple[bytes, tuple]] = [(b"", ((-1, 0),))]
        self.number = {self.states[0]: 0}
        #: state << 8 | byte: 2^20 * next state + tokens added + 2^19
        self.step: dict[int, int] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of two tokens' bytes together is those tokens: no merge crosses their border."""
        key = (a, b)
        if key in self.valid:
            return self.valid[key]
        limit, ok = 1 << 60, None
        while ok is None:
            m = self.merged.get((a, b))
            if m is not None and m < limit:
                ok = False
            elif a > b:
                limit = a
                if a in self.split:
                    a = self.split[a][1]
                else:
                    limit = b + 1
                    if b in self.split:
                        b = self.split[b][0]
                    else:
                        ok = True
            else:
                limit = b + 1
                if b in self.split:
                    b = self.split[b][0]
                else:
                    limit = a
                    if a in self.split:
                        a = self.split[a][1]
                    else:
                        ok = True
        self.valid[key] = ok
        return ok

    def compiled(self, state: int, byte: int) -> int:
        end, before = self.states[state]
        grown = end + bytes((byte,))
        for i in range(len(grown)):
            token = self.made.get(grown[i:])
            if token is None:
                continue
            last, rel = before[i]
            if last == -1 or self.compatible(last, token):
                break
        else:
            raise ValueError("no compatible token")
        added = rel + 1
        i = 0
        while i < len(grown) and grown[i:] not in self.heads:
            i += 1
        # What was before byte i of the end is before the first byte of the new end.
        key = (grown[i:], (*((t, r - added) for t, r in before[i:]), (token, 0)) if i <= len(end) else ((token, 0),))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        out = self.step[state << 8 | byte] = to << 20 | added + (1 << 19)
        return out

    def count(self, piece: bytes) -> int:
        if piece in self.rank:
            return 1
        state = n = 0
        for at in range(0, len(piece), 4096):
            if len(self.states) > STATES:  # also within a long piece: what goes on is the state that it is in
                now = self.states[state]
                self.fresh()
                self.valid.clear()
                state = self.number.setdefault(now, len(self.states))
                if state == len(self.states):
                    self.states.append(now)
            step = self.step
            for byte in piece[at : at + 4096]:
                got = step.get(state << 8 | byte) or self.compiled(state, byte)
                state = got >> 20
                n += (got & 0xFFFFF) - (1 << 19)
        return n

    def texts(self, text: str, off: np.ndarray) -> np.ndarray:
        """Token counts of the texts that off cuts out of text."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        count = np.zeros(len(off) - 1, dtype=np.int64)
        if not len(code):
            return count
        begin = np.flatnonzero(pieces(code, off))
        end = np.r_[begin[1:], len(code)]
        up, down = _grown(len(code) + 1)
        total = np.zeros(len(code) + 1, dtype=np.uint64)
        np.cumsum(mix(code.astype(np.uint64) + np.uint64(12345)) * up[: len(code)], out=total[1:])
        h = mix((total[end] - total[begin]) * down[begin])
        own, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, own), max(0, len(self.known) - 1))
        there = self.known[at] == own if len(self.known) else np.zeros(len(own), dtype=bool)
        n = np.zeros(len(own), dtype=np.int32)
        n[there] = self.counts[at[there]]
        new = np.flatnonzero(~there)
        for i, a, b in zip(new.tolist(), begin[first[new]].tolist(), end[first[new]].tolist()):
            n[i] = self.count(text[a:b].encode("utf-8", "surrogatepass"))
        if len(self.known) + len(new) > PIECES:
            self.known, self.counts = own, n
        else:
            keys = np.r_[self.known, own[new]]
            by = np.argsort(keys, kind="stable")
            self.known, self.counts = keys[by], np.r_[self.counts, n[new]][by]
        np.add.at(count, np.searchsorted(off, begin, side="right") - 1, n[inverse])
        return count


_counters: dict = {}
BATCH = 2_000_000


def batches(arr: pa.Array) -> Iterator[tuple[str, np.ndarray]]:
    """Parts of a text column: the joined texts, and where each begins in code points."""
    off, data = buffers(arr)
    lo = 0
    while lo < len(off) - 1:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + BATCH, side="right")) - 1)
        raw = data[off[lo] : off[hi]]
        # Code points begin at bytes that don't continue one.
        place = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        yield raw.tobytes().decode("utf-8", "surrogatepass"), place[off[lo : hi + 1] - off[lo]]
        lo = hi


def counted(docs: DataFrame, path: str, column: str) -> DataFrame:
    """docs with the token count of text by the rank file at path, which the driver reads."""
    rank = ranks(path)
    split = splits(rank)
    sent = docs.sparkSession.sparkContext.broadcast((rank, split))

    @F.arrow_udf("bigint")
    def tokens(text: pa.Array) -> pa.Array:
        if path not in _counters:
            _counters[path] = Counter(*sent.value)
        parts = [_counters[path].texts(*b) for b in batches(text)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64))

    return docs.withColumn(column, tokens(F.coalesce("text", F.lit(""))))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and n_tokens."""
    return counted(docs.select("doc_id", "text"), path, "n_tokens").select("doc_id", "n_tokens")
