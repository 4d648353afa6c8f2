"""Each operator against a brute-force version on a small fixture."""

import collections
import io
import math
import os
import random
import re
import subprocess
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import zstandard

from marlspan.llm import boosting, decontam, jaccard, langid, licenses, lmscore, media, mixing, pii, repeats, tokens
from marlspan.llm.words import WORD, grams, words

RNG = random.Random(4)
VOCABULARY = [f"w{i}" for i in range(2500)]


def passages_in_noise(n: int, seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    pool = [[rng.choice(VOCABULARY) for _ in range(rng.randint(8, 40))] for _ in range(6)]
    out = []
    for d in range(n):
        w = []
        for _ in range(rng.randint(1, 4)):
            w += [rng.choice(VOCABULARY) for _ in range(rng.randint(0, 12))]
            p, a = rng.choice(pool), rng.randint(0, 6)
            w += p[a : len(p) - rng.randint(0, 6)]
            if rng.random() < 0.3:
                w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
        out.append((d, " ".join(w)))
    return out


def test_words_match_the_regular_expression():
    texts = ["Héllo, wörld_1! ", "", "a", "  ", "ß中文 x-y"]
    w = words(pa.array(texts))
    got = [[bytes(w.data[a:b]).decode() for a, b, d in zip(w.start, w.end, w.doc) if d == k] for k in range(len(texts))]
    assert got == [re.findall(WORD, t) for t in texts]
    assert len(set(w.hash.tolist())) == len({x for t in texts for x in re.findall(WORD, t)})
    h, at = grams(words(pa.array(["a b c d", "a b", "a b c", ""])), 3)
    assert len(h) == 4 and h[0] == h[3] and len(set(h.tolist())) == 3


def found_repeats(spark, docs: list, least: int, hot: int = repeats.HOT) -> list[tuple]:
    """(occurrences, words) of all repeats."""
    found = repeats.maximal_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), least, hot).cache()
    own = collections.defaultdict(list)
    for r in repeats.occurrences(found).collect():
        own[r.group_id, r.first, r.whole_words, r.n_words].append((r.doc_id, r.start))
    told = {(r.group_id, r.place, x.n_words): x.n_occurrences for r in found.collect() for x in r.repeats}
    assert all(len(own[g, f, n, n]) == c for (g, f, n), c in told.items())
    return [(tuple(sorted(x)), k[3]) for k, x in own.items()]


@pytest.mark.parametrize("hot,seed", [(1, 3), (6, 5), (2, 11)])
def test_repeats_of_hot_anchors_span_tasks(spark, hot, seed):
    """With few occurrences counting as many, the suffixes of a start lie in several tasks."""
    docs = passages_in_noise(60, seed)
    docs += [(100 + k, docs[k % 3][1]) for k in range(9)] + [(100, docs[1][1])]
    w = {d: t.split() for d, t in docs}
    docs[-1] = (100, docs[60][1])  # a repeated row
    w[100] = docs[60][1].split()
    got = found_repeats(spark, docs, 10, hot)
    assert set(got) == brute_repeats(w, 10) and len(got) == len(set(got))


@pytest.mark.parametrize("hot", [1, 4, 6])
def test_hot_anchors_give_no_row_beside_repeats(spark, hot):
    # The same word precedes most copies: what they share besides is no repeat of its own.
    rng = random.Random(hot)
    made = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
    passage, tails = made(30), [made(14) for _ in range(4)]
    docs = [(d, f"{'same' if d % 4 else made(3)} {passage} {tails[d % 4]} {made(3)}") for d in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows, plain = ([r for r in repeats.maximal_repeats(df, 10, h).collect()] for h in (hot, 10**6))
    opened = [(r.group_id, r.place, x["last"]) for r in rows for x in r.repeats]
    assert all(any(g == r.group_id and a <= r.place <= b for g, a, b in opened) for r in rows)
    assert len({(r.group_id, r.place) for r in rows}) == len(rows)
    assert sorted((r.doc_id, r.start) for r in rows) == sorted((r.doc_id, r.start) for r in plain)


def test_one_hot_passage_is_ordered_by_all_tasks(spark, monkeypatch):
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(12)]
    w = {k: [rng.choice("abc") for _ in range(rng.randint(0, 3))] + passage + [rng.choice("xy") for _ in range(rng.randint(0, 9))] + [f"u{k}"] * (k % 3 > 0) for k in range(150)}
    assert set(found_repeats(spark, [(k, " ".join(x)) for k, x in w.items()], 10, 5)) == brute_repeats(w, 10)
    # Of the passage's start some repeats lie within a task, and some span several.
    docs = spark.createDataFrame([(k, " ".join(x)) for k, x in w.items()], "doc_id long, text string").repartition(3)
    rows = repeats.maximal_repeats(docs, 10, 5).collect()
    spans = collections.Counter(x.last >> 40 != r.place >> 40 for r in rows for x in r.repeats if r.place >> 40 or x.last >> 40)
    assert spans[True] > 3 and spans[False] > 3


def test_words_that_are_alike_in_24_bits_stay_apart(spark):
    words_of = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    docs = [(1, f"{words_of('p', 60)} q1110 {words_of('z', 60)}"), (2, f"{words_of('p', 60)} q3631 {words_of('z', 60)}")]
    assert sorted(found_repeats(spark, docs, 50)) == [(((1, 0), (2, 0)), 60), (((1, 61), (2, 61)), 60)]


@pytest.mark.parametrize("least,n,seed", [(10, 30, 3), (14, 25, 5), (7, 20, 8)])
def test_maximal_repeats(spark, least, n, seed):
    docs = passages_in_noise(n, seed)
    docs += [(100, docs[0][1]), (101, docs[0][1])]
    w = {d: t.split() for d, t in docs}
    occurrences = collections.defaultdict(list)
    for d, x in w.items():
        for i in range(len(x) - least + 1):
            occurrences[tuple(x[i : i + least])].append((d, i))
    want = set()

    def grow(own, length):
        left = [w[d][i - 1] if i else None for d, i in own]
        after = collections.defaultdict(list)
        for d, i in own:
            after[w[d][i + length] if i + length < len(w[d]) else (d, i)].append((d, i))
        if len(own) > 1 and len(after) > 1 and (None in left or len(set(left)) > 1):
            want.add((tuple(sorted(own)), length))
        for x in after.values():
            if len(x) > 1:
                grow(x, length + 1)

    for own in occurrences.values():
        grow(own, least)
    got = found_repeats(spark, docs, least)
    assert want and set(got) == want and len(got) == len(want)


def test_runs_are_cut_to_their_ends(spark):
    unit = " ".join(f"u{i}" for i in range(14))
    docs = [(1, " ".join([unit] * 400)), (2, "x " + " ".join([unit] * 300) + " y z"), (3, "the " * 3000)]
    got = found_repeats(spark, docs, 8)
    assert max(n for own, n, *_ in got if {1, 2} <= {d for d, _ in own}) == 14 * 300
    assert (((3, 0), (3, 1)), 2999) in [x[:2] for x in got]
    found = repeats.maximal_repeats(spark.createDataFrame(docs, "doc_id long, text string"), 8)
    assert found.count() < 500


def brute_repeats(w: dict[int, list[str]], least: int) -> set:
    occurrences = collections.defaultdict(list)
    for d, x in w.items():
        for i in range(len(x) - least + 1):
            occurrences[tuple(x[i : i + least])].append((d, i))
    want, todo = set(), [(own, least) for own in occurrences.values()]
    while todo:
        own, length = todo.pop()
        left = [w[d][i - 1] if i else None for d, i in own]
        after = collections.defaultdict(list)
        for d, i in own:
            after[w[d][i + length] if i + length < len(w[d]) else (d, i)].append((d, i))
        if len(own) > 1 and len(after) > 1 and (None in left or len(set(left)) > 1):
            want.add((tuple(sorted(own)), length))
        todo += [(x, length + 1) for x in after.values() if len(x) > 1]
    return want


@pytest.mark.parametrize("size", [1, 3, 9, 20])
def test_runs_of_few_copies_are_whole(spark, size):
    rng = random.Random(size)
    name = iter(range(10**6))
    made = lambda n: [f"v{next(name)}" for _ in range(n)]
    x, y, z = made(size), made(25), made(12)
    docs = [made(5) + x * n + y[: rng.choice((3, 25))] + made(rng.randint(0, 4)) for n in range(3, 11)]
    docs += [x * 10 + y, z + x * 3 + y, z + x * 4 + x[: size // 2] + made(3), (x * 3 + y) * 4 + made(2), x * 4, x[size // 2 :] + x * 5 + y[:9]]
    docs += [x + y, z + x * 2 + y, (z + x * 6) * 3]
    w = dict(enumerate(docs))
    got = found_repeats(spark, [(d, " ".join(t)) for d, t in w.items()], 10)
    assert len(got) == len(set(got)) and set(got) == brute_repeats(w, 10)


def test_trees_of_one_anchor_leave_the_task_piece_by_piece(monkeypatch):
    """Neither all rows of an anchor nor all bodies of a batch are held at once, and copies of a passage are held once."""
    rng = random.Random(5)
    pack = zstandard.ZstdCompressor().compress
    left = ["".join(rng.choice("xy") + " " for _ in range(4)) for _ in range(300)]
    bodies = [x + " ".join(rng.choice("ab") for _ in range(6)) + " " + "c " * 3 for x in left]
    columns = [[7] * 300, range(300), [4] * 300, [[0b1111]] * 300, [0] * 300, [4] * 300, [pack(x.encode()) for x in bodies]]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["h", "doc_id", "pos", "masks", "period", "n_left", "body"])
    whole = [r for b in repeats._grouped(8)(iter([batch])) for r in b.to_pylist()]
    held = []
    monkeypatch.setattr(repeats, "trees", lambda h, own, least, f=repeats.trees: held.append(own) or f(h, own, least))
    monkeypatch.setattr(repeats, "LISTED", 200, raising=False)
    pieces = [b.to_pylist() for b in repeats._grouped(8)(iter([batch]))]
    assert len(whole) > 600 and [r for x in pieces for r in x] == whole
    assert max(map(len, pieces)) <= 500
    assert len({id(r.right) for r in held[0]}) == len({r.right for r in held[0]}) == 64
    assert [(lo, len(x)) for lo, x in repeats._unpacked(iter([b"ab", b"cd", b"efghi", b"", b"j"]), 3)] == [(0, 2), (2, 1), (3, 2)]


def test_jaccard_tasks_give_back_what_they_freed():
    """In a process of its own: after a task nothing is left that the allocators would let go of."""
    code = """
import ctypes, re
import numpy as np, pyarrow as pa
from marlspan.llm import jaccard

def held():
    return sum(map(int, re.findall(r"\\nAnonymous:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

words = np.random.default_rng(3).integers(0, 50_000, (3000, 300)).astype(str)
batch = pa.RecordBatch.from_pydict({"doc_id": range(3000), "text": [" ".join(x) for x in words]})
del words
for _ in jaccard._keyed(3, 40)(iter([batch])):
    pass
del _
after = held()
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
print(after - held())
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env=os.environ | {"OMP_NUM_THREADS": "1"})
    assert float(out.stdout) < 15


def test_jaccard_join(spark):
    rng = random.Random(1)
    base = [[rng.choice(VOCABULARY) for _ in range(80)] for _ in range(4)]
    docs = []
    for d in range(120):
        w = list(base[d % 4])
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(80)] = rng.choice(VOCABULARY)
        docs.append((d, " ".join(w)))
    docs += [(200 + d, docs[0][1]) for d in range(30)]
    sets = {d: {tuple(x[i : i + 3]) for i in range(len(x) - 2)} for d, x in ((d, t.split()) for d, t in docs)}
    want = {}
    for a in sets:
        for b in sets:
            if a < b:
                o = len(sets[a] & sets[b])
                if o / len(sets[a] | sets[b]) >= jaccard.THRESHOLD:
                    want[a, b] = o
    df = spark.createDataFrame(docs, "doc_id long, text string")
    least = {}
    for d, x in sorted(sets.items()):
        least.setdefault(frozenset(x), d)
    pairs = {(a, b): o for (a, b), o in want.items() if a in least.values() and b in least.values()}
    links = collections.Counter(x for pair in want for x in pair)
    for cell in (jaccard.CELL, 700):  # of the second, a block is many cells
        got = [(r.doc_id_a, r.doc_id_b, r.overlap) for r in jaccard.representative_pairs(df, cell=cell).collect()]
        assert len(got) == len(set(got)) and {(a, b): o for a, b, o in got} == pairs
        rows = jaccard.near_classes(df, cell=cell).collect()
        assert {r.doc_id: r.n_links for r in rows} == {d: links[d] for d in sets}
        groups = collections.defaultdict(set)
        for r in rows:
            groups[r.class_id].add(r.doc_id)
        assert sorted(map(len, groups.values())) == [30, 30, 30, 60] and all(c == min(g) for c, g in groups.items())


@pytest.mark.parametrize("most", [64, 3])
def test_jaccard_loses_no_pair_that_shares_no_band(spark, monkeypatch, most):
    # Of pairs at the threshold itself, in many sizes, one band finds few.
    monkeypatch.setattr(jaccard, "LIST", most)
    monkeypatch.setattr(jaccard, "COUNTED", 50)
    rng, name = random.Random(6), iter(range(10**6))
    docs = []
    for k in range(90):
        shared, x, y = ([f"u{next(name)}" for _ in range(m)] for m in (2 * (3 + k) + 2, 3 + k, 3 + k))
        cut = rng.randint(0, 3 + k)
        docs += [(3 * k, " ".join(x[:cut] + shared + x[cut:])), (3 * k + 1, " ".join(shared)), (3 * k + 2, " ".join(y + shared + ["the end of it"] * (k % 2)))]
    docs += [(900 + k, f"a common line of all {k % 7} {k} " + " ".join(f"z{k // 4}{i}" for i in range(5))) for k in range(60)] + [(990, "one"), (991, "one two"), (992, "one two three four"), (993, "one two three")]
    sets = {d: {tuple(x[i : i + 3]) for i in range(max(1, len(x) - 2))} for d, x in ((d, t.split()) for d, t in docs)}
    want = {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) * 1.5 >= 0.5 * (len(sets[a]) + len(sets[b]))}
    assert len(want) > 150
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = jaccard.representative_pairs(df, bands=1).collect()
    assert {(r.doc_id_a, r.doc_id_b): r.overlap for r in got} == want and len(got) == len(want)


def test_hot_band_keys_become_stars():
    docs = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array([f"a b c d e f g h {k % 3}" for k in range(400)])], names=["doc_id", "text"])
    got = pa.Table.from_batches(jaccard._keyed(3, 40)(iter([docs]))).to_pandas()
    assert (got.kind == jaccard.MEMBER).sum() == 400 and got[got.kind == jaccard.MEMBER].b.nunique() == 3
    keys = got[got.kind == jaccard.KEY]
    assert keys.a.is_unique and (got.kind == jaccard.EDGE).sum() <= 3
    # Keys of several slices meet at one centre, also where a batch ends within a run.
    rows = [pa.RecordBatch.from_arrays([pa.array([2, 2], pa.int8()), pa.array([7, 7]), pa.array(x), pa.array([0, 0], pa.int32())], names=["kind", "a", "b", "c"]) for x in ([1, 4], [5, 9])]
    assert [(r["a"], r["b"]) for b in jaccard._starred(iter(rows)) for r in b.to_pylist()] == [(4, 1), (5, 1), (9, 1)]


def test_tiled_product_equals_sets(monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 64)
    monkeypatch.setattr(jaccard, "COLUMNS", 150)
    rng = np.random.default_rng(1)
    base = [np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64)) for _ in range(4)]
    sets, block = [], []
    for k in range(300):
        b = base[k % 3 if k < 250 else 3].copy()
        m = rng.integers(0, 120)
        b[rng.choice(len(b), m, replace=False)] = rng.integers(0, 2**63, m, dtype=np.uint64)
        sets.append(np.unique(b[: rng.integers(60, len(b))]))
        block.append(0 if k < 280 else k // 5)
    i, j, c = jaccard.overlaps(sets, np.array(block), 0.5)
    own = [set(s.tolist()) for s in sets]
    want = {(a, b): len(own[a] & own[b]) for a in range(300) for b in range(a + 1, 300) if block[a] == block[b] and len(own[a] & own[b]) * 1.5 >= 0.5 * (len(own[a]) + len(own[b]))}
    assert dict(zip(zip(i.tolist(), j.tolist()), c.tolist())) == want


def edit_distance(item: str, text: str) -> int:
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        last, row[0] = row[0], 0
        for i in range(1, len(item) + 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (item[i - 1] != c))
        best = min(best, row[-1])
    return best


def test_decontamination(spark):
    rng = random.Random(2)
    items = [(k, " ".join(rng.choice(VOCABULARY) for _ in range(14))) for k in range(8)]
    docs = []
    for d in range(60):
        t = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 6)):
            p = rng.randrange(len(t))
            t[p : p + 1] = rng.choice(["", "w", "é", t[p] + "1"])
        docs.append((d, " ".join(rng.choice(VOCABULARY) for _ in range(20)) + " " + "".join(t).upper() + ", " + rng.choice(VOCABULARY)))
    want = {}
    for d, t in docs:
        for k, i in items:
            n = edit_distance(decontam.normal(i), decontam.normal(t))
            if n <= int(decontam.ERRORS * len(i)):
                want[d, k] = n
    got = {(r.doc_id, r.item_id): r.distance for r in decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert want and got == want
    assert decontam.distance("abcdef", "xxabdefxx", 3) == 1 and decontam.distance("abc", "zzz", 1) == 2


def test_items_match_whole_words_and_parts_are_searched_alike(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "smother brothers"), (2, "The end"), (3, "by the"), (4, "a, THE; b"), (5, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the"), (2, "other"), (3, ""), (None, "the"), (4, None), (5, "by\nTHE")], "item_id long, text string")
    want = [(2, 1, 0), (3, 1, 0), (3, 5, 0), (4, 1, 0)]
    for chars in (8_000_000, 3):
        monkeypatch.setattr(decontam, "PART_CHARS", chars)
        assert sorted(tuple(r) for r in decontam.matches(docs, items).collect()) == want
        assert sorted(r.doc_id for r in decontam.keep_clean(docs, items).collect()) == [1, 5]
    assert not decontam.matches(docs, items.limit(0)).collect() and decontam.keep_clean(docs, items.limit(0)).count() == 5


def test_private_data_held_out():
    model, thresholds = pii.trained()
    x, y, kinds = pii.examples(2000, 77)
    p = boosting.probability(model, x)
    chosen = p >= np.array(thresholds)[kinds]
    assert chosen[y > 0].mean() > 0.97 and y[chosen].mean() > 0.95
    text = 'Call +1 (743) 555-3824 or pay 4111111111111111, not 4111111111111112. token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" at 10.20.30.40; order 4785380592391138 in 2004.'
    [spans] = pii.selected([text], model, thresholds)
    assert pii.redact(text, spans) == 'Call [PHONE] or pay [CARD], not 4111111111111112. token = "[SECRET]" at [IP]; order 4785380592391138 in 2004.'


@pytest.mark.parametrize("size", [150, 201, 400, 1500, 5000])
def test_long_secrets_leave_nothing(size):
    rng = random.Random(size)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    for alphabet in (letters + "0123456789_-", letters + "0123456789"):
        secret = "".join(rng.choice(alphabet) for _ in range(size - 1)) + "x"
        texts = [f"words before token={secret} and after", f'the api_key: "{secret}".', f"sent eyJ{secret} along"]
        for text, spans in zip(texts, pii.selected(texts, *pii.trained())):
            assert not any(secret[i : i + 12] in pii.redact(text, spans) for i in range(size - 11)), text[:30]
    # Without a digit for long: the run is a candidate from its very beginning.
    run = "".join(rng.choice(letters) for _ in range(size)) + "1"
    assert (4, 4 + len(run), "SECRET") in pii.candidates(f"see {run} there")


def test_windows_hold_all_candidates_of_the_whole_text():
    rng = random.Random(9)
    parts = ["a", "b1", " ", " ", ".", "@", "-", "+", "(", "):", "4", "12", "2 ", "token=", "key ", "\"", "'", "fe80::", ":", "c3:", "x" * 30, "7" * 9, "\n", "é", " word " * 90]
    seen = collections.Counter()
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 120)))
        whole = pii.candidates(text, [(0, len(text))])
        assert pii.candidates(text) == whole
        assert not whole or re.search(pii.TRIGGER, text)
        seen.update(k for *_, k in whole)
    assert set(seen) >= {"EMAIL", "PHONE", "IP", "CARD", "SECRET"}


def test_selection_equals_its_definition():
    model, _ = pii.trained()
    thresholds = (0.001,) * len(pii.KINDS)  # so low that selections overlap
    rng = random.Random(2)
    texts = [" ".join(x for _ in range(rng.randint(0, 12)) for x in pii._made(rng, rng.choice(pii.KINDS))[:2]) for _ in range(60)] + ["", None]
    overlaps = 0
    for text, got in zip(texts, pii.selected(texts, model, thresholds)):
        left = {c: round(float(boosting.probability(model, np.array([pii.features(text, *c)]))[0]), 6) for c in (pii.candidates(text) if text else [])}
        left = {c: p for c, p in left.items() if p >= thresholds[pii.KINDS.index(c[2])]}
        want = []
        while left:
            # The most probable, of these the longest, of these the first.
            best = min(left, key=lambda c: (-left[c], c[0] - c[1], c))
            want.append((*best, left[best]))
            kept = {c: p for c, p in left.items() if c[1] <= best[0] or best[1] <= c[0]}
            overlaps += len(left) - len(kept) - 1
            left = kept
        assert got == sorted(want)
    assert overlaps > 10


def test_addresses_of_all_forms():
    model, thresholds = pii.trained()
    local, host = "anna.maria." * 30 + "x", "mail." * 60 + "org"
    text = f"to {local}@{host} and 2001:db8::8a2e:370:7334, fe80::1; from 2001:DB8:0:0:8:800:200C:417A at 12:30:45 on aa:bb:cc:dd:ee:ff"
    [spans] = pii.selected([text], model, thresholds)
    assert pii.redact(text, spans) == "to [EMAIL] and [IP], [IP]; from [IP] at 12:30:45 on aa:bb:cc:dd:ee:ff"
    # An unbroken text of a megabyte takes a moment, not a minute.
    assert pii.candidates("x" * 1_000_000 + "1") == [(0, 1_000_001, "SECRET")]


def test_language_id_held_out(spark):
    rng = random.Random(3)
    stems = {"en": "th er on an re he in ed nd ha at en es of or".split(), "fr": "eau ai que ou tion ment eux an ch ré pa vi le".split(), "de": "sch ung ein ich er keit heit ber zu ge ver und".split()}
    make = lambda lang, n: " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(k, make(lang, rng.choice((30, 200, 2000))), lang) for k, lang in enumerate(["en", "fr", "de"] * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    dicts = langid.train(df.where("doc_id < 90"))
    got = {r.doc_id: r.predicted for r in langid.language_id(df.where("doc_id >= 90"), dicts).collect()}
    right = sum(got[k] == lang for k, _, lang in rows if k >= 90)
    assert right >= 0.97 * len(got)
    assert langid.classify(b"zq " * 400, dicts)[0] is None
    # By definition: the sizes of fresh compressors, block by block; a tie or a narrow margin is a rejection.
    margins = {r.doc_id: (r.predicted, r.margin) for r in langid.language_id(df, dicts).collect()}
    for k, text, _ in rows[::7] + [(0, rows[0][1], "")]:
        raw, size = text.lower().encode(), {}
        for lang, own in dicts.items():
            p = zstandard.ZstdCompressionParameters.from_level(langid.ENCODER[0], source_size=langid.BLOCK, dict_size=len(own), min_match=langid.ENCODER[1], write_content_size=0, write_checksum=0, write_dict_id=0)
            d = zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            size[lang] = sum(len(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress(raw[i : i + langid.BLOCK])) for i in range(0, len(raw), langid.BLOCK))
        first, second = sorted(size.values())[:2]
        margin = (second - first) / len(raw)
        assert margins[k] == (min(size, key=size.get) if margin >= langid.NARROW else None, round(margin, 6))
    assert langid.classify(b"some text", {"aa": dicts["en"], "bb": dicts["en"]}) == (None, 0.0)
    assert langid.train(df.limit(0)) == {} and langid.classify(b"some text", {}) == (None, 0.0) and langid.classify(b"x y", {"aa": b"z" * 300}) == ("aa", 1.0)


def test_subset_sums_that_need_what_the_shares_would_take():
    length, count = np.array([7, 4_999_999, 5_000_000]), np.array([3, 2, 2])
    assert int((mixing.fit(length, count, 9_999_999) * length).sum()) == 9_999_999
    # Documents are given back where the first rest can't be filled: multiples of 10 and one 7.
    length, count = np.array([7, 10]), np.array([1, 500])
    assert int((mixing.fit(length, count, 3337) * length).sum()) == 3337
    assert int((mixing.fit(length, count, 3335) * length).sum()) == 3330
    rng = np.random.default_rng(5)
    for _ in range(40):
        length = np.unique(rng.integers(1, 60, rng.integers(1, 6)))
        count = rng.integers(0, 40, len(length))
        total = int((length * count).sum())
        budget = int(rng.integers(0, total + 3))
        sums = 1
        for n, c in zip(length.tolist(), count.tolist()):
            for _ in range(c):
                sums |= sums << n
        best = (sums & ((1 << budget + 1) - 1)).bit_length() - 1
        take = mixing.fit(length, count, budget)
        assert (take <= count).all() and (take >= 0).all() and int((take * length).sum()) == min(best, total)


def test_budgets_spread_what_small_sources_lack():
    assert mixing.budgets({"a": 100, "b": 10, "c": 1000}, {"a": 1, "b": 1, "c": 2}, 400) == {"a": 100, "b": 10, "c": 290}
    assert mixing.budgets({"a": 100, "b": 0}, {"b": 1}, 50) == {"a": 0, "b": 0}
    assert mixing.budgets({"a": 1, "b": 10**9}) == {"a": 1, "b": 700_000_000 - 1}
    assert mixing.budgets({}) == {}


def test_mixing_meets_the_budgets(spark):
    rng = random.Random(6)
    rows = [(k, " ".join("x" * rng.randint(1, 3) for _ in range(rng.randint(1, 40))), rng.choice("aaab")) for k in range(400)]
    rows += [(400, "\n".join("é ß  中\t" for _ in range(9)), "b"), (401, "", "b"), (402, None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    total = collections.Counter()
    for _, t, s in rows:
        total[s] += len((t or "").split())
    got = mixing.mix_sources(df, {"a": 0.25, "b": 0.75}, total["b"] // 2).collect()
    have = collections.Counter()
    for r in got:
        have[r.source] += r.tokens
        assert r.tokens == len(rows[r.doc_id][1].split())
    assert have == {"b": total["b"] // 2 * 3 // 4, "a": total["b"] // 2 // 4}
    # Of each length the documents of least hash are the selected ones.
    hashed = {r.doc_id: r.h for r in df.selectExpr("doc_id", f"xxhash64(doc_id, {mixing.SEED}) AS h").collect()}
    chosen = {r.doc_id for r in got}
    for r in got:
        alike = [k for k, t, s in rows if s == r.source and t and len(t.split()) == r.tokens]
        assert all(k in chosen or hashed[k] > hashed[r.doc_id] for k in alike)
    again = mixing.keep_mixed(df.repartition(7), {"a": 0.25, "b": 0.75}, total["b"] // 2).collect()
    assert {r.doc_id for r in again} == chosen and len(again) == len(got)


def test_mixing_takes_repeated_rows_one_by_one(spark):
    df = spark.createDataFrame([(1, "x y", "a")] * 7 + [(2, "x y", "b")] * 3 + [(None, "x y", None)] * 3, "doc_id long, text string, source string")
    for f in (mixing.keep_mixed, mixing.mix_sources):
        got = collections.Counter(r.source for r in f(df, {"a": 1, "b": 1, None: 2}, 12).collect())
        assert got == {"a": 1, "b": 1, None: 3}


def test_license_cosine_and_inheritance(spark):
    docs = [
        (1, "r/LICENSE", "Released under the MIT License."),
        (2, "r/a/x.txt", "some words"),
        (3, "r/a/b/COPYING", "x y\nLicensed under the Apache License, Version 2.0.\nmore"),
        (4, "r/a/b/c/d.txt", "nothing"),
        (5, "r/a/b/e.txt", "This work is licensed under the GNU General Public License, version 3."),
        (6, "q/f.txt", "nothing"),
        (7, None, "nothing"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin, r.from_dir) for r in licenses.license_scan(df).collect()}
    assert got == {
        1: ("MIT", "own", None),
        2: ("MIT", "inherited", "r"),
        3: ("Apache-2.0", "own", None),
        4: ("Apache-2.0", "inherited", "r/a/b"),
        5: ("GPL-3.0", "own", None),
        6: (None, None, None),
        7: (None, None, None),
    }
    n, df_terms = licenses.document_frequencies(df)
    assert n == 7 and df_terms["licensed"] == 2 and df_terms["apache", "license"] == 1
    # Cosine by definition.
    s = licenses.Scanner(n, df_terms)
    unit = "Licensed under the MIT licence, version 2 of things"
    weight = lambda t, f=0: (math.log((1 + n) / (1 + df_terms.get(t, f))) + 1) * (3 if re.search(r"\d", "".join(t)) else 1)
    v = {t: c * (weight(t) if t in df_terms or isinstance(t, str) else 0) for t, c in licenses.terms(unit).items()}
    for (_, text), got in zip(licenses.TEMPLATES, s.cosines(unit)):
        u = {t: c * weight(t) for t, c in licenses.terms(text).items()}
        assert got == pytest.approx(sum(v.get(t, 0) * x for t, x in u.items()) / math.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in u.values())), abs=1e-6)


BSD = dict(licenses.TEMPLATES[licenses.FIRST_FULL :])["BSD-2-Clause"]


@pytest.mark.parametrize(
    "text,license",
    [
        (f"Copyright 2020 Someone. All rights reserved.\n\n{BSD}", "BSD-2-Clause"),
        ("All rights reserved.", "Proprietary"),
        ("All rights reserved.\nLicensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("some words\nLicensed under the Boost Software License, Version 1.0.\nmore words", "BSL-1.0"),
        ("Licensed under the Apache License, Version 1.1", "Apache-1.1"),
        ("Licensed under the Apache License, Version 7.4", None),
        ("Licensed under the Mozilla Public License, Version 2.0", "MPL-2.0"),
        *[(f"# a file\n{text}\nint main", name) for name, text in licenses.TEMPLATES[licenses.FIRST_FULL :]],
        *[(text, name) for name, text in licenses.TEMPLATES[licenses.FIRST_FULL :]],
    ],
)
def test_licenses_of_texts(text, license):
    n = 1000
    scanner = licenses.Scanner(n, {t: 5 for t in licenses.vocabulary()})
    index = licenses.Index(scanner.vocab)
    docs = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([text.lower()])], names=["key", "text"])
    units = [u for b in licenses._units(scanner, index)(iter([docs])) for u in b.column("unit").to_pylist()]
    best = min((x for x in (scanner.best(u) for u in units) if x[2]), key=lambda x: (x[0], -x[1], x[2]), default=(False, 0, None))
    assert best[2] == license


def test_bound_drops_no_unit(spark):
    rng = random.Random(3)
    names = [t for _, t in licenses.TEMPLATES[: licenses.FIRST_FULL]]
    rows = []
    for k in range(150):
        lines = [" ".join(rng.choice(VOCABULARY[:40]) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 5))]
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(names).split()
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(["the", "w3", "of", "2", "license"])
            i = rng.randint(1, len(t))
            lines.insert(rng.randint(0, len(lines)), " ".join(t[:i]) + rng.choice(["\n", " "]) + " ".join(t[i:]))
        rows.append((k, None, "\n".join(lines) if k % 50 else None))
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.score) for r in licenses.own_licenses(df).collect()}
    scanner = licenses.Scanner(*licenses.document_frequencies(df))
    count = collections.Counter(w for _, _, t in rows for w in set(re.findall(WORD, (t or "").lower())))
    known = {w for w in scanner.vocab if isinstance(w, str)}
    assert len(got) == len(rows) and sum(x is not None for x, _ in got.values()) > 40
    for k, _, t in rows:
        lines = (t or "").lower().split("\n")
        units, start = {*lines, t or ""}, 0
        mostly = [sum(w in known for w in re.findall(WORD, x)) >= 0.7 * len(re.findall(WORD, x)) for x in lines]
        for i in range(len(lines) + 1):
            if i == len(lines) or not mostly[i]:
                if i - start > 1:
                    units.add("\n".join(lines[start:i]))
                start = i + 1
        found = [x for x in (scanner.best(u, count) for u in units) if x[2]]
        last, score, name = min(found, key=lambda x: (x[0], -x[1], x[2]), default=(False, None, None))
        assert got[k] == (name, score), t


def test_ties_of_licenses_and_licence_files(spark):
    two = (("B", "alpha beta gamma"), ("A", "alpha beta gamma"))
    df = spark.createDataFrame([(1, "d/LICENSE", "alpha beta gamma"), (2, "d/COPYING", "Alpha beta gamma"), (3, "d/x", "no"), (4, "e/x", "")], "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.score, r.origin, r.from_dir) for r in licenses.license_scan(df, 0.5, two).collect()}
    assert got == {1: ("A", 1.0, "own", None), 2: ("A", 1.0, "own", None), 3: ("A", 1.0, "inherited", "d"), 4: (None, None, None, None)}


@pytest.mark.parametrize("n", [60, 6000])
def test_license_with_common_words_holds_as_the_corpus_grows(spark, n):
    line = "Our widget engine is released under the MIT License."
    common = [(i, None, "our engine and any widget is good") for i in range(2, n + 2)]
    common += [(n + i, None, "released under the MIT license") for i in range(2, n // 20 + 2)]
    df = spark.createDataFrame([(1, None, line), *common], "doc_id long, path string, text string")
    [got] = licenses.own_licenses(df).where("doc_id = 1").collect()
    scanner = licenses.Scanner(*licenses.document_frequencies(df))
    others = {w: sum(w in t.lower().strip(".").split() for _, _, t in [(1, None, line), *common]) for w in ("our", "widget", "engine", "is")}
    assert got.license == "MIT" and got.score == scanner.best(line, others)[1] > licenses.THRESHOLD


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_token_counts_equal_the_tokenizer(name, monkeypatch):
    path = public_tokenizers.path(name)
    rank = tokens.ranks(path)
    counter = tokens.Counter(rank, tokens.splits(rank))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=rank, special_tokens={})
    alphabet = "abc thequickésß'sreldv019  \n\t!?.,'\"…中文字🙂　 -_"
    texts = ["".join(RNG.choice(alphabet) for _ in range(RNG.randint(0, 1500))) for _ in range(120)]
    texts += ["", "'", "don't we've 're 'rx 'll 'lx", "a  b\n\n c   ", "  ", "\n \n", " 's", "x's!'s", "The The " * 300, "a" * 4000, "".join(RNG.choice("abcdefgh") for _ in range(20_000)), "<|endoftext|>"]
    monkeypatch.setattr(tokens, "STATES", 3000)
    got = np.concatenate([counter.texts(*b) for b in tokens.batches(pa.array(texts))])
    assert got.tolist() == [len(known.encode_ordinary(t)) for t in texts]


def test_prefix_scan_composes_maps():
    rng = np.random.default_rng(3)
    maps = rng.integers(0, 9, (50, 9)).astype(np.int32)
    fresh = rng.random(50) < 0.2
    fresh[0] = True
    want, state = [], 0
    for i in range(50):
        state = 0 if fresh[i] else state
        want.append(state)
        state = maps[i, state]
    assert tokens.compose(maps, fresh).tolist() == want


def greedy_phrases(text: bytes, reference: list[bytes]) -> int:
    i = c = 0
    while i < len(text):
        n = 1
        while i + n <= len(text) and any(text[i : i + n] in r for r in reference):
            n += 1
        i, c = i + max(1, n - 1), c + 1
    return c


@pytest.mark.parametrize("few,far", [(0, 64), (2, 8), (50, 8), (50, 64)])
def test_cross_parsing_equals_greedy_search(monkeypatch, few, far):
    monkeypatch.setattr(lmscore, "FEW", few)
    monkeypatch.setattr(lmscore, "FAR", far)
    rng = random.Random(1)
    for k in range(15):
        letters = b"ab" if k % 3 == 0 else b"abcd \x00\xc3"
        parts = sorted({bytes(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(rng.randint(0, 6))})
        texts = [bytes(rng.choice(letters + b"e") for _ in range(rng.randint(0, 700))) for _ in range(6)] + parts[:2] + [b"".join(parts), b"ab" * 300]
        reference = lmscore.Reference(parts).prepared()
        whole = reference.data.tobytes()
        assert reference.order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
        off = np.cumsum([0] + [len(t) for t in texts])
        got = reference.phrases(off, np.frombuffer(b"".join(texts), dtype=np.uint8))
        assert got.tolist() == [greedy_phrases(t, [x for x in parts if x != t]) for t in texts]
    assert lmscore.own_phrases(b"aababcab") == 4 and lmscore.own_phrases(b"") == 0


def cross_fixture(spark):
    rng = random.Random(8)
    make = lambda stems: " ".join("".join(rng.choice(stems) for _ in range(3)) for _ in range(120))
    rows = [(k, make(["th", "er", "on", "an"]) if k % 4 else make(["xq", "zk", "vw", "jy"])) for k in range(80)]
    rows += [(80, rows[5][1]), (81, rows[8][1]), (None, rows[8][1]), (82, "alone"), (82, "alone"), (None, "neither"), (83, None), (84, "")]
    labels = [(k, 1, 0) for k in range(80) if k % 4] + [(5, 1, None), (9, 1, 1), (13, 0, 0), (None, 1, 0), (82, None, 0)]
    return rows, labels, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_cross_scores_by_definition(spark):
    rows, labels, docs, table = cross_fixture(spark)
    good = {k for k, q, _ in labels if q == 1} - {k for k, _, t in labels if t} - {None}
    texts = {t.encode() for k, t in rows if k in good}
    got = lmscore.cross_parse(docs, table, rate=1e9).collect()
    assert len(got) == len(rows)
    by_text = dict(zip([(r.doc_id, r.n_bytes) for r in got], got))
    for k, t in rows:
        r = by_text[k, len(t or "")]
        if not t:
            assert r.phrases == 0 and r.cross_entropy is None and r.relative_entropy is None
            continue
        others = [x for x in texts if x != t.encode()]
        copied = len({d if d is not None else ("none", n) for n, (d, x) in enumerate(rows) if x == t}) > 1
        c = 1 if copied else greedy_phrases(t.encode(), others)
        m = sum(map(len, others))
        s = lmscore.own_phrases(t.encode())
        assert (r.copied, r.phrases, r.own_phrases, r.reference_bytes) == (copied, c, s, m)
        assert r.cross_entropy == pytest.approx(c * math.log2(m) / len(t), abs=1e-6)
        assert r.relative_entropy == pytest.approx((c * math.log2(m) - s * math.log2(s)) / len(t), abs=1e-6)


@pytest.mark.parametrize("part", [lmscore.PART, 700])
def test_reference_holds_all_good_texts_in_order(spark, part):
    rng = random.Random(3)
    passage = "".join(rng.choice("abc \x00é") for _ in range(900))
    texts = [passage[rng.randrange(300) :] + str(k) + "ab" * rng.randint(0, 90) for k in range(12)] + ["ab" * 700, "a" * 500, "x"]
    docs = spark.createDataFrame([*enumerate(texts), (50, "ab" * 700), (51, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, 0) for k in [*range(15), 50, 51]], "doc_id long, quality int, toxic int")
    reference = lmscore.Mapped(lmscore.reference_of(docs, labels, part=part))
    whole = reference.data.tobytes()
    assert sorted(whole[:-1].split(b"\xff")) == sorted({t.encode() for t in texts})
    assert reference.order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
    assert reference.rank[reference.order].tolist() == list(range(len(whole)))
    assert [t for t in texts if reference.find(t.encode()) is None] == [] and reference.find(b"y") is None


def test_scores_are_of_all_good_text(spark):
    # Of more good text than a part of it would hold, no phrase is missed.
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(4000)) for _ in range(100)]
    docs = spark.createDataFrame([*enumerate(texts), (100, "".join(t[500:600] for t in texts))], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(100)], "doc_id long, quality int, toxic int")
    r = next(r for r in lmscore.cross_parse(docs, labels).collect() if r.doc_id == 100)
    assert r.reference_bytes == 400_000 and r.phrases == greedy_phrases(("".join(t[500:600] for t in texts)).encode(), [t.encode() for t in texts])


def test_cross_parse_scores_equal_texts_alike_and_prefers_like_text(spark):
    rows, _, docs, table = cross_fixture(spark)
    for rate in (lmscore.RATE, 100):
        got = lmscore.cross_parse(docs.repartition(5), table, rate=rate).collect()
        score = collections.defaultdict(set)
        for r in got:
            score[dict(rows)[r.doc_id] if r.doc_id is not None else r.n_bytes].add((r.phrases, r.cross_entropy))
        assert all(len(x) == 1 for x in score.values())
        own = {r.doc_id: r for r in got if r.doc_id is not None and not r.copied and r.doc_id < 80}
        assert max(r.relative_entropy for k, r in own.items() if k % 4) < min(r.relative_entropy for k, r in own.items() if k % 4 == 0)
    none = lmscore.cross_parse(docs, table.limit(0)).collect()
    assert {r.phrases for r in none if not r.copied} == {r.n_bytes for r in none if not r.copied}


def upscaled(image, h, w):
    a, b, _ = image.shape
    return np.repeat(np.repeat(image.astype(float), h, 0), w, 1).reshape(h, a, w, b, -1).mean((1, 3))


def test_media_formats_and_tiles():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (21, 34, 3), dtype=np.uint8)
    g, body = a[:, :, :1], a.tobytes()
    bits = (g[:, :, 0] > 127).astype(np.uint8)
    black = ((1 - bits) * 255)[:, :, None]
    assert (media.decode(b"P6\n# c\n34 21\n255\n" + body) == a).all()
    assert (media.decode(b"P3 34 21 255\n" + " ".join(map(str, a.ravel())).encode()) == a).all()
    assert (media.decode(b"P5 34 21 255\n" + g.tobytes()) == g).all()
    assert (media.decode(b"P5 34 21 65535\n" + (g.astype(">u2") * 257).tobytes()) == g).all()
    assert (media.decode(b"P4 34 21\n" + np.packbits(bits, axis=1).tobytes()) == black).all()
    assert (media.decode(b"P1 34 21\n" + "".join(map(str, bits.ravel())).encode()) == black).all()
    assert (media.decode(b"P7\nWIDTH 34\nHEIGHT 21\nDEPTH 3\nMAXVAL 255\nENDHDR\n" + body) == a).all()

    def bmp(bits, rows, palette=b"", method=0, down=False):
        at = 54 + len(palette)
        data = b"".join(rows)
        head = [(40, 4), (34, 4), ((-21 if down else 21) & 0xFFFFFFFF, 4), (1, 2), (bits, 2), (method, 4), (len(data), 4), (0, 4), (0, 4), (0, 4), (0, 4)]
        return b"BM" + bytes(8) + at.to_bytes(4, "little") + b"".join(v.to_bytes(n, "little") for v, n in head) + palette + data

    pad = lambda r: r + bytes(-len(r) % 4)
    grey = b"".join(bytes((i, i, i, 0)) for i in range(256))
    assert (media.decode(bmp(24, [pad(r[:, ::-1].tobytes()) for r in a[::-1]])) == a).all()
    assert (media.decode(bmp(24, [pad(r[:, ::-1].tobytes()) for r in a], down=True)) == a).all()
    assert (media.decode(bmp(8, [pad(r.tobytes()) for r in g[::-1, :, 0]], grey)) == np.repeat(g, 3, 2)).all()
    runs = [b"".join(bytes((1, v)) for v in r.tolist()) + b"\0\0" for r in g[::-1, :, 0]] + [b"\0\1"]
    assert (media.decode(bmp(8, runs, grey, 1)) == np.repeat(g, 3, 2)).all()
    for h, w in ((32, 32), (8, 9), (5, 50)):
        assert np.allclose(media.area_resize(a, h, w), upscaled(a, h, w))
    buffer = io.BytesIO()
    np.save(buffer, a)
    assert media.npy(a) == buffer.getvalue()
    small = upscaled((a @ np.array([0.299, 0.587, 0.114]))[:, :, None], 8, 9)[:, :, 0]
    want = int("".join("01"[int(x)] for x in ((small[:, 1:] - small[:, :-1]) > 1e-3).ravel()), 2)
    assert media.difference_hash(a) & (2**64 - 1) == want
    for bad in (b"", b"P6", b"P6 5 5 255\n", b"BM", b"xx", b"P9 1", b"P5 0 3 255\n", b"P2 2 2 255 1 2 x 4", b"P7\nWIDTH 3\n", b"P5 99999 99999 255\n", bmp(24, [b"xx"]), None):
        [row] = media.tiles(bad, 32, 16)
        assert row[0] and row[1:] == (None,) * 8


def test_large_images_and_equal_neighbours(monkeypatch):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (90, 70, 3), dtype=np.uint8)
    whole = [media.area_resize(a, h, w) for h, w in ((32, 32), (8, 9), (100, 5))]
    monkeypatch.setattr(media, "BAND", 1)
    for got, (h, w) in zip(whole, ((32, 32), (8, 9), (100, 5))):
        assert np.allclose(media.area_resize(a, h, w), got) and np.allclose(got, upscaled(a, h, w))
    monkeypatch.undo()
    big = np.repeat(np.repeat(a, 60, 0), 60, 1)  # 68 million samples
    got = {row[5:7]: np.load(io.BytesIO(row[8])) for row in media.tiles(b"P6 4200 5400 255\n" + big.tobytes(), 32, 16)}
    want = np.rint(media.area_resize(a, 32, 32)).astype(np.uint8)
    assert set(got) == {(0, 0), (0, 1), (1, 0), (1, 1)} and all((got[y, x] == want[16 * y : 16 * y + 16, 16 * x : 16 * x + 16]).all() for y, x in got)
    assert media.difference_hash(np.full((40, 40, 1), 77, dtype=np.uint8)) == 0
    # A header that announces more than its bytes can hold costs nothing.
    for bad in (b"P1 99999999 99999999\n1", b"P3 99999999 99999999 255\n1", b"P4 99999999 99999999\n1"):
        [row] = media.tiles(bad, 32, 16)
        assert row[0] == "truncated"


def test_npy_files_are_written(spark, tmp_path):
    df = spark.createDataFrame([(1, b"P5 2 2 255\n\x00\x40\x80\xff"), (2, b"bad")], "doc_id long, payload binary")
    found = media.media_tiles(df)
    paths = {r.path for r in media.write_npy(found, str(tmp_path)).collect()}
    assert len(paths) == 4
    assert np.load(f"{tmp_path}/1/0_0.npy").tolist() == np.zeros((16, 16, 1)).tolist()
    assert np.load(f"{tmp_path}/1/1_1.npy").tolist() == np.full((16, 16, 1), 255).tolist()


def test_ranks_of_the_reference_wait_until_places_are_gone(spark, monkeypatch):
    """The two take the same disk."""
    blocks, removed = [], lmscore._removed

    def seen(folder, *kinds):
        if "places-" in kinds:
            blocks.append(os.stat(f"{folder}/rank").st_blocks)
        removed(folder, *kinds)

    monkeypatch.setattr(lmscore, "_removed", seen)
    rng = random.Random(8)
    texts = [" ".join(rng.choices(VOCABULARY[:40], k=60)) + " the same end of many texts, which is longer than sixty-four bytes are" * (i % 3) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = lmscore.reference_of(docs, spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int"), part=20_000)
    assert blocks == [0]
    found = lmscore.Mapped(folder)
    whole = bytes(found.data)
    assert found.order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
    assert found.rank[found.order].tolist() == list(range(len(whole)))


@pytest.mark.parametrize("part, piece", [(300, 5), (2000, 40)])
def test_the_reference_on_disk_gives_greedy_phrases(spark, monkeypatch, part, piece):
    """Ranges in several rounds, runs of one text across them, repeats of more than 64 bytes and copies; texts parsed in pieces."""
    monkeypatch.setattr(lmscore, "PIECE", piece)
    monkeypatch.setattr(lmscore, "BUSY", 2)
    monkeypatch.setattr(lmscore, "FEW", 2)
    rng = random.Random(part)
    passage = "".join(rng.choice("abc \x00é") for _ in range(300))
    texts = [passage[rng.randrange(200) :][: rng.randint(1, 200)] + str(k) + "ab" * rng.choice([0, 0, 3, 60]) for k in range(12)]
    texts += ["ab" * 200, "a" * 300, "a" * 90 + "c", "x", "q" * 150, "abc" * 50, "\x00" * 80, passage, "\x00"]
    other = [passage[20:150] + "z" + passage[100:], "a" * 120, "b" * 50 + "q" * 70, "yy", "".join(rng.choice("abc ") for _ in range(700)), "ab" * 120 + passage]
    docs = spark.createDataFrame([*enumerate(texts), *((k + 50, t) for k, t in enumerate(texts[:5] + other))], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, 1, 0) for k in [*range(len(texts)), *range(50, 55)]], "doc_id long, quality int, toxic int")
    folder = lmscore.reference_of(docs, labels, part=part)
    reference = lmscore.Mapped(folder)
    whole = reference.data.tobytes()
    assert sorted(whole[:-1].split(b"\xff")) == sorted({t.encode() for t in texts})
    assert reference.order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
    off, data = lmscore.buffers(pa.array(texts + other))
    good = [t.encode() for t in texts]
    expected = [greedy_phrases(t.encode(), [x for x in good if x != t.encode()]) for t in texts + other]
    assert reference.phrases(off, data).tolist() == expected
    # A byte for each place beside the order's four, and ranks of what is alike in 64 bytes only.
    n = len(whole)
    assert os.path.getsize(f"{folder}/near") == n and os.path.getsize(f"{folder}/rank") < 4 * n
    assert not [x for x in os.listdir(folder) if x.startswith(("places-", "tied-", "heads-", "ranks-", "part-"))]


def test_copies_are_not_parsed(spark, monkeypatch):
    class Told:
        def phrases(self, off, data):
            self.seen = data.tobytes()
            return np.full(len(off) - 1, 7)

    told = Told()
    assert lmscore.phrases_of(told, pa.array(["ab", "cd", "", "ef"]), pa.array([True, False, False, True])).tolist() == [1, 7, 7, 1] and told.seen == b"cd"
    assert lmscore.phrases_of(lmscore.Reference([b"abc"]).prepared(), pa.array(["ab"]), pa.array([True])).tolist() == [1]
    # Told before or after the parse, scores are the same.
    docs = spark.createDataFrame([(1, "twice the same"), (2, "twice the same"), (3, "once only"), (4, None), (3, "once only")], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    scores = []
    for small in (True, False):
        monkeypatch.setattr(lmscore, "broadcastable", lambda *_, small=small: small)
        scores.append(sorted(map(tuple, lmscore.cross_parse(docs, labels).collect())))
    assert scores[0] == scores[1] and [r[3:5] for r in scores[0]] == [(True, 1), (True, 1), (False, 9), (False, 9), (False, 0)]


def test_own_phrases_of_short_and_long_texts():
    rng = random.Random(4)
    for n in (0, 1, 2, 50, 3000):
        t = bytes(rng.choices(b"abc \xc3", k=n))
        assert lmscore.own_phrases(t) == lmscore._long_own_phrases(t)
