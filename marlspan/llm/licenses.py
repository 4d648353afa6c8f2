"""Licence scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

Terms are the words and word pairs of the templates, and the other words of what is compared with them.
Their document frequencies are counted over all documents and whole texts; a term with a number weighs
NUMBERS times as much, so that versions tell. Templates are headers (TEMPLATES) and the full texts in
the folder license_texts. Of a document three kinds of unit are compared with every template: each line,
each run of lines that are mostly template words, and the whole text. Of all units those go on whose
cosine may reach the threshold if each word outside the templates weighed the least that a word can:
that bound drops nothing, and few units pass it. Equal units are then scored once, with the frequencies
of all their words. A document's own licence is that of the best cosine, of THRESHOLD at least, or
FULL_THRESHOLD for a full text; those of LAST_RESORT count only where no other does. A file named as
licence file gives its licence to its directory; a document without one of its own inherits from the
nearest ancestor directory that has one, found by joining the ancestors of its path.

Cases: a null or empty text has no licence of its own, but may inherit; equal cosines fall to the
first template by name; of several licence files in a directory the best, then the least path, counts;
a null path neither gives nor inherits; paths without a directory lie in the root, ""; very long texts
are compared whole; repeated rows each get their row; empty tables give none. Only doc_id, path and
text are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspan.llm.words import WORD, Words, slices, words
from marlspan.shared import cut, sized_join

THRESHOLD, FULL_THRESHOLD = 0.6, 0.8
#: Weight of a term with a number, beside that of another.
NUMBERS = 3.0
#: Part of a line's words that must be template words for it to belong to a run.
MOSTLY = 0.7
LAST_RESORT = ("Proprietary",)
FILE = r"(?i)(^|/)(licen[sc]e|copying|copyright|notice|unlicense)[^/]*$"

TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software. The software is provided "as is", without warranty of any kind.'),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("BSL-1.0", "Licensed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("MPL-1.1", "Licensed under the Mozilla Public License, Version 1.1."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("ISC", "Licensed under the ISC License."),
    ("Zlib", "Licensed under the zlib License."),
    ("Proprietary", "Copyright. All rights reserved."),
)

_FULL = {p.stem: p.read_text() for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
_NAMES = sorted({name for name, _ in TEMPLATES} | set(_FULL))
TEMPLATES += tuple((name, f"SPDX-License-Identifier: {name}") for name in _NAMES if name not in LAST_RESORT)
#: Names with their templates; those from FIRST_FULL on are full texts.
FIRST_FULL = len(TEMPLATES)
TEMPLATES += tuple(_FULL.items())

_WORD = re.compile(WORD)


def terms(text: str) -> Counter:
    """Words and pairs of neighbouring words, counted."""
    w = _WORD.findall(text.lower())
    return Counter(w) + Counter(zip(w, w[1:]))


def vocabulary(templates=TEMPLATES) -> list:
    """The templates' terms, words first."""
    found = {t for _, text in templates for t in terms(text)}
    return sorted(t for t in found if isinstance(t, str)) + sorted(t for t in found if not isinstance(t, str))


class Index:
    """Finds the vocabulary's terms in words."""

    def __init__(self, vocab: list) -> None:
        single = [t for t in vocab if isinstance(t, str)]
        own = words(pa.array(single)).hash
        self.by = np.argsort(own)
        self.own, self.n = own[self.by], len(single)
        code = {t: i for i, t in enumerate(single)}
        pair = np.array([code[a] * len(single) + code[b] for a, b in vocab[len(single) :]], dtype=np.int64)
        self.pair_by = np.argsort(pair)
        self.pair = pair[self.pair_by]

    def hits(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms, the word that each begins at, and whether each word is a template word. Pairs lie in one row."""
        if not len(w.hash) or not self.n:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(len(w.hash), dtype=bool)
        at = np.minimum(np.searchsorted(self.own, w.hash), self.n - 1)
        known = self.own[at] == w.hash
        hit = np.flatnonzero(known)
        k = self.by[at[hit]]
        both = np.flatnonzero((np.diff(hit) == 1) & (w.doc[hit[:-1]] == w.doc[hit[1:]]))
        two = k[both] * self.n + k[both + 1]
        p = np.minimum(np.searchsorted(self.pair, two), max(0, len(self.pair) - 1))
        real = self.pair[p] == two if len(self.pair) else np.zeros(0, dtype=bool)
        return np.r_[k, self.n + self.pair_by[p[real]]], np.r_[hit, hit[both[real]]], known


def document_frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[int, dict]:
    """Documents, and how many of them hold each template term, over all documents and whole texts."""
    vocab = vocabulary(templates)
    index = Index(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocab), dtype=np.int64)
        n = 0
        for b in slices(batches):
            n += b.num_rows
            w = words(b.column("text"))
            term, at, _ = index.hits(w)
            df += np.bincount(np.unique(w.doc[at] * len(df) + term) % len(df), minlength=len(df))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.arange(len(df)), -1].astype(np.int32)), pa.array(np.r_[df, n])], names=["term", "df"])

    got = dict(docs.select(F.lower("text").alias("text")).mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df")).collect())
    return got.get(-1, 0), {t: got.get(i, 0) for i, t in enumerate(vocab)}


def _number(term) -> bool:
    return any(c.isdigit() for x in ((term,) if isinstance(term, str) else term) for c in x)


class Scanner:
    """Template vectors of unit length, weighted by the corpus' frequencies."""

    def __init__(self, n: int, df: dict, templates=TEMPLATES, threshold: float = THRESHOLD, full: int | None = None) -> None:
        self.n, self.vocab = n, list(df)
        self.idf = {t: self.weighed(t, f) for t, f in df.items()}
        self.code = {t: i for i, t in enumerate(self.vocab)}
        self.weights = np.array([self.idf[t] for t in self.vocab])
        self.names = [name for name, _ in templates]
        #: A vector a template, and the cosine that it asks for.
        self.vectors = np.zeros((len(self.vocab), len(templates)))
        full = FIRST_FULL if full is None and templates is TEMPLATES else len(templates) if full is None else full
        self.asked = np.array([threshold if i < full else max(threshold, FULL_THRESHOLD) for i in range(len(templates))])
        for i, (_, text) in enumerate(templates):
            for t, c in terms(text).items():
                self.vectors[self.code[t], i] = c * self.idf[t]
        self.vectors /= np.maximum(np.sqrt((self.vectors**2).sum(0)), 1e-12)
        #: Names in the order in which equal cosines fall, those of the last resort after all others.
        self.order = sorted(range(len(self.names)), key=lambda i: (self.names[i] in LAST_RESORT, self.names[i]))

    def weighed(self, term, df: int) -> float:
        return (math.log((1 + self.n) / (1 + df)) + 1) * (NUMBERS if _number(term) else 1.0)

    def cosines(self, text: str, others: dict[str, int] = {}) -> np.ndarray:  # noqa: B006
        """Cosine to each template; words outside the templates count in the length, pairs outside weigh nothing.

        others: documents that hold such a word; those that it lacks are in none.
        """
        dot, z = np.zeros(len(self.names)), 0.0
        for t, c in terms(text).items():
            i = self.code.get(t)
            if i is not None:
                x = c * self.idf[t]
                dot += x * self.vectors[i]
            else:
                x = c * self.weighed(t, others.get(t, 0)) if isinstance(t, str) else 0.0
            z += x * x
        return np.round(dot / math.sqrt(z), 6) if z else dot

    def best(self, text: str, others: dict[str, int] = {}) -> tuple[bool, float, str | None]:  # noqa: B006
        """Whether it is of the last resort, largest cosine, and its template's name; None where no template gets what it asks for."""
        c = self.cosines(text, others)
        ok = [i for i in self.order if c[i] >= self.asked[i]]
        if not ok:
            return False, 0.0, None
        i = min(ok, key=lambda i: (self.names[i] in LAST_RESORT, -c[i]))
        return self.names[i] in LAST_RESORT, float(c[i]), self.names[i]

    def possible(self, unit: np.ndarray, term: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The units that may reach what a template asks for. unit, term: of each hit; other: of each unit its words outside the templates.

        Such a word weighs 1 at least, and as often as it occurs at least.
        """
        if not len(unit):
            return np.zeros(0, dtype=np.int64)
        t = len(self.vocab)
        code, tf = np.unique(unit * t + term, return_counts=True)
        u, k = code // t, code % t
        x = tf * self.weights[k]
        own, start = np.unique(u, return_index=True)
        z = np.add.reduceat(x * x, start) + other[own]
        found = np.zeros(len(own), dtype=bool)
        step = 200_000
        edge = start.tolist() + [len(u)]
        lo = 0
        while lo < len(own):
            hi = lo + 1
            while hi < len(own) and edge[hi + 1] - edge[lo] <= step:
                hi += 1
            part = slice(edge[lo], edge[hi])
            dot = np.add.reduceat(x[part, None] * self.vectors[k[part]], start[lo:hi] - edge[lo], axis=0)
            found[lo:hi] = (dot >= self.asked[None, :] * np.sqrt(z[lo:hi])[:, None] - 1e-6).any(1)
            lo = hi
        return own[found]


def _lines(w: Words, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Line of each word, and where the lines begin and end and the row that each is of; empty lines are lines."""
    n = len(w.data)
    cuts = np.flatnonzero(w.data == 10)
    begin = np.unique(np.r_[off[:-1][np.diff(off) > 0], cuts[cuts + 1 < n] + 1])
    row = np.searchsorted(off, begin, side="right") - 1
    end = np.r_[begin[1:], n]
    return np.searchsorted(begin, w.start, side="right") - 1, begin, end, row


def _units(scanner: Scanner, index: Index):
    """(key, unit) of each row: lines, runs and whole texts that may have a licence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from marlspan.llm.words import buffers

        for b in slices(batches):
            w = words(b.column("text"))
            off, _ = buffers(b.column("text"))
            term, at, known = index.hits(w)
            line, begin, end, row = _lines(w, off)
            spans: set[tuple[int, int, int]] = set()

            def keep(unit: np.ndarray, lo: np.ndarray, hi: np.ndarray, of: np.ndarray) -> None:
                """unit: of each word, -1 for none; lo, hi, of: the units' bytes and rows."""
                u = unit[at]
                other = np.bincount(unit[~known & (unit >= 0)], minlength=len(lo))
                for x in scanner.possible(u[u >= 0], term[u >= 0], other).tolist():
                    spans.add((int(of[x]), int(lo[x]), int(hi[x])))

            if len(w.hash):
                keep(line, begin, end, row)
                keep(w.doc, off[:-1], off[1:], np.arange(len(off) - 1))
                # Runs: neighbouring lines of one row that are mostly template words, or have no word.
                count = np.bincount(line, minlength=len(begin))
                mostly = np.bincount(line[known], minlength=len(begin)) >= MOSTLY * count
                joins = np.r_[False, mostly[1:] & mostly[:-1] & (row[1:] == row[:-1])]
                of_line = np.cumsum(~joins) - 1
                first = np.flatnonzero(~joins)
                last = np.r_[first[1:], len(begin)] - 1
                several = (last > first) & mostly[first]
                keep(np.where(several[of_line[line]], of_line[line], -1), begin[first], end[last], row[first])
            raw = w.data.tobytes()
            order = sorted(spans)
            unit = [raw[x:y].strip(b"\n") for _, x, y in order]
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array([r for r, *_ in order], pa.int64())), pa.array(unit, pa.binary()).cast(pa.string())], names=["key", "unit"])

    return run


def _distinct(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every row's distinct words."""
    w = words(b.column("text"))
    by = np.lexsort((w.hash, w.doc))
    doc, h = w.doc[by], w.hash[by]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, dtype=bool)
    return doc[new], h[new].view(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        w, df = np.unique(_distinct(b)[1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(df.astype(np.int64))], names=["w", "df"])


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        doc, w = _distinct(b)
        yield pa.RecordBatch.from_arrays([b.column("u").take(pa.array(doc)), pa.array(w)], names=["u", "w"])


_SCORED = "u bigint, last boolean, score double, license string"


def own_licenses(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """doc_id, path, license and score of what each document itself holds (null: nothing)."""
    spark = docs.sparkSession
    scanner = Scanner(*document_frequencies(docs, templates), templates, threshold)
    sent = spark.sparkContext.broadcast((scanner, Index(scanner.vocab)))

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _units(*sent.value)(batches)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = sent.value[0]
        for b in batches:
            rows = []
            for u, t, own in zip(b.column("u").to_pylist(), b.column("unit").to_pylist(), b.column("held").to_pylist()):
                known = {x["w"]: x["df"] for x in own or ()}
                single = sorted(set(_WORD.findall(t.lower())))
                others = {x: known.get(h, 0) for x, h in zip(single, words(pa.array(single, pa.string())).hash.view(np.int64).tolist())}
                last, score, name = scanner.best(t, others)
                if name is not None:
                    rows.append((u, last, score, name))
            u, last, score, name = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(last, pa.bool_()), pa.array(score, pa.float64()), pa.array(name, pa.string())], names=["u", "last", "score", "license"])

    key = F.xxhash64("text")
    text = docs.where(F.length("text") > 0)
    found = cut(text.select(key.alias("key"), F.lower("text").alias("text")).mapInArrow(units, "key bigint, unit string").select("key", F.xxhash64("unit").alias("u"), "unit"))
    unique = cut(found.groupBy("u").agg(F.first("unit").alias("unit")))
    # The words of these units, with the documents that hold them.
    own = unique.select("u", F.col("unit").alias("text")).mapInArrow(_held, "u bigint, w bigint")
    counts = cut(text.select(F.lower("text").alias("text")).mapInArrow(_counted, "w bigint, df bigint").groupBy("w").agg(F.sum("df").alias("df")))
    held = sized_join(own, counts, "w", "inner").groupBy("u").agg(F.collect_list(F.struct("w", "df")).alias("held"))
    score = cut(unique.join(held, "u", "left").select("u", "unit", "held").mapInArrow(scored, _SCORED))
    best = sized_join(found.select("key", "u").distinct(), score, "u", "inner").groupBy("key").agg(F.min(F.struct("last", (-F.col("score")).alias("less"), "license")).alias("best"))
    result = cut(best.select("key", "best.license", (-F.col("best.less")).alias("score")))
    return sized_join(docs.select("doc_id", "path", key.alias("key")), result, "key", "left").select("doc_id", "path", "license", "score")


def license_scan(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """doc_id, path, license, score, origin ("own", "inherited" or null) and the directory it is inherited from."""
    own = cut(own_licenses(docs, threshold, templates))
    folder = F.regexp_replace(F.regexp_extract("path", r"^(.*)/[^/]*$", 1), r"/+$", "")
    files = own.where(F.col("license").isNotNull() & F.col("path").rlike(FILE)).withColumn("from_dir", folder)
    given = cut(files.groupBy("from_dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("best")).select(F.col("from_dir").alias("dir"), F.col("best.license").alias("given"), (-F.col("best.s")).alias("given_score")))
    # Every ancestor of a path, the root included, by depth; the deepest with a licence is the nearest.
    parts = F.filter(F.split(folder, "/"), lambda x: x != "")
    lead = F.when(F.col("path").startswith("/"), "/").otherwise("")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.when(i == 0, "").otherwise(F.concat(lead, F.array_join(F.slice(parts, 1, i), "/"))).alias("dir")))
    bare = own.where("license IS NULL AND path IS NOT NULL").select("path").distinct()
    near = sized_join(bare.select("path", F.explode(ancestors).alias("a")).select("path", "a.depth", "a.dir"), given, "dir", "inner")
    nearest = cut(near.groupBy("path").agg(F.max(F.struct("depth", "dir", "given", "given_score")).alias("n")).select(F.col("path").alias("__path"), "n.dir", "n.given", "n.given_score"))
    joined = sized_join(own, nearest, (F.col("path") == F.col("__path")) & F.col("license").isNull(), "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited")
    return joined.select("doc_id", "path", F.coalesce("license", "given").alias("license"), F.coalesce("score", "given_score").alias("score"), origin.alias("origin"), F.when(F.col("license").isNull(), F.col("dir")).alias("from_dir"))


def with_paths(docs: DataFrame) -> DataFrame:
    """A stand-in for a path column: 64 documents a repository, 8 a directory, the first of each its licence file."""
    i = F.col("doc_id").cast("bigint")
    repo = F.concat(F.lit("r"), F.floor(i / 64).cast("string"))
    sub = F.concat(repo, F.lit("/s"), F.pmod(F.floor(i / 8), F.lit(8)).cast("string"))
    path = F.when(i % 64 == 0, F.concat(repo, F.lit("/LICENSE"))).when(i % 8 == 0, F.concat(sub, F.lit("/LICENSE"))).otherwise(F.concat(sub, F.lit("/f"), i.cast("string"), F.lit(".txt")))
    return docs.withColumn("path", path)
