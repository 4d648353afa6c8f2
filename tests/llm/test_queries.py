"""The registered queries over whole tables, and the pipeline against a brute-force version of each stage."""

import collections
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from marlspan.llm import decontam, jaccard, langid, pii, queries, repeats
from marlspan.llm.words import WORD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def test_there_is_one_query_for_each_operator():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "private data", "source mixing"]


@pytest.mark.parametrize("name,rows", [("op1_media_tiles", 4), ("op3_private_data", 1), ("op4_language_id", 1), ("op8_license_scan", 1), ("op9_token_counts", 1), ("op10_cross_parsing", 1)])
def test_every_document_has_its_rows(spark, docs, name, rows):
    got = queries.QUERIES[name](spark, SF)
    assert got.count() == rows * docs.count() and got.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_jaccard_equals_its_sql(spark):
    c = duckdb.connect()
    import os

    p = f"{SF}/documents.parquet"
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    c.execute(jaccard.ORACLE)
    names = [d[0] for d in c.description]
    want = {tuple(r[names.index(k)] for k in ("doc_id", "class_id", "n_links")) for r in c.fetchall()}
    got = {(r.doc_id, r.class_id, r.n_links) for r in queries.QUERIES["op6_ngram_jaccard"](spark, SF).collect()}
    assert got == want and got


def test_repeats_hold_in_the_texts(spark, docs):
    words = {r.doc_id: re.findall(WORD, r.text.lower()) for r in docs.collect()}
    found = collections.defaultdict(list)
    for r in repeats.occurrences(queries.QUERIES["op2_maximal_repeats"](spark, SF)).collect():
        found[r.group_id, r.first, r.whole_words, r.n_words].append((r.doc_id, r.start))
    for (*_, n), own in found.items():
        parts = {tuple(words[d][s : s + n]) for d, s in own}
        assert len(parts) == 1 and len(next(iter(parts))) == n >= 50
        before = [words[d][s - 1] if s else None for d, s in own]
        after = [words[d][s + n] if s + n < len(words[d]) else None for d, s in own]
        assert all(None in x or len(set(x)) > 1 for x in (before, after))
    assert found


def test_pipeline_against_brute_force(spark, docs):
    own = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, own, SF).cache()
        before, after = {r.doc_id: r for r in own.collect()}, {r.doc_id: r for r in out.collect()}
        if k < 4:
            assert out.columns == docs.columns
        if k == 0:
            dicts = langid.train(own)
            assert set(after) == {d for d, r in before.items() if langid.classify(r.text.lower().encode(), dicts)[0]}
        elif k == 1:
            sets = {}
            for d, r in before.items():
                w = re.findall(WORD, r.text.lower())
                sets[d] = {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
            root = {d: d for d in sets}

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x

            for a in sets:
                for b in sets:
                    if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b]):
                        x, y = find(a), find(b)
                        root[max(x, y)] = min(x, y)
            assert set(after) == {d for d in sets if find(d) == d}
        elif k == 2:
            items = [decontam.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            clean = {d for d, r in before.items() if not any(decontam.distance(i, decontam.normal(r.text), int(decontam.ERRORS * (len(i) - 2))) <= int(decontam.ERRORS * (len(i) - 2)) for i in items)}
            assert set(after) == clean
        elif k == 3:
            model, thresholds = pii.trained()
            assert set(after) == set(before)
            for d, r in before.items():
                [spans] = pii.selected([r.text], model, thresholds)
                assert after[d].text == pii.redact(r.text, spans) and after[d].n_chars == (len(after[d].text) if spans else r.n_chars)
        else:
            have, total = collections.Counter(), collections.Counter()
            for rows, count in ((before, total), (after, have)):
                for r in rows.values():
                    count[r.source] += len(r.text.split())
            # 0.7 of all tokens by the roots of the sources' tokens; a source gives all it has at most.
            low, high = 0.0, float(sum(total.values()))
            for _ in range(200):
                level = (low + high) / 2
                short = sum(min(n, level * n**0.5) for n in total.values()) < 0.7 * sum(total.values())
                low, high = (level, high) if short else (low, level)
            for source, n in total.items():
                budget = int(min(n, high * n**0.5) + 1e-6)
                sums = 1  # bit s: whether documents of s tokens in all can be chosen
                for r in before.values():
                    if r.source == source:
                        sums |= sums << len(r.text.split())
                assert have[source] == (sums & ((1 << budget + 1) - 1)).bit_length() - 1
            assert all(after[d] == before[d] for d in after)
        own = out
    assert corpus_pipeline.run(spark, SF).count() == own.count()
    assert own.where(F.col("text").isNull()).count() == 0
