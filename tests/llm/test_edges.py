"""Nulls in any column, empty and very long texts, repeated rows, empty tables and clashing names, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marlspan.llm import decontam, jaccard, langid, licenses, lmscore, media, mixing, pii, repeats, tokens

LONG = "the quick brown fox jumps over the lazy dog and runs away from here " * 9000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 10),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 10),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 10),
    (3, "", "en", None, 0),
    (4, None, None, "a", None),
    (None, "le renard brun saute par dessus le chien paresseux et puis il dort", "fr", "b", 3),
    (5, LONG, "en", "b", len(LONG)),
    (6, "mail anna.34@mail7.example.com or 152.143.123.131 now", "fr", "", 7),
    (7, "  \n\t ", "de", "c", 1),
]
#: Names that the operators use inside, or that their results have.
CLASHING = ("key", "block", "grams", "h", "at", "role", "predicted", "tokens", "text_", "n", "group_id", "score", "u", "v", "count", "take", "dir", "license", "raw", "payload", "node", "rep", "cell", "slot", "class_id", "__gone", "__again", "__row", "__lang", "__pii", "__len", "__hash", "__source", "__text", "__take", "__clean", "__tokens", "__own", "__path")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    # A map can be neither compared nor grouped: it has to pass through.
    return df.withColumns({c: F.lit("clash") for c in CLASHING} | {"m": F.create_map(F.lit("k"), F.col("n_chars"))}).cache()


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (None, "x"), (4, "nowhere to be found in any of these texts at all")], "item_id bigint, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, 1, None), (None, 1, 0), (6, None, 0)], "doc_id bigint, quality int, toxic int")


PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RUNS = {
    "op1": lambda d, b, l: media.media_tiles(media.rendered(d)),
    "op2": lambda d, b, l: repeats.maximal_repeats(d, 8),
    "op3": lambda d, b, l: pii.private_data(d),
    "op4": lambda d, b, l: langid.language_id(d),
    "op5": lambda d, b, l: mixing.mix_sources(d),
    "op6": lambda d, b, l: jaccard.near_classes(d),
    "op7": lambda d, b, l: decontam.matches(d, b),
    "op8": lambda d, b, l: licenses.license_scan(licenses.with_paths(d)),
    "op9": lambda d, b, l: tokens.token_counts(d, PATH),
    "op10": lambda d, b, l: lmscore.cross_parse(d, l),
    "keep4": lambda d, b, l: langid.keep_identified(d),
    "keep6": lambda d, b, l: jaccard.keep_one(d),
    "keep7": lambda d, b, l: decontam.keep_clean(d, b),
    "keep3": lambda d, b, l: pii.keep_redacted(d),
    "keep5": lambda d, b, l: mixing.keep_mixed(d),
}


@pytest.mark.parametrize("name", RUNS)
def test_hard_rows_and_empty_tables(docs, benchmark, labels, name):
    got = RUNS[name](docs, benchmark, labels)
    rows = got.collect()
    none = RUNS[name](docs.limit(0), benchmark.limit(0), labels.limit(0))
    assert none.columns == got.columns
    assert not none.collect()
    if name.startswith("keep"):
        assert got.columns == docs.columns
        assert len(rows) <= len(ROWS)
    if name in ("op3", "op4", "op9", "op10", "op8"):
        assert len(rows) == len(ROWS)


@pytest.mark.parametrize("name", RUNS)
def test_empty_benchmark_and_labels_alone(docs, benchmark, labels, name):
    rows = RUNS[name](docs, benchmark.limit(0), labels.limit(0)).collect()
    if name == "op7":
        assert not rows
    if name == "keep7":
        assert len(rows) == len(ROWS)
    if name == "op10":
        assert len(rows) == len(ROWS) and all(r.reference_bytes == 2 for r in rows)


def test_clashing_columns_pass_through(docs, benchmark):
    for kept in (langid.keep_identified(docs), jaccard.keep_one(docs), decontam.keep_clean(docs, benchmark), pii.keep_redacted(docs), mixing.keep_mixed(docs)):
        rows = kept.collect()
        assert rows and kept.columns == docs.columns and kept.dtypes == docs.dtypes
        assert all(r[c] == "clash" for r in rows for c in CLASHING) and all(r.m == {"k": r.n_chars} or kept is not docs for r in rows)


def test_repeated_ids_with_several_texts(spark):
    rows = [(1, "b " * 40, {"x": 1}), (1, "a c d e f g", {"x": 2}), (1, None, {"x": 3}), (2, "a c d e f g", {"x": 4}), (None, "a c d e f g", {"x": 5}), (None, None, {"x": 6})]
    df = spark.createDataFrame(rows, "doc_id long, text string, m map<string, int>")
    got = sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in jaccard.near_classes(df).collect())
    assert got == [(1, 1, 0), (1, 1, 0), (1, 1, 1), (2, 1, 1)]
    # Of document 1 the null text is the least: it stays, and document 2 isn't a copy of it.
    assert sorted(r.m["x"] for r in jaccard.keep_one(df).collect()) == [3, 4, 5, 6]


def test_values_of_hard_rows(docs, benchmark, labels):
    t = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs, PATH).collect()}
    assert t[3] == t[4] == 0 and t[5] > 100_000
    p = {r.doc_id: r for r in pii.private_data(docs).collect()}
    assert p[6].text == "mail [EMAIL] or [IP] now" and p[4].text is None and p[3].text == "" and p[4].redactions == []
    m = media.media_tiles(media.rendered(docs)).where("doc_id = 4").collect()
    assert [r.error for r in m] == ["null"]
    j = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard.near_classes(docs).collect())
    assert j == [(1, 1, 1), (2, 1, 1), *((d, d, 0) for d in (3, 4, 5, 6, 7))]
    kept = sorted((r.doc_id or 0) for r in jaccard.keep_one(docs).collect())
    assert kept == [0, 1, 3, 4, 5, 6, 7]
    hit = sorted((r.doc_id, r.item_id, r.distance) for r in decontam.matches(docs, benchmark).collect())
    assert hit == [(1, 1, 0), (2, 1, 0), (2, 1, 0), (5, 1, 0)]
    assert sorted((r.doc_id or 0) for r in decontam.keep_clean(docs, benchmark).collect()) == [0, 3, 4, 6, 7]
    s = {r.doc_id: r for r in lmscore.cross_parse(docs, labels).collect()}
    assert s[3].n_bytes == 0 and s[3].relative_entropy is None and s[4].cross_entropy is None and s[5].n_bytes == len(LONG)
    assert {r.doc_id for r in langid.language_id(docs).collect() if r.predicted is None} >= {3, 4, 7}


def test_pipeline_on_hard_rows_and_empty_tables(spark, docs, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    seen = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        seen = stage(spark, seen, str(tmp_path)).cache()
        left.append(sorted((r.doc_id or 0) for r in seen.collect()))
        assert seen.columns == docs.columns
    # Rejected: 3, 4 and 7, which have no text. Copies: 2, whose id is there twice besides. The benchmark is in 1 and 5.
    assert [set(x) for x in left[:3]] == [{0, 1, 2, 5, 6}, {0, 1, 5, 6}, {0, 6}] and left[3] == left[2]
    assert {r.doc_id: r.text for r in spark.createDataFrame(seen.collect(), seen.schema).collect()}.get(6) in (None, "mail [EMAIL] or [IP] now")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == docs.columns and sorted((r.doc_id or 0) for r in got.collect()) == left[4]
    for empty, other in (("documents", own.limit(0)), ("benchmark", benchmark.limit(0))):
        at = f"{tmp_path}/no-{empty}"
        (other if empty == "documents" else own).write.parquet(f"{at}/documents.parquet")
        (other if empty == "benchmark" else benchmark).write.parquet(f"{at}/benchmark.parquet")
        rows = corpus_pipeline.run(spark, at)
        assert rows.columns == own.columns and (rows.count() == 0) == (empty == "documents")
