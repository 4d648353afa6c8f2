"""Sources, sinks, images in shards, ingest, components and streams."""

import io
import json
import os
import shutil
import subprocess
import sys
import tarfile
import zipfile
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspan.functions import png
from marlspan.functions.messages import CHAT, first_response, with_prompt
from marlspan.functions.token_counters import token_count
from marlspan.operators import images, ingest, near_pages, profile, rewrites, rows
from marlspan.operators.components import connected_components
from marlspan.sources import records, tars
from marlspan.streaming import ingest as streams


def picture(seed, w=20, h=12, n=3):
    return png.encode(np.random.default_rng(seed).integers(0, 256, (h, w, n), dtype=np.uint8))


def test_jsonl_round_trip(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    good = {"id": "1", "messages": [dict(role="user", content="hé"), dict(role="assistant", content=None)], "images": ["s/a.png"], "extra": 1}
    (path / "a.jsonl").write_text(json.dumps(good, ensure_ascii=False) + "\n\n{broken\n" + json.dumps({"messages": []}) + "\n")
    got = {r.raw[:9]: r for r in records.read_jsonl(spark, str(path), CHAT).collect()}
    assert len(got) == 3 and not got["{broken"].valid and sum(r.valid for r in got.values()) == 2
    row = records.read_jsonl(spark, str(path), CHAT).where("id = '1'")
    assert row.select(first_response(None, F.col("messages")).alias("x")).first().x is None
    assert json.loads(row.first().raw)["extra"] == 1
    new = row.select(with_prompt(F.col("messages"), "new").alias("m")).first().m
    assert new[0].content == "new"
    records.write_jsonl(row.select("id", "messages", "images"), str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first().value) == {k: v for k, v in good.items() if k != "extra"}
    n = records.export_array(row.select("id", "images"), str(tmp_path / "a.json"))
    assert n == 1 and json.loads((tmp_path / "a.json").read_text()) == [{"id": "1", "images": ["s/a.png"]}]
    assert records.read_json_array(spark, str(tmp_path / "a.json"), T.StructType([T.StructField("id", T.StringType())])).first().id == "1"
    with pytest.raises(ValueError):
        rows.first_valid(row, 0, F.col("id"))


def test_shards_round_trip(spark, tmp_path):
    data = [(i, picture(i)) for i in range(23)]
    done = tars.write_shards(spark.createDataFrame(data, "idx long, data binary").repartition(5), str(tmp_path), "web", 10).collect()
    assert sorted((r.shard, r.members, r.first, r.last) for r in done) == [("images-00000.tar", 10, 0, 9), ("images-00001.tar", 10, 10, 19), ("images-00002.tar", 3, 20, 22)]
    got = tars.read_shards(spark, f"{tmp_path}/images-*.tar")
    assert {r.member: bytes(r.data) for r in got.collect()} == {f"web_{i:06d}.png": d for i, d in data}
    seq = got.select(F.regexp_extract("shard", r"(\d+)", 1).cast("long").alias("shard_no"), "pos", F.regexp_extract("member", r"(\d+)", 1).cast("long").alias("idx"))
    assert rows.sequence_errors(seq, 10).collect() == []
    wrong = rows.sequence_errors(seq.where("idx NOT IN (3, 21)"), 10).collect()
    assert sorted((r.shard_no, r.problem, r.first_divergence) for r in wrong) == [(0, "incomplete", 3), (2, "out of sequence", 1)]
    assert sorted((r.first, r.last, r.n) for r in rows.missing_ranges(seq.where("idx NOT IN (0, 3, 4, 22)"), 22).collect()) == [(0, 0, 1), (3, 4, 2), (22, 22, 1)]
    assert rows.reconciled(spark.range(25), seq, 20).collect()[0].asDict() == {"first": 23, "last": 24, "n": 2}
    with pytest.raises(ValueError):
        rows.reconciled(spark.range(5), seq, 20)


def test_broken_and_odd_shards(spark, tmp_path):
    with tarfile.open(tmp_path / "images-00000.tar", "w") as t:
        for name, body in (("./web_000001.png", b"b"), ("web_000000.png", b"a"), ("web_000001.png", b"c"), ("other.txt", b"d"), (".hidden.png", b"e")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    raw = (tmp_path / "images-00000.tar").read_bytes()
    (tmp_path / "images-00001.tar").write_bytes(raw[:700])
    (tmp_path / "images-00002.tar").write_bytes(b"not a tar at all" * 100)
    got = tars.read_shards(spark, f"{tmp_path}/images-*.tar")
    assert {r.member for r in got.where("shard LIKE '%0.tar'").collect()} == {"web_000001.png", "web_000000.png", "other.txt", "hidden.png"}
    assert {r.shard for r in got.where("error IS NOT NULL").collect()} >= {"images-00002.tar"}
    index = {r.member: r.pos for r in tars.tar_index(got.where("shard LIKE '%0.tar'")).collect()}
    assert index["web_000001.png"] == 2
    assert tars.repaired(str(tmp_path / "images-00000.tar"), "web") == 2
    again = tars.read_shards(spark, f"{tmp_path}/images-00000.tar").orderBy("pos").collect()
    assert [(r.member, bytes(r.data)) for r in again] == [("web_000000.png", b"a"), ("web_000001.png", b"c")]
    found = {r.name: r.shard for r in tars.lookup(spark.createDataFrame([("s1", "d/chunk_7_row_1.png", 0), ("s0", "chunk_7_row_9.png", 4)], "shard string, member string, pos long")).collect()}
    assert found["chunk_7"] == "s0" and found["chunk_7_row_1.png"] == "s1"
    web = spark.createDataFrame([("s", "k1.html", 0, b"\xff<p>"), ("s", "k1.png", 1, b"i"), ("s", "k2.png", 2, b"j")], "shard string, member string, pos long, data binary")
    assert [(r.key, r.html, bytes(r.png)) for r in tars.web_dataset(web).collect()] == [("k1", "�<p>", b"i")]


def test_image_filters(spark, tmp_path):
    flat = png.encode(np.full((10, 10, 3), (255, 0, 0), dtype=np.uint8))
    data = [("a.png", picture(1)), ("red.png", flat), ("bad.png", b"x"), ("cut.png", picture(2)[:-20]), ("wide.png", picture(3, 2000, 2))]
    with tarfile.open(tmp_path / "s.tar", "w") as t:
        for name, body in data:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    facts = images.image_facts(tars.read_shards(spark, f"{tmp_path}/s.tar"), "phash").cache()
    chat = spark.createDataFrame([(i, [f"s.tar/{n}"]) for i, (n, _) in enumerate(data)] + [(8, []), (9, ["s.tar/none.png"]), (10, ["nopath"]), (11, ["s.tar/a.png", "s.tar/bad.png"])], "pos long, images array<string>")
    reason = lambda c: {r.pos: r.reason for r in images.first_bad(chat, facts, c).collect()}
    assert reason(images.corrupt()) == {0: None, 1: None, 2: "corrupt", 3: "corrupt", 4: None, 8: None, 9: "missing", 10: "bad path", 11: "corrupt"}
    assert reason(images.too_large())[4] == "width" and reason(images.too_large(None, None))[4] is None
    assert reason(images.misshapen())[4] == "width" and reason(images.misshapen(5000))[4] == "aspect"
    # A uniform red is of one colour by its channels' extremes, and isn't by the deviation of all values.
    assert reason(images.solid("extrema"))[1] == "solid" and reason(images.solid("global_std_le", 1.0))[1] is None and reason(images.misshapen())[1] is None
    own = spark.createDataFrame([("1", "s.tar", "a.png", "some words here"), ("2", "s.tar", "bad.png", "x"), ("3", "", "a.png", "x"), ("4", "s.tar", "zz.png", "x")], "id string, shard string, image_in_tar string, r string")
    stats = {r.id: r for r in images.row_statistics(own, facts, F.col("r")).collect()}
    assert set(stats) == {"1", "2", "4"} and stats["1"].gpt_token_count == 3 and stats["1"].image_width == 20 and stats["2"].corrupted and stats["2"].gpt_char_count is None and stats["4"].corruption_reason == "missing"
    near = near_pages.image_links(facts.where("image_hash IS NOT NULL").select("member", "image_hash"), "member")
    assert near.count() >= 0
    assert images.missing_image_policy(own, F.col("id") == "4", "drop").count() == 3 and images.missing_image_policy(own, F.col("id") == "4", "keep").count() == 4
    with pytest.raises(Exception, match="missing"):
        images.missing_image_policy(own, F.col("id") == "4", "fail").collect()


def test_ingest_counts_the_first_failing_rule(spark):
    data = [(0, picture(1), "<p>a</p>", "en"), (1, None, "x", "en"), (2, picture(2), "  ", "en"), (3, b"broken", "y", "en"), (4, picture(4), "z", "en"), (5, None, "", "fr")]
    kept, lost = ingest.ingested(spark.createDataFrame(data, "n long, image binary, text string, lang string"), ingest.web_code("en"), F.col("n"), size=1)
    got = kept.orderBy("idx").collect()
    assert [(r.n, r.idx, r.id, r.shard, r.member) for r in got] == [(0, 0, "crawl_000000", "images-00000.tar", "crawl_000000.png"), (4, 1, "crawl_000001", "images-00001.tar", "crawl_000001.png")]
    assert {r.reason: r["count"] for r in lost.collect()} == {"no_image": 1, "empty_text": 1, "image_decode_failed": 1, "language": 1}
    chat = ingest.chat_rows(kept, "draw").orderBy("idx").first()
    assert chat.messages[0].content == "draw" and chat.images == ["images-00000.tar/crawl_000000.png"]
    assert ingest.coded_rows(kept, "web", "html").orderBy("image_path").first().code == "```html\n<p>a</p>\n```"
    for s in (ingest.web_pages(), ingest.instructions(), ingest.multimodal_code(), ingest.parquet_pages(True), ingest.archives()):
        assert s.rules and s.prefix


def test_zip(spark, tmp_path):
    rows_ = spark.createDataFrame([("web_000000", b"img", "html", "<p>", "w")], "name string, image binary, code_language string, code string, source string")
    path = str(tmp_path / "x.zip")
    assert records.write_zip(rows_, path, "Web") == 1
    assert zipfile.ZipFile(path).namelist()[-1] == "meta_data_Web.json"
    assert records.zip_layout(path) == {"metadata": "meta_data_Web.json", "category": "Web", "root": ""}
    got = records.zip_members(spark.createDataFrame([("images/web_000000.png",), ("nope",), (None,)], "member string"), path).collect()
    assert [r.data and bytes(r.data) for r in sorted(got, key=lambda r: r.member or "")] == [None, b"img", None]
    assert records.write_folder(rows_, str(tmp_path / "f")).collect()[0].name == "web_000000"
    assert (tmp_path / "f/codes/web_000000.html").read_text() == "<p>"


def test_components_against_union_find(spark):
    import random

    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(3, 3), (None, 1)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_pages_against_all_pairs(spark):
    base = "".join(f"<p>word{i} other{i}</p>" for i in range(40))
    docs = [(i, f"<html><body>{base}{'<p>more%d</p>' % i if i % 3 else ''}</body></html>") for i in range(8)] + [(20, "<div>quite another page</div>"), (21, "")]
    from marlspan.functions.hashes import page_hashes

    h = {k: page_hashes(x) for k, x in docs}
    d = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    band = lambda x: {(i, (x >> 16 * i) & 65535) for i in range(4)}
    want = {(a, b) for a in h for b in h if a < b and (band(h[a][0]) & band(h[b][0]) or band(h[a][1]) & band(h[b][1])) and (d(h[a][0], h[b][0]) <= 3 or (d(h[a][0], h[b][0]) <= 6 and d(h[a][1], h[b][1]) <= 6))}
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in h.items()], "page_id long, text_hash long, dom_hash long")
    got = {tuple(r) for r in near_pages.page_links(df).collect()}

    def components(edges):
        root = {k: k for k in h}
        for _ in h:
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert got <= want and components(got) == components(want) and len(set(components(want).values())) > 2
    # A quality of its own goes before the density, images link too, and pages without one are treated as asked.
    rows_ = [(k, x, "9" if k == 5 else None, None if k == 21 else 0 if k in (1, 20) else 2**k) for k, x in docs]
    pages = spark.createDataFrame(rows_, "page_id long, html string, q string, image long")
    clusters = lambda **o: {r.page_id: r.cluster for r in near_pages.curated(pages, k=99, **o).collect()}
    assert clusters() == components(want)
    linked = clusters(image="image", missing="drop")
    assert 21 not in linked and linked[20] == linked[1] and set(clusters(image="image")) == set(h)
    best = {r.cluster: r.page_id for r in near_pages.curated(pages, given="q").collect()}
    assert best[components(want)[5]] == 5
    kept = near_pages.curated(spark.createDataFrame(docs, "page_id long, html string"), k=1).collect()
    assert len({r.cluster for r in kept}) == len(kept)
    assert near_pages.curated(spark.createDataFrame(docs, "page_id long, html string"), top_n=0).collect() == []


def test_rewrites_report_reasons(spark):
    df = spark.createDataFrame([(1, "<html><style>.aa{b:c}</style><body class='aa'></body></html>"), (2, ""), (3, "text"), (4, "<html></html>"), (5, None)], "id long, html string")
    got = {r.id: (r.processed, r.reason) for r in rewrites.rewrite(df, "html", "max_compression").collect()}
    assert got == {1: (True, None), 2: (False, "no_gpt_response"), 3: (False, "no_html_content"), 4: (False, "no_style_tags"), 5: (False, "no_gpt_response")}
    assert rewrites.rewrite(df, "html", "class_names").where("id = 3").first().html == "text"
    report = rows.skip_report(rewrites.rewrite(df, "html", "max_compression")).first()
    assert report.total_skipped == 4 and report.skip_reasons["no_gpt_response"] == 2
    kept, lost = rows.rejects(rewrites.rewrite(df, "html", "max_compression"))
    assert kept.count() == 1 and lost.count() == 4
    assert rows.skip_report(df.withColumn("reason", F.lit(None).cast("string"))).collect() == []


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    schema = T.StructType([T.StructField("n", T.LongType())])

    def run():
        s = streams.new_files(spark, str(src), schema)
        streams.available_now(s, str(tmp_path / "check"), streams.into_dense_ids(str(out), F.col("n"))).awaitTermination()
        return sorted((r.idx, r.n) for r in spark.read.parquet(str(out)).collect())

    (src / "a.json").write_text('{"n": 5}\n{"n": 3}\n')
    assert run() == [(0, 3), (1, 5)]
    (src / "b.json").write_text('{"n": 9}\n{"n": 1}\n')
    assert run() == [(0, 3), (1, 5), (2, 1), (3, 9)]
    assert run() == [(0, 3), (1, 5), (2, 1), (3, 9)]


def test_counters(spark):
    import public_tokenizers as P

    df = spark.createDataFrame([("hello, world",), (None,)], "t string")
    for name, file in (("words", None), ("ranks", "byte_bpe_50k.tiktoken"), ("json", "byte_bpe_50k.json"), ("pieces", "piece_bpe_32k.model")):
        got = [r.n for r in df.select(token_count(F.col("t"), name, file and P.path(file)).alias("n")).collect()]
        assert got[1] is None and got[0] >= 3
    with pytest.raises(ValueError):
        token_count(F.col("t"), "cl100k_base")


def test_routing_is_seeded(spark):
    df = spark.range(4000).withColumnRenamed("id", "k")
    a = {r.k for r in rows.routed(df, 0.3, 7, "k").where("route").collect()}
    b = {r.k for r in rows.routed(df.repartition(7), 0.3, 7, "k").where("route").collect()}
    assert a == b and 1000 < len(a) < 1400


def test_the_rest_works_without_the_subpackage(tmp_path):
    """On a copy without the subpackage, its tests and the pipeline: all other queries are there, and their modules import."""
    here = Path(__file__).resolve().parents[1]
    copy = tmp_path / "copy"
    shutil.copytree(here, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = (
        "import importlib, pkgutil, marlspan, __spark_entry__ as e\n"
        "for m in pkgutil.walk_packages(marlspan.__path__, 'marlspan.'):\n    m.name.endswith('__main__') or importlib.import_module(m.name)\n"
        "assert 'pipeline' not in e.queries() and not any(n.startswith('op') and n[2].isdigit() for n in e.queries())\n"
        "assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 100\nprint('fine')"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert got.stdout.endswith("fine\n"), got.stderr


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0


def test_summary_equals_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    rows_ = [(None if k % 9 == 0 else float(rng.integers(0, 6)), float(rng.normal()), None, 5.0) for k in range(700)]
    df = spark.createDataFrame(rows_, "a double, b double, c double, d double").repartition(5)
    got = {r.field: r for r in profile.summary(df, "a", "b", "c", "d").collect()}
    for i, c in enumerate("abd"):
        v = np.array([r["abcd".index(c)] for r in rows_ if r["abcd".index(c)] is not None])
        r = got[c]
        assert (r["count"], r["min"], r["max"]) == (len(v), v.min(), v.max())
        assert np.allclose([r["mean"], r["std"], r["median"]], [v.mean(), v.std(), np.median(v)])
        assert np.allclose([r[f"p{p}"] for p in profile.PERCENTILES], np.percentile(v, profile.PERCENTILES))
    assert got["c"]["count"] == 0 and got["c"]["p50"] is None
    assert profile.summary(df.limit(0), "a").first()["count"] == 0


def test_arrays_go_on_after_an_empty_beginning(spark, tmp_path):
    df = spark.range(7).select(F.col("id").alias("k"), F.concat(F.lit('a"b '), F.col("id").cast("string")).alias("t"))
    at = f"file://{tmp_path}/a"
    records.write_array(df.where("k > 99"), at, F.col("k"))
    for cut in (df.where("k < 3"), df.where("k > 99"), df.where("k >= 3").repartition(3)):
        records.append_array(cut, at, F.col("k"))
    text = "".join(p.read_text() for p in sorted(tmp_path.glob("a/*/part-*")))
    assert json.loads(text) == [{"k": k, "t": f'a"b {k}'} for k in range(7)]
    with pytest.raises(ValueError):
        records.write_array(df, at, F.col("k"))


def test_scratch_removes_what_is_not_kept(spark, tmp_path):
    from marlspan import shared

    with shared.scratch(spark):
        gone = shared.cut(spark.range(3))
        kept = shared.cut(gone.where("id > 0"), kept=True)
        paths = [Path(df.inputFiles()[0].removeprefix("file:").replace("///", "/")).parent for df in (gone, kept)]
    assert [p.exists() for p in paths] == [False, True] and kept.count() == 2
    shared.discard(kept)
    assert not paths[1].exists()
    outside = shared.cut(spark.range(2))
    assert outside.count() == 2


@pytest.mark.parametrize("profile", ["balanced", "loose"])
def test_links_do_not_grow_with_the_square_of_near_pages(spark, monkeypatch, profile):
    # Near one hash with a few structures, in several cells: the same clusters as by all pairs, by few links.
    monkeypatch.setattr(near_pages, "CELL", 64)
    rng, t = np.random.default_rng(5), near_pages.PROFILES[profile]
    flips = lambda n, most: sum(1 << int(b) for b in rng.choice(64, rng.integers(0, most + 1), replace=False)) if n else 0
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    h = {k: (signed(0x0F1E2D3C4B5A6978 ^ flips(k, 9)), signed(0x8000000000000001 << (k % 3) & 2**64 - 1)) for k in range(300)}
    h |= {k: (int(rng.integers(-(2**63), 2**63)), 5) for k in range(300, 310)}
    d = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    band = lambda x: {(i, (x >> 16 * i) & 65535) for i in range(4)}
    linked = lambda a, b: (band(a[0]) & band(b[0]) or band(a[1]) & band(b[1])) and (d(a[0], b[0]) <= t[0] or (d(a[0], b[0]) <= t[1] and d(a[1], b[1]) <= t[2]))
    every = {(a, b) for a in h for b in h if a < b and linked(h[a], h[b])}
    got = {tuple(r) for r in near_pages.page_links(spark.createDataFrame([(k, *x) for k, x in h.items()], "page_id long, text_hash long, dom_hash long"), profile=profile).collect()}

    def components(edges):
        root = {k: k for k in h}
        while any(root[a] != root[b] for a, b in edges):
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert got <= every and components(got) == components(every) and 1 < len(set(components(every).values())) < len(h)
    assert len(every) > 2500 and len(got) < len(every) / 2


def test_small_shards_are_read_together(spark, tmp_path):
    tars.write_shards(spark.range(600).select(F.col("id").alias("idx"), F.lit("data").cast("binary").alias("data")), str(tmp_path), "web", 2).collect()
    got = tars.read_shards(spark, f"{tmp_path}/images-*.tar")
    assert got.rdd.getNumPartitions() <= 2 * 4 * spark.sparkContext.defaultParallelism < 300
    assert {(r.shard, r.member, r.pos, bytes(r.data)) for r in got.collect()} == {(f"images-{i // 2:05d}.tar", f"web_{i:06d}.png", i % 2, b"data") for i in range(600)}
    # A shard that breaks off within its first member, amid whole ones: checked or loaded, that member doesn't count.
    with open(tmp_path / "images-00001.tar", "r+b") as f:
        f.truncate(513)
    told = lambda **o: {(r.shard, r.member, r.error) for r in tars.read_shards(spark, f"{tmp_path}/images-*.tar", **o).collect()}
    assert told(data=False, checked=True) == told() and len(told()) == 599
    assert tars._together([str(p) for p in tmp_path.iterdir()], 1) and tars._together([], 4) == []


def test_thumbnails_of_small_and_large_images():
    from marlspan.functions import hashes

    for h, w, to in ((6, 8, (6, 8)), (40, 300, (16, 128)), (3, 2, (3, 2))):
        a = np.random.default_rng(1).integers(0, 256, (h, w))
        assert (hashes.lanczos(a, *to) == hashes._weights(h, to[0]) @ a.astype(np.float64) @ hashes._weights(w, to[1]).T).all()
