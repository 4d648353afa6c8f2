"""Named queries that write what they read: files, archives and shards made of the driver's tables, and their SQL.

Everything is written below the session's shared folder, of which Python on all executors must have the path.
"""

from __future__ import annotations

import glob
import os
import tarfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspan.functions import code_text, messages, png
from marlspan.functions.rewriting import BLOCKS
from marlspan.operators import convert, images, ingest, preferences, profile, rewrites, rows
from marlspan.plans.catalog import chats, query, table
from marlspan.shared import cut, shared_dir
from marlspan.sources import records, tars


def folder(spark: SparkSession, name: str) -> str:
    """A new folder, as a path of the file system."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}".removeprefix("file://").removeprefix("file:")
    os.makedirs(path)
    return path


# Lines and arrays of JSON, and parquet.

_ROW = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())])


@query("SELECT doc_id, lang, length(text) AS n, true AS valid FROM documents UNION ALL SELECT NULL, NULL, NULL, false FROM documents WHERE doc_id % 50 = 0")
def jsonl_scan(spark, sf_dir):
    """Lines as they were written, and broken ones among them; blank ones don't count."""
    at = folder(spark, "lines")
    docs = table(spark, sf_dir, "documents")
    line = F.to_json(F.struct("doc_id", "lang", "text"))
    bad = docs.where("doc_id % 50 = 0").select(F.explode(F.array(F.concat(F.lit('{"doc_id": '), "text"), F.lit("   "))).alias("value"))
    docs.select(line.alias("value")).union(bad.withColumn("value", F.regexp_replace("value", r"[\n\r]", " "))).write.text(f"file://{at}/part")
    return records.read_jsonl(spark, f"file://{at}/part", _ROW).select("doc_id", "lang", F.length("text").cast("bigint").alias("n"), "valid")


@query("SELECT doc_id, lang, length(text) AS n FROM documents")
def jsonl_sink(spark, sf_dir):
    at = f"file://{folder(spark, 'lines')}/part"
    records.write_jsonl(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), at)
    return spark.read.schema(_ROW).json(at).select("doc_id", "lang", F.length("text").cast("bigint").alias("n"))


@query("SELECT doc_id, lang, length(text) AS n FROM documents")
def array_sink(spark, sf_dir):
    """One array over all files that are written, by all tasks; read back line by line."""
    at = f"file://{folder(spark, 'array')}/part"
    records.write_array(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), at, F.col("doc_id"))
    return records.read_array_lines(spark, at, _ROW).select("doc_id", "lang", F.length("text").cast("bigint").alias("n"))


@query("SELECT doc_id, lang FROM documents")
def array_append(spark, sf_dir):
    """An array that is written in two parts: the second goes on where the first ended."""
    at = folder(spark, "array")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    records.write_array(docs.where("lang = 'en'"), f"file://{at}/first", F.col("doc_id"))
    records.append_array(docs.where("lang <> 'en'"), f"file://{at}/first", F.col("doc_id"))
    whole = spark.createDataFrame([("".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{at}/first/*/part-*"))),)], "value string")
    return whole.select(F.explode(F.from_json("value", "array<struct<doc_id: bigint, lang: string>>")).alias("row")).select("row.*")


@query("SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1")
def json_array_scan(spark, sf_dir):
    at = f"{folder(spark, 'array')}/rows.json"
    records.export_array(chats(spark, sf_dir), at)
    kind = "conv_id bigint, messages array<struct<role: string, content: string>>"
    return records.read_json_array(spark, f"file://{at}", T._parse_datatype_string(kind)).select("conv_id", F.size("messages").cast("bigint").alias("n"))


@query("SELECT page_id, length(html) AS n, length(url) AS m FROM pages")
def parquet_pairs(spark, sf_dir):
    at = f"file://{folder(spark, 'pairs')}/part"
    pages = table(spark, sf_dir, "pages")
    pages.select(F.col("url").alias("user_content"), F.col("html").alias("assistant_content"), F.col("page_id").cast("string").cast("binary").alias("image"), F.lit("other").alias("other")).write.parquet(at)
    got = records.read_pairs(spark, at)
    return got.select(F.col("image").cast("string").cast("bigint").alias("page_id"), F.length("assistant_content").cast("bigint").alias("n"), F.length("user_content").cast("bigint").alias("m"))


# Archives.


def _archive() -> Column:
    """The archive of a page."""
    return F.format_string("pages-%05d.zip", F.floor(F.col("page_id") / 2500).cast("bigint")).alias("archive")


def _archives(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Pages with an even id in archives; the folder, and what the writer says."""
    at = folder(spark, "archives")
    pages = table(spark, sf_dir, "pages").where("page_id % 2 = 0")
    member = F.concat(F.lit("images/p"), F.col("page_id").cast("string"), F.lit(".html"))
    return at, cut(records.write_archives(pages.select(_archive(), member.alias("member"), F.encode("html", "utf-8").alias("data")), at, "pages"))


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN octet_length(encode(html)) END AS size FROM pages")
def zip_lookup(spark, sf_dir):
    names = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("root/images/p"), F.col("page_id").cast("string"), F.lit(".html")).alias("member"), _archive())
    return records.zip_members(names, _archives(spark, sf_dir)[0], of="archive").select("page_id", F.length("data").cast("bigint").alias("size"))


@query("SELECT 'root/meta_data_pages.json' AS metadata, 'pages' AS category, 'root/' AS root")
def zip_introspection(spark, sf_dir):
    """What the archives say of themselves, which is the same of all."""
    at, written = _archives(spark, sf_dir)
    return records.zip_layouts(written, at).select("metadata", "category", "root").distinct()


@query("SELECT page_id, 'images/' || url AS path FROM pages")
def path_prefix(spark, sf_dir):
    once = code_text.prefixed(F.col("url"), "images/")
    return table(spark, sf_dir, "pages").select("page_id", code_text.prefixed(once, "images/").alias("path"))


# Shards.

SIZE = 64


def _shards(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Every document's bytes in shards of SIZE, by doc_id; the folder, and what the writer says."""
    at = folder(spark, "shards")
    got = tars.write_shards(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), F.encode("text", "utf-8").alias("data")), at, "web", SIZE)
    return at, cut(got)


_SHARD = f"printf('images-%05d.tar', doc_id // {SIZE})"


@query(f"SELECT {_SHARD} AS shard, count(*) AS members, min(doc_id) AS first, max(doc_id) AS last FROM documents GROUP BY 1")
def shard_sink(spark, sf_dir):
    return _shards(spark, sf_dir)[1].select("shard", "members", "first", "last")


@query(f"SELECT {_SHARD} AS shard, printf('web_%06d.png', doc_id) AS member, doc_id % {SIZE} AS pos, octet_length(encode(text)) AS size, md5(text) AS digest FROM documents")
def shard_scan(spark, sf_dir):
    got = tars.read_shards(spark, f"{_shards(spark, sf_dir)[0]}/images-*.tar")
    return got.select("shard", "member", "pos", "size", F.md5("data").alias("digest"))


@query("SELECT doc_id, doc_id % 3 + 5 AS size FROM documents")
def shard_index(spark, sf_dir):
    """Of members of one name the last counts: each name is written twice, the second time longer."""
    at = folder(spark, "twice")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(F.lit(3), F.lit(5))).alias("size"))
    data = F.encode(F.repeat(F.lit("\0"), (F.col("size") + F.col("doc_id") % 3).cast("int")), "utf-8")
    place = F.col("size") * F.lit(1 << 40) + F.col("doc_id")
    cut(tars.write_members(docs.select(F.floor(F.col("doc_id") / tars.SHARD_SIZE).alias("shard_no"), place.alias("idx"), F.format_string("./web_%06d.png", "doc_id").alias("member"), data.alias("data")), at))
    got = tars.tar_index(tars.read_shards(spark, f"{at}/images-*.tar", data=False))
    return got.select(F.regexp_extract("member", r"(\d+)", 1).cast("bigint").alias("doc_id"), "size")


@query(f"SELECT printf('web_%06d.png', doc_id) AS name, {_SHARD} AS shard FROM documents")
def shard_lookup(spark, sf_dir):
    return tars.lookup(tars.read_shards(spark, f"{_shards(spark, sf_dir)[0]}/images-*.tar", data=False)).select("name", "shard")


@query("SELECT 'chunk_' || (page_id // 10) AS name, min(page_id) AS page_id FROM pages GROUP BY 1")
def chunk_lookup(spark, sf_dir):
    """Members named by chunk and row: a chunk's name leads to its first."""
    at = folder(spark, "chunks")
    name = F.format_string("a/chunk_%d_row_%d.png", F.floor(F.col("page_id") / 10).cast("bigint"), "page_id")
    cut(tars.write_members(table(spark, sf_dir, "pages").select(F.floor(F.col("page_id") / tars.SHARD_SIZE).alias("shard_no"), F.col("page_id").alias("idx"), name.alias("member"), F.lit(b"").alias("data")), at))
    got = tars.lookup(tars.read_shards(spark, f"{at}/images-*.tar", data=False)).where("name RLIKE '^chunk_[0-9]+$'")
    return got.select("name", F.regexp_extract("member", r"row_(\d+)", 1).cast("bigint").alias("page_id"))


@query("SELECT page_id, octet_length(encode(html)) AS html_size, octet_length(encode(url)) AS png_size FROM pages WHERE page_id % 5 <> 0")
def web_dataset(spark, sf_dir):
    """Pairs of members; of every fifth page the image is missing."""
    at = folder(spark, "pairs")
    own = lambda k, kind, c: F.struct((F.col("page_id") * 2 + k).alias("idx"), F.format_string(f"%08d.{kind}", "page_id").alias("member"), F.encode(c, "utf-8").alias("data"))
    both = F.array(own(0, "html", "html"), F.when(F.col("page_id") % 5 != 0, own(1, "png", "url")))
    members = table(spark, sf_dir, "pages").select(F.spark_partition_id().alias("shard_no"), F.explode(both).alias("m")).where("m IS NOT NULL")
    # A page's members are written where the page is read: nothing is shuffled.
    cut(tars.write_members(members.select("shard_no", "m.*"), at, together=True))
    got = tars.web_dataset(tars.read_shards(spark, f"{at}/*.tar"))
    return got.select(F.col("key").cast("bigint").alias("page_id"), F.length(F.encode("html", "utf-8")).cast("bigint").alias("html_size"), F.length("png").cast("bigint").alias("png_size"))


def _broken(spark: SparkSession, sf_dir: str) -> str:
    """Shards of which the first breaks off after its tenth member."""
    at, _ = _shards(spark, sf_dir)
    path = f"{at}/images-00000.tar"
    with tarfile.open(path) as tar:
        end = tar.getmembers()[10].offset + 512
    with open(path, "r+b") as f:
        f.truncate(end)
    return at


_CUT = "WITH d AS (SELECT doc_id FROM documents WHERE doc_id >= 64 OR doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 10))"


@query(f"{_CUT} SELECT {_SHARD} AS shard, count(*) AS readable, min(doc_id) < 64 AS broken FROM d GROUP BY 1")
def shard_validation(spark, sf_dir):
    got = tars.read_shards(spark, f"{_broken(spark, sf_dir)}/images-*.tar", data=False, checked=True)
    return got.groupBy("shard").agg(F.count("member").alias("readable"), (F.count("error") > 0).alias("broken"))


@query(f"{_CUT} SELECT {_SHARD} AS shard, printf('web_%06d.png', doc_id) AS member FROM d")
def shard_repair(spark, sf_dir):
    at = _broken(spark, sf_dir)
    tars.repaired(f"{at}/images-00000.tar", "web")
    return tars.read_shards(spark, f"{at}/images-*.tar", data=False).select("shard", "member")


@query("WITH d AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 64) SELECT 10 AS first, 63 AS last, 54 AS n WHERE (SELECT count(*) FROM d) = 64")
def reconcile(spark, sf_dir):
    """Rows without a member, as ranges: those that the broken shard has lost."""
    got = tars.read_shards(spark, f"{_broken(spark, sf_dir)}/images-*.tar", data=False, checked=True).where("member IS NOT NULL")
    present = got.select(F.regexp_extract("member", r"(\d+)", 1).cast("bigint").alias("idx"))
    return rows.reconciled(table(spark, sf_dir, "documents").select("doc_id"), present, 0).select("first", "last", "n")


@query("SELECT page_id, length(html) AS n FROM pages")
def folder_sink(spark, sf_dir):
    at = folder(spark, "folder")
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("name"), F.col("url").cast("binary").alias("image"), F.lit("html").alias("code_language"), F.col("html").alias("code"))
    records.write_folder(pages, at).write.format("noop").mode("overwrite").save()
    got = spark.read.text(f"file://{at}/codes/*.html", wholetext=True).withColumn("file", F.col("_metadata.file_name"))
    return got.select(F.regexp_extract("file", r"p(\d+)", 1).cast("bigint").alias("page_id"), F.length("value").cast("bigint").alias("n"))


# Images: PNGs made of the documents' ids, in shards.


@F.arrow_udf(T.BinaryType())
def drawn(ids: pa.Array) -> pa.Array:
    """By id modulo 6: one colour, a gradient, a broken file, none at all, a wide and a long gradient."""
    out = []
    for i in ids.to_pylist():
        kind, w, h = i % 6, 8 + i % 5, 6 + i % 3
        w, h = (40, 3) if kind == 4 else (2, 30) if kind == 5 else (w, h)
        image = np.full((h, w, 3), i % 251, dtype=np.uint8) if kind == 0 else (np.indices((h, w)).sum(0)[:, :, None] * np.array([5, 6, 7])).astype(np.uint8)
        data = png.encode(image)
        out.append(data[: len(data) // 2] if kind == 2 else b"no image" if kind == 3 else data)
    return pa.array(out, pa.binary())


def _pictures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rows with an image each, of every seventh one that isn't in the shards; and the images' facts."""
    at = folder(spark, "pictures")
    docs = table(spark, sf_dir, "documents")
    cut(tars.write_shards(docs.where("doc_id % 7 <> 0").select(F.col("doc_id").alias("idx"), drawn("doc_id").alias("data")), at, "web", SIZE))
    ref = F.format_string("images-%05d.tar/web_%06d.png", F.floor(F.col("doc_id") / SIZE).cast("bigint"), F.col("doc_id"))
    own = docs.select("doc_id", F.array(ref).alias("images"), "text")
    return own, cut(images.image_facts(tars.read_shards(spark, f"{at}/images-*.tar")))


def _judged(spark: SparkSession, sf_dir: str, reason: Column) -> DataFrame:
    own, facts = _pictures(spark, sf_dir)
    return images.first_bad(own, facts, reason, key="doc_id").select("doc_id", "reason")


def _verdict(cases: str) -> str:
    return f"SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'missing' {cases} END AS reason FROM documents"


_UNREAD = "WHEN doc_id % 6 IN (2, 3) THEN 'corrupt'"


@query(_verdict(_UNREAD))
def corrupt_images(spark, sf_dir):
    return _judged(spark, sf_dir, images.corrupt())


# The size of a broken file can be read, as long as its header is whole.
@query(_verdict("WHEN doc_id % 6 = 3 THEN 'corrupt' WHEN doc_id % 6 = 5 THEN 'height' WHEN doc_id % 6 = 4 THEN 'width'"))
def image_dimensions(spark, sf_dir):
    return _judged(spark, sf_dir, images.too_large(20, 20))


@query(_verdict(f"{_UNREAD} WHEN doc_id % 6 = 4 THEN 'width' WHEN doc_id % 6 = 5 THEN 'aspect' WHEN doc_id % 6 = 0 THEN 'pure'"))
def image_shapes(spark, sf_dir):
    return _judged(spark, sf_dir, images.misshapen(36, 5000, 10.0))


def _solid(mode: str):
    def run(spark, sf_dir):
        return _judged(spark, sf_dir, images.solid(mode, 0.5 if mode == "rgb_std_lt" else 0.0))

    run.__name__ = f"solid_{mode}"
    return run


for _mode in ("extrema", "thumb_std", "rgb_std_lt", "global_std_le"):
    query(_verdict(f"{_UNREAD} WHEN doc_id % 6 = 0 THEN 'solid'"))(_solid(_mode))


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS id, doc_id % 7 = 0 OR doc_id % 6 IN (2, 3) AS corrupted, CASE WHEN doc_id % 7 = 0 OR doc_id % 6 IN (2, 3) THEN NULL WHEN doc_id % 6 = 4 THEN 40 WHEN doc_id % 6 = 5 THEN 2 ELSE 8 + doc_id % 5 END AS image_width, "
    r"CASE WHEN doc_id % 7 = 0 OR doc_id % 6 IN (2, 3) THEN NULL ELSE len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) END AS tokens, CASE WHEN doc_id % 7 = 0 OR doc_id % 6 IN (2, 3) THEN NULL ELSE length(text) END AS chars FROM documents"
)
def image_statistics(spark, sf_dir):
    own, facts = _pictures(spark, sf_dir)
    ref = messages.image_reference(F.get("images", F.lit(0)))
    split = own.select(F.col("doc_id").cast("string").alias("id"), ref["shard"].alias("shard"), ref["image_in_tar"].alias("image_in_tar"), "text")
    got = images.row_statistics(split, facts, F.col("text"))
    return got.select("id", "corrupted", F.col("image_width").cast("bigint").alias("image_width"), F.col("gpt_token_count").cast("bigint").alias("tokens"), F.col("gpt_char_count").cast("bigint").alias("chars"))


@query("SELECT doc_id, CASE WHEN doc_id % 6 IN (2, 3) THEN NULL WHEN doc_id % 6 = 4 THEN 40 WHEN doc_id % 6 = 5 THEN 2 ELSE 8 + doc_id % 5 END AS width, CASE WHEN doc_id % 6 IN (2, 3) THEN NULL ELSE 'RGB' END AS mode FROM documents")
def normalised_images(spark, sf_dir):
    @F.arrow_udf("struct<width: int, mode: string>")
    def seen(data: pa.Array) -> pa.Array:
        got = [png.header(x) if x is not None else (None, None, None, None) for x in data.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.string())], names=["width", "mode"])

    own = table(spark, sf_dir, "documents").select("doc_id", images.normalised_png(drawn("doc_id")).alias("data"))
    return own.select("doc_id", seen("data").alias("s")).select("doc_id", F.col("s.width").cast("bigint").alias("width"), "s.mode")


def _policy(policy: str):
    def run(spark, sf_dir):
        own, facts = _pictures(spark, sf_dir)
        bad = images.first_bad(own, facts, F.lit(None).cast("string"), key="doc_id")
        return images.missing_image_policy(bad, F.coalesce(F.col("reason") == "missing", F.lit(False)), policy).select("doc_id")

    run.__name__ = f"missing_images_{policy}"
    return run


query("SELECT doc_id FROM documents")(_policy("keep"))
query("SELECT doc_id FROM documents WHERE doc_id % 7 <> 0")(_policy("drop"))


@query("SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN octet_length(encode(url)) END AS size FROM pages")
def loose_images(spark, sf_dir):
    """Files beside rows; of every third row there is none, or the path leads elsewhere."""
    at = folder(spark, "loose")
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("name"), F.col("url").cast("binary").alias("image"), F.lit("html").alias("code_language"), F.lit("").alias("code"))
    records.write_folder(pages.where("page_id % 3 <> 0"), at).write.format("noop").mode("overwrite").save()
    path = F.when(F.col("page_id") % 6 == 3, F.concat(F.lit("../codes/"), "name", F.lit(".html"))).otherwise(F.concat("name", F.lit(".png")))
    return images.loose_images(pages.select("page_id", path.alias("image")), f"{at}/images").select("page_id", F.length("data").cast("bigint").alias("size"))


# Messages and fences.


@query(r"SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN trim(text, chr(10)) WHEN 1 THEN 'before ```html' || chr(10) || 'x```' ELSE '```x' END AS inner FROM documents WHERE NOT (doc_id % 3 = 0 AND (text LIKE '%```%' OR text <> trim(text, chr(10))))")
def outer_fence(spark, sf_dir):
    """A text that is one block loses its fence; anything else stays as it is."""
    given = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("```html\n"), "text", F.lit("\n```"))).when(F.col("doc_id") % 3 == 1, F.lit("before ```html\nx```")).otherwise(F.lit("```x"))
    docs = table(spark, sf_dir, "documents").where("NOT (doc_id % 3 = 0 AND (text LIKE '%```%' OR text <> trim(BOTH '\n' FROM text)))")
    return docs.select("doc_id", code_text.strip_outer(given).alias("inner"))


@query("SELECT conv_id, trim(arg_min(text, turn) FILTER (role = 'user' AND text <> ''), chr(32) || chr(10) || chr(13) || chr(9)) AS prompt FROM conversations GROUP BY 1")
def first_user_prompt(spark, sf_dir):
    return chats(spark, sf_dir).select("conv_id", messages.first_user_prompt(F.col("messages")).alias("prompt"))


@query("SELECT doc_id, 'Translate ' || source || ' into ' || lang || ', ' || source || '.' AS prompt FROM documents")
def prompt_template(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", messages.prompt_from("Translate {task} into {language}, {task}.", F.col("source"), F.col("lang")).alias("prompt"))


@query("SELECT doc_id, 'human:' || 'Say it.' || '|gpt:' || text AS turns FROM documents")
def created_conversation(spark, sf_dir):
    shown = F.transform(messages.conversation("Say it.", F.col("text")), lambda t: F.concat(t["from"], F.lit(":"), t["value"]))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(shown, "|").alias("turns"))


@query("WITH u AS (SELECT conv_id, min(turn) FILTER (role = 'user') AS first, max(turn) FILTER (role = 'user') AS last FROM conversations GROUP BY 1), o AS (SELECT c.conv_id, c.turn, c.text, u.first FROM conversations c JOIN u ON u.conv_id = c.conv_id) SELECT conv_id, 'fixed' AS which, string_agg(CASE WHEN turn = first THEN 'Fixed.' ELSE text END, '|' ORDER BY turn) AS contents FROM o GROUP BY 1 UNION ALL SELECT conv_id, 'own', string_agg(CASE WHEN turn = first THEN 'Own ' || conv_id ELSE text END, '|' ORDER BY turn) FROM o GROUP BY 1")
def both_prompts(spark, sf_dir):
    own, fixed = convert.both_prompts(chats(spark, sf_dir), "Fixed.", F.concat(F.lit("Own "), F.col("conv_id").cast("string")))
    shown = F.array_join(F.transform("messages", lambda m: m["content"]), "|")
    return own.select("conv_id", F.lit("own").alias("which"), shown.alias("contents")).union(fixed.select("conv_id", F.lit("fixed"), shown))


@query("SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'assistant' ELSE role END || ':' || text, '|' ORDER BY turn) AS turns, 'images-00000.tar/p' || conv_id || '.png' AS image FROM conversations GROUP BY 1")
def conversion_round_trip(spark, sf_dir):
    """Chat rows to sharded conversation rows, and back."""
    chat = chats(spark, sf_dir).select("messages", F.array(F.concat(F.lit("images-00000.tar/p"), F.col("conv_id").cast("string"), F.lit(".png"))).alias("images"))
    back = convert.chat_from_conversations(convert.sharded_conversations(chat))
    shown = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")
    return back.select(F.regexp_extract("id", r"(\d+)", 1).cast("bigint").alias("conv_id"), shown.alias("turns"), F.get("images", F.lit(0)).alias("image"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) AS tokens, CASE WHEN len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) > 200 THEN 'too_long' END AS reason FROM documents")
def document_token_limit(spark, sf_dir):
    got = images.token_limit(table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"), 200)
    return got.select("doc_id", F.col("tokens").cast("bigint").alias("tokens"), "reason")


# Sources: what each keeps, and why it rejects.


def _by_reason(source: ingest.Source, df: DataFrame) -> DataFrame:
    kept, rejected = ingest.ingested(df, source, F.col("n"))
    return rejected.select("reason", F.col("count").alias("n")).union(kept.groupBy(F.lit("kept")).count())


def _told(cases: str, where: str = "documents") -> str:
    return f"SELECT reason, count(*) AS n FROM (SELECT CASE {cases} ELSE 'kept' END AS reason FROM {where}) GROUP BY 1"


def _with_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("n"), "lang", "text", F.when(F.col("doc_id") % 4 != 0, drawn(F.col("doc_id") * 6 + 1)).alias("image"))


@query(_told(r"WHEN doc_id % 4 = 0 THEN 'no_image' WHEN NOT regexp_matches(text, '\S') THEN 'empty_text'"))
def source_web_pages(spark, sf_dir):
    return _by_reason(ingest.web_pages(), _with_image(spark, sf_dir))


@query(_told(r"WHEN lang <> 'en' THEN 'language' WHEN doc_id % 4 = 0 THEN 'no_image' WHEN NOT regexp_matches(text, '\S') THEN 'empty_text'"))
def source_web_code(spark, sf_dir):
    return _by_reason(ingest.web_code("en"), _with_image(spark, sf_dir))


@query(_told(r"WHEN page_id % 5 = 0 THEN 'not_single_round' WHEN NOT (regexp_matches(html, '(?i)^\s*<(!DOCTYPE\s+html|html)') AND regexp_matches(html, '(?i)</html>\s*$')) THEN 'invalid_html' WHEN page_id % 4 = 0 THEN 'no_image'", "pages"))
def source_instructions(spark, sf_dir):
    turns = messages.conversation("Write it.", F.col("html"))
    pages = table(spark, sf_dir, "pages")
    return _by_reason(ingest.instructions(), pages.select(F.col("page_id").alias("n"), F.when(F.col("page_id") % 5 == 0, F.slice(turns, 1, 1)).otherwise(turns).alias("conversations"), F.when(F.col("page_id") % 4 != 0, drawn(F.col("page_id") * 6 + 1)).alias("image")))


@query("WITH a AS (SELECT conv_id, bool_or(role = 'assistant' AND regexp_matches(text, '\\S')) AS answered FROM conversations GROUP BY 1) SELECT reason, count(*) AS n FROM (SELECT CASE WHEN conv_id % 3 = 0 THEN 'category' WHEN conv_id % 4 = 0 THEN 'no_image' WHEN NOT answered THEN 'empty_response' ELSE 'kept' END AS reason FROM a) GROUP BY 1")
def source_multimodal_code(spark, sf_dir):
    own = chats(spark, sf_dir).select(F.col("conv_id").alias("n"), "messages", F.when(F.col("conv_id") % 3 == 0, "svg").otherwise("HTML").alias("category"), F.when(F.col("conv_id") % 4 != 0, drawn(F.col("conv_id") * 6 + 1)).alias("image"))
    return _by_reason(ingest.multimodal_code("html"), own)


@query(_told(r"WHEN page_id % 4 = 0 THEN 'no_image' WHEN page_id % 5 = 0 THEN 'empty_code' WHEN NOT (regexp_matches(html, '(?i)^\s*<(!DOCTYPE\s+html|html)') AND regexp_matches(html, '(?i)</html>\s*$')) THEN 'invalid_html'", "pages"))
def source_parquet_pages(spark, sf_dir):
    block = F.when(F.col("page_id") % 5 == 0, "```html\n```").otherwise(F.concat(F.lit("```html\n"), "html", F.lit("\n```")))
    own = table(spark, sf_dir, "pages").select(F.col("page_id").alias("n"), block.alias("assistant_content"), F.when(F.col("page_id") % 4 != 0, drawn(F.col("page_id") * 6 + 1)).alias("image"))
    return _by_reason(ingest.parquet_pages(True), own)


@query(_told("WHEN page_id % 9 = 0 THEN 'no_image_path' WHEN page_id % 5 = 0 THEN 'empty_code' WHEN page_id % 2 <> 0 THEN 'missing_member'", "pages"))
def source_archives(spark, sf_dir):
    member = F.concat(F.lit("root/images/p"), F.col("page_id").cast("string"), F.lit(".html"))
    own = table(spark, sf_dir, "pages").select(F.col("page_id").alias("n"), F.when(F.col("page_id") % 9 != 0, member).alias("image_path"), F.when(F.col("page_id") % 5 != 0, F.col("html")).otherwise(" ").alias("code"), _archive())
    found = records.zip_members(own, _archives(spark, sf_dir)[0], "image_path", "archive").drop("archive")
    return _by_reason(ingest.archives(), found.withColumn("image", F.when(F.col("data").isNotNull(), drawn(F.col("n") * 6 + 1))).drop("data"))


# Profiles and reports.


@query("SELECT CAST(sum(n_chars) AS BIGINT) AS n_chars, CAST(sum(n_chars * 2) AS BIGINT) AS doubled FROM documents")
def byte_savings(spark, sf_dir):
    return profile.byte_savings(table(spark, sf_dir, "documents").withColumn("doubled", F.col("n_chars") * 2), "n_chars", "doubled")


@query("SELECT reason, doc_id FROM (SELECT doc_id, CASE WHEN lang <> 'en' THEN 'language' WHEN length(text) < 300 THEN 'short' END AS reason FROM documents) WHERE reason IS NOT NULL")
def skipped_entries(spark, sf_dir):
    """The entries of a skip report, a row each."""
    checks = [("language", F.col("lang") == "en"), ("short", F.length("text") >= 300)]
    return rows.skipped_entries(table(spark, sf_dir, "documents").withColumn("reason", rows.first_failing(checks)), F.col("doc_id")).select("reason", F.col("entry").alias("doc_id"))


@query("WITH d AS (SELECT doc_id, n_chars, n_chars / 1000.0 AS ratio FROM documents WHERE lang = 'en'), t AS (SELECT * FROM d ORDER BY ratio DESC, doc_id LIMIT 10) SELECT (SELECT round(avg(ratio), 6) FROM d) AS mean_ratio, doc_id, ratio FROM t")
def kept_ratio_report(spark, sf_dir):
    """The mean ratio of what is kept, and the ten best examples."""
    kept = table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", (F.col("n_chars") / 1000.0).alias("ratio"))
    got = profile.kept_report(kept, "ratio", F.asc("doc_id"))
    return got.select(F.round("mean_ratio", 6).alias("mean_ratio"), "doc_id", "ratio")


@query("SELECT mode, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percent FROM (SELECT CASE WHEN doc_id % 7 = 0 OR doc_id % 6 IN (2, 3) THEN NULL ELSE 'RGB' END AS mode FROM documents) GROUP BY 1")
def mode_counts(spark, sf_dir):
    own, facts = _pictures(spark, sf_dir)
    ref = messages.image_reference(F.get("images", F.lit(0)))
    split = own.select(F.col("doc_id").cast("string").alias("id"), ref["shard"].alias("shard"), ref["image_in_tar"].alias("image_in_tar"), "text")
    return rows.counted(images.row_statistics(split, facts, F.col("text")).select(F.col("image_mode").alias("mode")), "mode")


@query("SELECT count(*) AS n_rows, CAST(min(n_chars) AS DOUBLE) AS least, CAST(max(n_chars) AS DOUBLE) AS most, round(avg(n_chars), 6) AS mean FROM documents")
def statistics_sink(spark, sf_dir):
    """Statistics written as lines and as one summary, and both read back."""
    at = folder(spark, "statistics")
    profile.write_statistics(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), f"file://{at}", "n_chars")
    n = spark.read.json(f"file://{at}/stats.jsonl").agg(F.count("*").alias("n_rows"))
    s = spark.read.json(f"file://{at}/summary.json").where("field = 'n_chars'").select(F.col("min").alias("least"), F.col("max").alias("most"), F.round("mean", 6).alias("mean"))
    return n.crossJoin(s)


@query("SELECT doc_id FROM documents WHERE doc_id < 100000")
def numbered_subset(spark, sf_dir):
    return rows.subset(rows.numbered(table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id"))).select("doc_id")


@query("SELECT 'rejected' AS part, doc_id FROM documents WHERE lang <> 'en' UNION ALL SELECT 'kept', doc_id FROM documents WHERE lang = 'en'")
def rejects_routed(spark, sf_dir):
    own = table(spark, sf_dir, "documents").select("doc_id", "lang").withColumn("reason", rows.first_failing([("language", F.col("lang") == "en")]))
    kept, rejected = rows.rejects(own)
    return rejected.select(F.lit("rejected").alias("part"), "entry.doc_id").union(kept.select(F.lit("kept"), "doc_id"))


@query("SELECT doc_id, doc_id + 1000 AS idx, printf('web_%06d', doc_id + 1000) AS id FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_id FROM documents)")
def start_index(spark, sf_dir):
    own = rows.sharded(rows.numbered(table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id")), "web", start=1000)
    return own.select(F.col("pos").alias("doc_id"), "idx", "id")


@query(rf"SELECT page_id, len(regexp_extract_all(regexp_replace(html, '(?s)(<(?:style|script)[^>]*>).*?(</(?:style|script)>)', '\1\2', 'g'), '<[a-zA-Z][^>]*>')) AS total_tags FROM pages")
def page_tags(spark, sf_dir):
    from marlspan.functions.markup import value_density

    return table(spark, sf_dir, "pages").select("page_id", value_density("html").alias("d")).select("page_id", F.col("d.total_tags").cast("bigint").alias("total_tags"))


# Rewriters and generators.

_BLOCK = "('" + "', '".join(sorted(BLOCKS)) + "')"
_LEFT, _RIGHT = r"lower(regexp_extract(p[i - 1], '<?/?(\w+)[^<>]*$', 1))", r"lower(regexp_extract(p[i], '^/?(\w+)', 1))"


@query(
    rf"""WITH s AS (SELECT page_id, string_split(html, '><') AS p FROM pages)
SELECT page_id, array_to_string(list_transform(range(1, len(p) + 1), lambda i: CASE WHEN i = 1 THEN p[1]
WHEN regexp_matches(p[i - 1], '(?i)!doctype[^<>]*$') OR (regexp_matches(p[i - 1], '(^|<)/?\w[^<>]*$') AND {_RIGHT} <> '' AND ({_LEFT} IN {_BLOCK} OR {_RIGHT} IN {_BLOCK})) THEN '><' || p[i]
ELSE '>' || chr(32) || chr(10) || '<' || p[i] END), '') AS html FROM s"""
)
def rewrite_whitespace_gaps(spark, sf_dir):
    """White space is put between all tags: it goes where one of them is a block, and after the doctype."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.replace("html", F.lit("><"), F.lit("> \n<")).alias("html"))
    return rewrites.rewrite(pages, "html", "whitespace").select("page_id", "html")


_HOWS = ("class_names", "css_first", "human_readable", "max_compression", "whitespace")


@query(
    " UNION ALL ".join(
        f"SELECT '{how}' AS how, page_id, page_id % 4 = 0{' OR page_id % 4 = 3' if how in ('human_readable', 'whitespace', 'css_first') else ''} AS processed, "
        f"CASE page_id % 4 WHEN 1 THEN 'no_gpt_response' WHEN 2 THEN 'no_html_content' {'' if how in ('human_readable', 'whitespace', 'css_first') else 'WHEN 3 THEN ' + chr(39) + 'no_style_tags' + chr(39)} END AS reason FROM pages"
        for how in _HOWS
    )
)
def rewrite_reasons(spark, sf_dir):
    """What each rewriter skips, and why: a missing response, one that is no page, one without styles."""
    kind = F.col("page_id") % 4
    given = F.when(kind == 0, F.col("html")).when(kind == 1, "").when(kind == 2, "plain text").otherwise("<html><body>x</body></html>")
    pages = table(spark, sf_dir, "pages").select("page_id", given.alias("html"))
    parts = [rewrites.rewrite(pages, "html", how).select(F.lit(how).alias("how"), "page_id", "processed", "reason") for how in _HOWS]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


_GENERATORS = (*preferences.DISPATCHERS, "semantic_2", "semantic_8", "semantic_16", "combined", "combined_equal_share")


@query(
    " UNION ALL ".join(
        f"SELECT '{how}' AS how, page_id, CASE page_id % 3 WHEN 1 THEN 'no_user_message' WHEN 2 THEN 'no_assistant_response' END AS reason, CASE WHEN page_id % 3 = 0 THEN true END AS differs, "
        f"CASE WHEN page_id % 3 = 0 THEN {'NULL' if how.startswith('combined') else chr(39) + ('semantic' if how.startswith('semantic') else 'repetition') + chr(39)} END AS mode FROM pages"
        for how in _GENERATORS
    )
)
def preference_reasons(spark, sf_dir):
    """Of every generator: what it skips, that what it rejects differs from what it was given, and its kind."""
    kind = F.col("page_id") % 3
    page = F.concat(F.lit(_PAGE), F.col("url"), F.lit("\n</body>\n</html>"))
    pages = table(spark, sf_dir, "pages").select("page_id", F.when(kind != 1, F.col("url")).alias("ask"), F.when(kind != 2, page).alias("answer"))
    out = None
    for how in _GENERATORS:
        got = preferences.pairs(pages, "page_id", F.col("ask"), F.col("answer"), how, rate=1.0)
        one = got.select(F.lit(how).alias("how"), "page_id", "reason", (F.col("rejected_response") != F.col("response")).alias("differs"), (F.lit(None) if how.startswith("combined") else F.col("rejection_mode")).cast("string").alias("mode"))
        out = one if out is None else out.union(one)
    return out


_PAGE = "<!DOCTYPE html>\n<html>\n<head>\n<style>\np { color: #112233; margin: 10px; padding: 4px; }\n.card { background: #abcdef; width: 200px; }\n.row { border: 1px solid #00ff00; font-size: 12px; }\n</style>\n</head>\n<body>\n" + "".join(f"<div class='card row'>\n<h2>part {i}</h2>\n<p>first of {i}</p>\n<p>second of {i}</p>\n</div>\n" for i in range(12))
