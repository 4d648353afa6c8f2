"""The named queries over the driver's tables, and the SQL that each must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspan.functions import code_text, messages
from marlspan.functions.hashes import bands, hamming, page_simhash
from marlspan.functions.markup import value_density
from marlspan.operators import images, near_pages, preferences, profile, rewrites, rows
from marlspan.shared import shared_dir
from marlspan.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its oracle where SQL can express it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat rows: the turns of each conversation in order."""
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    folded = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return folded.select("conv_id", F.transform("t", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select("conv_id", "messages", messages.as_conversations(F.col("messages")).alias("conversations"))


_VALID = r"regexp_matches(html, '(?i)^\s*<(!DOCTYPE\s+html|html)') AND regexp_matches(html, '(?i)</html>\s*$')"


@query(f"SELECT page_id, length(html) AS n_chars, {_VALID} AS valid FROM pages")
def html_validity(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.length("html").cast("bigint").alias("n_chars"), code_text.valid_html(F.col("html")).alias("valid"))


@query("SELECT page_id FROM pages WHERE contains(lower(html), '<html') OR contains(lower(html), '<body')")
def contains_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").where(code_text.holds_html(F.col("html"))).select("page_id")


@query("SELECT doc_id, lang FROM documents WHERE lang = 'fr'")
def language_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("lang = 'fr'").select("doc_id", "lang")


@query("SELECT doc_id FROM documents WHERE lower(source) = 'src3'")
def category_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.lower("source") == "src3").select("doc_id")


@query(r"SELECT doc_id, length(text) AS n FROM documents WHERE regexp_matches(text, '\S')")
def non_empty(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(code_text.filled(F.col("text"))).select("doc_id", F.length("text").cast("bigint").alias("n"))


_FOLDED = "WITH c AS (SELECT conv_id, count(*) AS n, min(turn) AS t0, max(turn) AS t1 FROM conversations GROUP BY 1)"


@query(f"{_FOLDED} SELECT c.conv_id, (SELECT arg_min(text, turn) FROM conversations v WHERE v.conv_id = c.conv_id AND role = 'assistant') AS response FROM c")
def first_response(spark, sf_dir):
    return turns(spark, sf_dir).select("conv_id", messages.first_response(F.col("conversations"), F.col("messages")).alias("response"))


@query(rf"{_FOLDED} SELECT c.conv_id, (SELECT trim(arg_min(text, turn), chr(32) || chr(10) || chr(13) || chr(9)) FROM conversations v WHERE v.conv_id = c.conv_id AND role = 'assistant' AND regexp_matches(text, '\S')) AS response FROM c")
def first_filled_response(spark, sf_dir):
    return chats(spark, sf_dir).select("conv_id", messages.first_filled_response(F.col("messages")).alias("response"))


@query(
    f"{_FOLDED} SELECT c.conv_id, (SELECT arg_max(text, turn) FROM conversations v WHERE v.conv_id = c.conv_id AND role = 'user') AS query, (SELECT arg_max(text, turn) FROM conversations v WHERE v.conv_id = c.conv_id AND role = 'assistant') AS response FROM c"
)
def last_pair(spark, sf_dir):
    m = F.col("messages")
    return chats(spark, sf_dir).select("conv_id", messages.last_of(m, "user").alias("query"), messages.last_of(m, "assistant").alias("response"))


@query("SELECT conv_id, max(CASE WHEN rn = 2 THEN text END) AS value FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) GROUP BY 1")
def second_turn(spark, sf_dir):
    return turns(spark, sf_dir).select("conv_id", messages.second_value(F.col("conversations")).alias("value"))


@query("SELECT conv_id, count(*) = 2 AND arg_min(role, turn) = 'user' AND arg_max(role, turn) = 'assistant' AS single FROM conversations GROUP BY 1")
def single_round(spark, sf_dir):
    return turns(spark, sf_dir).select("conv_id", messages.single_round(F.col("conversations")).alias("single"))


@query("SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END || ':' || length(text), ',' ORDER BY turn) AS turns FROM conversations GROUP BY 1")
def role_remap(spark, sf_dir):
    shown = F.transform("conversations", lambda t: F.concat(t["from"], F.lit(":"), F.length(t["value"]).cast("string")))
    return turns(spark, sf_dir).select("conv_id", F.array_join(shown, ",").alias("turns"))


@query(
    "WITH u AS (SELECT conv_id, min(CASE WHEN role = 'user' THEN turn END) AS first FROM conversations GROUP BY 1) SELECT c.conv_id, string_agg(CASE WHEN c.turn = u.first THEN 'PROMPT' ELSE text END, '|' ORDER BY turn) AS contents FROM conversations c JOIN u ON u.conv_id = c.conv_id GROUP BY 1"
)
def reset_prompt(spark, sf_dir):
    new = messages.with_prompt(F.col("messages"), "PROMPT")
    return chats(spark, sf_dir).select("conv_id", F.array_join(F.transform(new, lambda m: m["content"]), "|").alias("contents"))


@query("SELECT doc_id, source AS shard, doc_id || '.png' AS image_in_tar, CAST(doc_id AS VARCHAR) AS id FROM documents")
def image_references(spark, sf_dir):
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".png"))
    ref = messages.image_reference(path)
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(n) for n, c in ref.items()])


@query(r"SELECT doc_id, trim(text, chr(10)) AS layer, trim(text, chr(32) || chr(10) || chr(9) || chr(13)) AS bare FROM documents")
def fences(spark, sf_dir):
    block = F.concat(F.lit("```html\n"), "text", F.lit("\n```"))
    return table(spark, sf_dir, "documents").select("doc_id", code_text.strip_layer(block).alias("layer"), code_text.first_block(block).alias("bare"))


@query("SELECT doc_id, '```text' || chr(10) || trim(text, chr(32) || chr(10) || chr(9) || chr(13)) || chr(10) || '```' AS code FROM documents")
def ensure_fence(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", code_text.fenced(F.col("text"), "text").alias("code"))


@query(r"SELECT doc_id, array_to_string(regexp_extract_all(regexp_replace(lower(text), 'https?://\S+', ' ', 'g'), '[a-z0-9]+'), ' ') AS tokens FROM documents")
def normalised_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", code_text.normalised(F.col("text")).alias("tokens"))


_CSS = r"regexp_extract(html, '(?s)<style\b[^>]*>(.*?)</style', 1)"


@query(
    rf"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_CSS},
'(?s)/\*.*?\*/', '', 'g'), '\s*\{{\s*', '{{', 'g'), '\s*\}}\s*', '}}', 'g'), '\s*:\s*', ':', 'g'), '\s*;\s*', ';', 'g'), '\s*,\s*', ',', 'g'), ';\s*\}}', '}}', 'g'), '\s+', ' ', 'g')) AS css FROM pages"""
)
def minified_css(spark, sf_dir):
    css = F.regexp_extract("html", r"(?s)<style\b[^>]*>(.*?)</style", 1)
    return table(spark, sf_dir, "pages").select("page_id", code_text.minified_css(css, colours=False).alias("css"))


_IDX = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents WHERE lang = 'en'"


@query(f"WITH n AS ({_IDX}) SELECT doc_id, idx, printf('web_%06d', idx) AS id, printf('images-%05d.tar', idx // 100) AS shard, printf('web_%06d.png', idx) AS member FROM n")
def dense_ids(spark, sf_dir):
    own = rows.numbered(table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id"), F.col("doc_id"))
    return rows.sharded(own, "web", 100).select("doc_id", "idx", "id", "shard", "member")


@query("SELECT doc_id, text AS raw FROM documents WHERE length(text) > 40 ORDER BY doc_id LIMIT 50")
def split_first_n(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("raw"), (F.length("text") > 40).alias("valid"))
    return rows.first_valid(lines, 50, F.col("doc_id")).select("doc_id", "raw")


@query("WITH n AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents) SELECT doc_id FROM n WHERE pos < 100 AND lang = 'en'")
def limit_input(spark, sf_dir):
    own = rows.numbered(table(spark, sf_dir, "documents").select("doc_id", "lang"), F.col("doc_id"))
    return rows.limit_input(own, 100).where("lang = 'en'").select("doc_id")


@query("SELECT doc_id FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 20")
def limit_output(spark, sf_dir):
    return rows.limit_output(table(spark, sf_dir, "documents").where("lang = 'en'"), 20, F.col("doc_id")).select("doc_id")


def _quantiles(c: str) -> str:
    parts = ", ".join(f"round(quantile_cont({c}, {p / 100}), 6) AS p{p}" for p in profile.PERCENTILES)
    return f"SELECT '{c}' AS field, count({c}) AS count, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, round(median({c}), 6) AS median, {parts} FROM lineitem"


@query(" UNION ALL ".join(_quantiles(c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def numeric_summary(spark, sf_dir):
    got = profile.summary(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", "l_discount")
    whole = {c: F.round(c, 6).alias(c) for c in got.columns if c not in ("field", "count", "min", "max")}
    return got.select(*[whole.get(c, F.col(c)) for c in got.columns])


@query("SELECT role, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM conversations), 2) AS percent FROM conversations GROUP BY 1")
def role_counts(spark, sf_dir):
    return rows.counted(table(spark, sf_dir, "conversations"), "role")


_REASON = "CASE WHEN lang <> 'en' THEN 'language' WHEN NOT regexp_matches(text, '\\S') THEN 'empty' WHEN length(text) < 300 THEN 'short' END"


def _reasons(df: DataFrame) -> DataFrame:
    checks = [("language", F.col("lang") == "en"), ("empty", code_text.filled(F.col("text"))), ("short", F.length("text") >= 300)]
    return df.withColumn("reason", rows.first_failing(checks))


@query(f"SELECT doc_id, {_REASON} AS reason FROM documents")
def first_failing_reason(spark, sf_dir):
    return _reasons(table(spark, sf_dir, "documents")).select("doc_id", "reason")


@query(f"SELECT reason, count(*) AS n FROM (SELECT {_REASON} AS reason FROM documents) WHERE reason IS NOT NULL GROUP BY 1")
def skip_counts(spark, sf_dir):
    report = rows.skip_report(_reasons(table(spark, sf_dir, "documents")))
    return report.select(F.explode("skip_reasons").alias("reason", "n"))


@query("WITH q AS (SELECT d.doc_id, d.source, l.quality, d.n_chars FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quality DESC NULLS LAST, n_chars DESC, doc_id) AS rank FROM q) SELECT doc_id, source, quality, rank FROM r WHERE rank <= 3")
def top_k_of_each(spark, sf_dir):
    own = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return rows.top_of_each(own, "source", 3, F.desc_nulls_last("quality"), F.desc("n_chars"), F.asc("doc_id")).select("doc_id", "source", "quality", "rank")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def top_n(spark, sf_dir):
    return rows.top(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), 25, F.desc("n_chars"), F.asc("doc_id"))


@query("WITH e AS (SELECT doc_id FROM documents WHERE lang = 'en'), m AS (SELECT i FROM range(0, (SELECT max(doc_id) + 11 FROM documents)) t(i) WHERE i NOT IN (SELECT doc_id FROM e)), g AS (SELECT i, i - row_number() OVER (ORDER BY i) AS k FROM m) SELECT min(i) AS first, max(i) AS last, count(*) AS n FROM g GROUP BY k")
def missing_ranges(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    last = docs.agg(F.max("doc_id")).first()[0] + 10
    return rows.missing_ranges(docs.where("lang = 'en'").select(F.col("doc_id").alias("idx")), last)


@query("WITH m AS (SELECT l_orderkey // 64 AS shard_no, l_orderkey AS idx, l_linenumber AS pos0, row_number() OVER (PARTITION BY l_orderkey // 64 ORDER BY l_orderkey, l_linenumber) - 1 AS place FROM lineitem), s AS (SELECT shard_no, count(*) AS n, min(CASE WHEN idx <> shard_no * 64 + place THEN place END) AS first_divergence FROM m GROUP BY 1) SELECT shard_no, n, first_divergence, CASE WHEN n > 64 THEN 'too many' WHEN n < 64 AND shard_no < (SELECT max(shard_no) FROM s) THEN 'incomplete' ELSE 'out of sequence' END AS problem FROM s WHERE n > 64 OR (n < 64 AND shard_no < (SELECT max(shard_no) FROM s)) OR first_divergence IS NOT NULL")
def sequence_verify(spark, sf_dir):
    own = table(spark, sf_dir, "lineitem").select(F.floor(F.col("l_orderkey") / 64).cast("bigint").alias("shard_no"), F.col("l_orderkey").alias("idx"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"))
    return rows.sequence_errors(own, 64)


_SIGN = "list_sum(list_transform(range(0, 62), lambda i: CASE WHEN embedding[i + 1] > 0 THEN CAST(1 AS BIGINT) << i ELSE 0 END))"


def _signs(spark, sf_dir):
    bit = F.transform(F.sequence(F.lit(0), F.lit(61)), lambda i: F.when(F.get("embedding", i) > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.aggregate(bit, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("h"))


@query(f"WITH s AS (SELECT vec_id, CAST({_SIGN} AS BIGINT) AS h FROM embeddings) SELECT vec_id, h, i AS band, (h >> (16 * i)) & 65535 AS key FROM s, range(0, 4) t(i)")
def hash_bands(spark, sf_dir):
    return _signs(spark, sf_dir).select("vec_id", "h", F.inline(bands("h"))).select("vec_id", "h", F.col("band").cast("bigint").alias("band"), F.col("key").cast("bigint").alias("key"))


@query(f"WITH s AS (SELECT vec_id, CAST({_SIGN} AS BIGINT) AS h FROM embeddings), p AS (SELECT a.vec_id AS a, b.vec_id AS b, bit_count(xor(a.h, b.h)) AS distance, a.h AS x, b.h AS y FROM s a JOIN s b ON a.vec_id < b.vec_id) SELECT a, b, CAST(distance AS INT) AS distance FROM p WHERE distance <= 24 AND ((x & 65535) = (y & 65535) OR ((x >> 16) & 65535) = ((y >> 16) & 65535) OR ((x >> 32) & 65535) = ((y >> 32) & 65535) OR ((x >> 48) & 65535) = ((y >> 48) & 65535))")
def band_pairs(spark, sf_dir):
    pairs = near_pages.candidate_pairs(_signs(spark, sf_dir), "vec_id", ["h"])
    return pairs.select("a", "b", hamming("a_h", "b_h").alias("distance")).where("distance <= 24").distinct()


@query("SELECT doc_id, 'first' AS part FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, 'second' FROM documents WHERE lang <> 'en'")
def union_all(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.where("lang = 'en'").select("doc_id", F.lit("first").alias("part")).unionByName(d.where("lang <> 'en'").select("doc_id", F.lit("second").alias("part")))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def set_difference(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN l.quality = 0 THEN 'bad' END AS reason FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def lookup_reason(spark, sf_dir):
    own = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("k"), "quality"), F.col("doc_id") == F.col("k"), "left")
    return own.select("doc_id", F.when(F.col("k").isNull(), "missing").when(F.col("quality") == 0, "bad").alias("reason"))


@query("SELECT event_type, count(*) AS n, count(props) AS with_props, round(sum(value), 4) AS total FROM events GROUP BY 1")
def event_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count("props").alias("with_props"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT (SELECT count(*) FROM documents) AS n_rows, (SELECT count(*) FROM labels) AS n_members, (SELECT count(*) FROM documents) = (SELECT count(*) FROM labels) AS equal")
def verify_output(spark, sf_dir):
    return profile.verification(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def page_density(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", value_density("html").alias("d")).select("page_id", "d.*")


@query()
def top_dense_pages(spark, sf_dir):
    """Valid pages by density, tags and id: the first 100."""
    valid = table(spark, sf_dir, "pages").where(code_text.valid_html(F.col("html")))
    scored = valid.select("page_id", value_density("html").alias("d")).select("page_id", "d.*").where("total_tags >= 1")
    return rows.top(scored, 100, F.desc("ratio"), F.desc("total_tags"), F.asc("page_id"))


@query()
def page_hashes(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", page_simhash("html").alias("h")).select("page_id", "h.*")


@query()
def near_page_curation(spark, sf_dir):
    return near_pages.curated(table(spark, sf_dir, "pages"))


def _rewriting(how: str):
    def run(spark, sf_dir):
        return rewrites.rewrite(table(spark, sf_dir, "pages").select("page_id", "html"), "html", how)

    run.__name__ = f"rewrite_{how}"
    return run


for _how in rewrites.REWRITERS:
    query()(_rewriting(_how))


def _preferring(how: str):
    def run(spark, sf_dir):
        ask = F.concat(F.lit("Write the page at "), "url")
        return preferences.pairs(table(spark, sf_dir, "pages"), "page_id", ask, F.col("html"), how)

    run.__name__ = f"prefer_{how}"
    return run


for _how in (*preferences.DISPATCHERS, "semantic_2", "semantic_8", "semantic_16", "combined", "combined_equal_share"):
    query()(_preferring(_how))


@query()
def preference_distribution(spark, sf_dir):
    made = preferences.pairs(table(spark, sf_dir, "pages"), "page_id", F.col("url"), F.col("html"), "combined_equal_share")
    return rows.counted(made.withColumn("kind", F.coalesce("rejection_mode", "reason")), "kind")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def streamed_events(spark, sf_dir):
    """The events table taken as a stream of files, with dense ids; then counted by type."""
    events = table(spark, sf_dir, "events")
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    path = f"{sf_dir}/events.parquet"
    stream = spark.readStream.schema(events.schema).parquet(path if _is_folder(spark, path) else f"{path}*")
    ingest.available_now(stream, f"{folder}/checkpoint", ingest.into_dense_ids(f"{folder}/rows", F.col("event_id"))).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").groupBy("event_type").agg(F.count("idx").alias("n"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


@query()
def token_limit(spark, sf_dir):
    return images.token_limit(chats(spark, sf_dir), messages.first_response(None, F.col("messages")), 100).select("conv_id", "tokens", "reason")


@query()
def page_rows(spark, sf_dir):
    """Pages as chat rows with dense ids and shards, by the rules of web pages but for their images."""
    rules = [("invalid_html", code_text.valid_html(F.col("html"))), ("empty_text", code_text.filled(F.col("html")))]
    kept = rows.numbered(table(spark, sf_dir, "pages").withColumn("reason", rows.first_failing(rules)).where("reason IS NULL"), F.col("page_id"))
    return rows.sharded(kept, "web").select("page_id", "idx", "id", "shard", "member", messages.conversation("Write this page.", F.col("html")).alias("conversations"))


# These register further queries here.
from marlspan.plans import round_trips as _round_trips  # noqa: E402, F401
