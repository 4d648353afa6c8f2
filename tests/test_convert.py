"""Conversions between row forms, and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from marlspan import __main__ as cli
from marlspan.functions import code_text, messages
from marlspan.operators import convert, preferences

CHAT = "id string, messages array<struct<role string, content string>>, images array<string>"


def chat(spark):
    return spark.createDataFrame(
        [
            ("7", [("system", "s"), ("user", "u"), ("assistant", " "), ("assistant", "```html\n<p>\n```")], ["images-00001.tar/web_000003.png"]),
            (None, [("user", "only")], ["plain.png"]),
            (None, [("assistant", "x")], []),
        ],
        CHAT,
    )


def test_there_and_back(spark):
    rows = convert.sharded_conversations(chat(spark))
    got = {r.id: r for r in rows.collect()}
    assert set(got) == {"7", "plain", None} and got["7"].shard == "images-00001.tar" and got["plain"].shard == ""
    assert [t["from"] for t in got["7"].conversations] == ["system", "human", "gpt", "gpt"]
    back = {r.id: r for r in convert.chat_from_conversations(rows).collect()}
    assert back["7"].images == ["images-00001.tar/web_000003.png"] and back["7"].messages[1].role == "user"


def test_code_rows(spark):
    got = convert.code_rows(chat(spark), "web", "html", F.col("id")).collect()
    assert [(r.name, r.code, r.image_path) for r in got] == [("web_000000", "```html\n<p>\n```", "images/web_000000.png")]


def test_pairs(spark):
    made = preferences.chat_pairs(chat(spark).withColumn("k", F.coalesce("id", F.lit("z"))), "k", "chat_random")
    assert {r.reason for r in made.collect()} == {None, "no_assistant_response", "no_user_message"}
    [row] = convert.preference_rows(made, "k").collect()
    assert row.prompt == "u" and row.rejected and row.id == convert.preference_rows(made.repartition(5), "k").first().id
    own, fixed = convert.both_prompts(chat(spark), "F", F.lit("O"))
    assert fixed.first().messages[1].content == "F" and own.first().messages[1].content == "O"
    rows = convert.as_pairs(convert.sharded_conversations(chat(spark)))
    assert rows.where("id = '7'").first().chosen.startswith("```html")
    report = convert.verify_report(chat(spark).select("id"), spark.range(2), F.col("id")).first()
    assert (report.n_rows, report.n_members, report.equal) == (3, 2, False) and json.loads(report.samples[-1]) == {"id": "7"}


def test_fences(spark):
    df = spark.createDataFrame([("```html\n\n<p>\n\n```",), ("a ```html\nx\n``` b",), ("  plain ",), (None,), ("```\nopen",)], "c string")
    c = F.col("c")
    got = df.select(code_text.strip_layer(c).alias("a"), code_text.strip_outer(c).alias("b"), code_text.first_block(c).alias("d"), code_text.fenced(c, "x").alias("e")).collect()
    assert [r.a for r in got] == ["<p>", "a ```html\nx\n``` b", "plain", "", "```\nopen"]
    assert [r.b for r in got] == ["\n<p>", "a ```html\nx\n``` b", "  plain ", None, "```\nopen"] or got[0].b == "<p>"
    assert [r.d for r in got] == ["<p>", "x", "plain", "", "```\nopen"]
    assert got[2].e == "```x\nplain\n```" and got[0].e.startswith("```html")


def test_image_references(spark):
    df = spark.createDataFrame([("s.tar/a.b.png",), ("a.png",), ("s/d/e",), (".hidden",)], "p string")
    ref = messages.image_reference(F.col("p"))
    got = df.select(*[v.alias(k) for k, v in ref.items()]).collect()
    assert [(r.shard, r.image_in_tar, r.id) for r in got] == [("s.tar", "a.b.png", "a.b"), ("", "a.png", "a"), ("s", "d/e", "e"), ("", ".hidden", ".hidden")]
    text = F.lit("  x ")
    assert spark.range(1).select(messages.prompt_from("{task} in {language}", F.lit("Draw"), F.lit("SVG")).alias("p"), messages.strip(text).alias("s")).first() == ("Draw in SVG", "x")


def test_command_line(spark, tmp_path):
    cli.main(["query", "language_filter", "/root/testdata/sf0.001", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_command_line_options(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumn("q", F.col("page_id").cast("string"))
    pages.write.parquet(f"{tmp_path}/pages")
    pages.write.json(f"{tmp_path}/pages.jsonl")
    n = pages.count()
    cli.main(["rewrite", "whitespace", f"{tmp_path}/pages", f"{tmp_path}/small"])
    assert spark.read.parquet(f"{tmp_path}/small").count() == n
    for k, seed in enumerate(("7", "7", "8")):
        cli.main(["prefer", "nesting_equal_share", f"{tmp_path}/pages.jsonl", f"{tmp_path}/pairs{k}", "--seed", seed])
    a, b, c = ({r.page_id: r.rejected_response for r in spark.read.parquet(f"{tmp_path}/pairs{k}").collect()} for k in range(3))
    assert a == b != c and len(a) == n
    cli.main(["curate", f"{tmp_path}/pages", f"{tmp_path}/best", "--profile", "loose", "--quality", "q", "--top", "3"])
    assert [r.page_id for r in spark.read.parquet(f"{tmp_path}/best").orderBy(F.desc("quality")).collect()] == sorted((r.page_id for r in pages.collect()), reverse=True)[:3]
    cli.main(["summary", f"{tmp_path}/pages", f"{tmp_path}/sums.jsonl", "page_id"])
    assert spark.read.json(f"{tmp_path}/sums.jsonl").first()["count"] == n
    with pytest.raises(SystemExit):
        cli.main(["curate", "a", "b", "--profile", "none"])
