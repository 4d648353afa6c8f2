"""Run a query over a folder of tables, or one operator over one dataset.

    python -m marlspan query NAME TABLES OUT
    python -m marlspan rewrite HOW IN OUT [--column html]
    python -m marlspan prefer HOW IN OUT [--key page_id --query url --response html --seed 42 --rate 0.7 --axes colour,size]
    python -m marlspan curate IN OUT [--key page_id --profile balanced --per-cluster 1 --top -1 --quality C --image C --missing keep]
    python -m marlspan images SHARDS OUT [--hash phash --no-pixels]
    python -m marlspan summary IN OUT COLUMN...

IN and OUT are parquet, or JSON lines where their names end so.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspan.functions.hashes import IMAGE_HASHES
from marlspan.operators import images, near_pages, preferences, profile, rewrites
from marlspan.plans import catalog
from marlspan.sources import tars

_LINES = (".json", ".jsonl")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="marlspan", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="what", required=True)
    q = sub.add_parser("query")
    q.add_argument("name", choices=sorted(catalog.QUERIES))
    q.add_argument("input")
    q.add_argument("out")
    q = sub.add_parser("rewrite")
    q.add_argument("how", choices=sorted(rewrites.REWRITERS))
    q.add_argument("input")
    q.add_argument("out")
    q.add_argument("--column", default="html")
    q = sub.add_parser("prefer")
    q.add_argument("how")
    q.add_argument("input")
    q.add_argument("out")
    for name, default in (("key", "page_id"), ("query", "url"), ("response", "html")):
        q.add_argument(f"--{name}", default=default)
    q.add_argument("--seed", type=int, default=42)
    q.add_argument("--rate", type=float, default=0.7)
    q.add_argument("--axes")
    q = sub.add_parser("curate")
    q.add_argument("input")
    q.add_argument("out")
    q.add_argument("--key", default="page_id")
    q.add_argument("--profile", default="balanced", choices=sorted(near_pages.PROFILES))
    q.add_argument("--per-cluster", type=int, default=1)
    q.add_argument("--top", type=int, default=-1)
    q.add_argument("--quality")
    q.add_argument("--image")
    q.add_argument("--missing", default="keep", choices=("keep", "drop", "fail"))
    q = sub.add_parser("images")
    q.add_argument("input")
    q.add_argument("out")
    q.add_argument("--hash", choices=sorted(IMAGE_HASHES))
    q.add_argument("--no-pixels", action="store_true")
    q = sub.add_parser("summary")
    q.add_argument("input")
    q.add_argument("out")
    q.add_argument("columns", nargs="+")
    return p


def made(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.what == "query":
        return catalog.QUERIES[a.name](spark, a.input)
    if a.what == "images":
        return images.image_facts(tars.read_shards(spark, a.input), a.hash, not a.no_pixels)
    df = spark.read.json(a.input) if a.input.rstrip("/").endswith(_LINES) else spark.read.parquet(a.input)
    if a.what == "rewrite":
        return rewrites.rewrite(df, a.column, a.how)
    if a.what == "prefer":
        return preferences.pairs(df, a.key, F.col(a.query), F.col(a.response), a.how, seed=a.seed, rate=a.rate, axes=a.axes)
    if a.what == "curate":
        return near_pages.curated(df, a.key, a.per_cluster, a.profile, a.top, a.quality, a.image, a.missing)
    return profile.summary(df, *a.columns)


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    spark = SparkSession.builder.appName(f"marlspan-{a.what}").getOrCreate()
    made(spark, a).write.format("json" if a.out.rstrip("/").endswith(_LINES) else "parquet").mode("errorifexists").save(a.out)


if __name__ == "__main__":
    main()
