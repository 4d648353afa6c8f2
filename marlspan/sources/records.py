"""Line and array JSON, parquet and zip sources with explicit schemas, and their sinks."""

from __future__ import annotations


import json
import os
import shutil
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "__bad"


def with_position(df: DataFrame, *order: Column) -> DataFrame:
    """A dense pos from 0 in the given order. One sort by range, and a count of each range; nothing goes to one task."""
    ranged = df.withColumn("__o", F.struct(*order)).repartitionByRange("__o").sortWithinPartitions("__o")
    tagged = ranged.withColumns({"__p": F.spark_partition_id(), "__i": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    from marlspan.shared import cut

    kept = cut(tagged)
    count = kept.groupBy("__p").agg(F.count("*").alias("__n"))
    before = count.select(F.col("__p").alias("__q"), (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__b"))
    return kept.join(F.broadcast(before), F.col("__p") == F.col("__q")).withColumn("pos", F.col("__b") + F.col("__i")).drop("__o", "__p", "__q", "__i", "__b")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """raw, file, and the fields of each line; blank lines are skipped, `valid` is false where a line isn't JSON."""
    lines = spark.read.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    full = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = lines.where(F.trim("raw") != "").withColumn("row", F.from_json("raw", full, {"columnNameOfCorruptRecord": BAD, "mode": "PERMISSIVE"}))
    return parsed.select("raw", "file", "block", F.col(f"row.{BAD}").isNull().alias("valid"), *[F.col(f"row.{f.name}").alias(f.name) for f in schema.fields])


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The elements of an array in one file or several. One task reads a file: convert large ones once."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The three columns of a parquet source; others aren't read."""
    return spark.read.parquet(path).select("user_content", "assistant_content", "image")


def write_jsonl(df: DataFrame, path: str, keep_null: bool = True) -> None:
    """A JSON object a line, with nulls unless told otherwise, characters unescaped."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(not keep_null).lower()}).alias("value")).write.text(path)


def write_raw(df: DataFrame, path: str) -> None:
    """The lines as they were read."""
    df.select("raw").write.text(path)


def export_array(df: DataFrame, path: str, compact: bool = False) -> int:
    """One file with a JSON array, in the order of the partitions; how many rows.

    Tasks write its parts to the shared folder, which must be one of a file system; the driver joins their bytes.
    """
    from marlspan.shared import folder_of

    at = folder_of(df.sparkSession, "array")

    def text(row: dict) -> str:
        if compact:
            return json.dumps(row, ensure_ascii=False, separators=(",", ":"))
        return "\n  " + json.dumps(row, ensure_ascii=False, indent=2).replace("\n", "\n  ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, name, n = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        with open(f"{at}/{name}", encoding="utf-8", mode="w", newline="") as f:
            for b in batches:
                for lo in range(0, b.num_rows, 1000):
                    for row in b.slice(lo, 1000).to_pylist(maps_as_pydicts="strict"):
                        f.write(("," if n else "") + text(row))
                        n += 1
        yield pa.RecordBatch.from_pylist([{"part": part, "name": name, "n": n}])

    # Of a task that was tried again the part that its rows name counts.
    told = sorted((r.part, r.name, r.n) for r in df.mapInArrow(run, "part bigint, name string, n bigint").collect() if r.n)
    with open(path, "wb") as out:
        out.write(b"[")
        for k, (_, name, _) in enumerate(told):
            out.write(b"," if k else b"")
            with open(f"{at}/{name}", "rb") as f:
                shutil.copyfileobj(f, out, 1 << 20)
            os.remove(f"{at}/{name}")
        out.write(b"]" if compact or not told else b"\n]")
    return sum(n for _, _, n in told)


def _batches(spark: SparkSession, path: str) -> int:
    """How many batches of an array there are."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(s.getPath().getName().startswith("1-batch-") for s in fs.listStatus(p)) if fs.exists(p) else 0


def append_array(df: DataFrame, path: str, *order: Column) -> None:
    """Rows for an array, written by the tasks after those that are there: a run that goes on writes what it has more.

    The files below path, in the order of their names, are one JSON array together (cat path/*/part-*).
    """
    spark = df.sparkSession
    n = _batches(spark, path)
    if not n:
        for name, mark in (("0-open", "["), ("2-close", "]")):
            spark.createDataFrame([(mark,)], "value string").coalesce(1).write.text(f"{path}/{name}")
    begun = any(not spark.read.text(f"{path}/1-batch-{k:05d}").isEmpty() for k in range(n))
    own = with_position(df.select(F.struct(*df.columns).alias("row"), *[c.alias(f"o{i}") for i, c in enumerate(order)]), *[F.col(f"o{i}") for i in range(len(order))])
    line = F.concat(F.when((F.col("pos") == 0) & F.lit(not begun), " ").otherwise(","), F.to_json("row", {"ignoreNullFields": "false"}))
    own.repartitionByRange("pos").sortWithinPartitions("pos").select(line.alias("value")).write.text(f"{path}/1-batch-{n:05d}")


def write_array(df: DataFrame, path: str, *order: Column) -> None:
    """A JSON array of the rows in order, written by the tasks; see append_array."""
    if _batches(df.sparkSession, path):
        raise ValueError(f"{path} has an array already")
    append_array(df, path, *order)


def read_array_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of such an array, read by as many tasks as its size asks for."""
    lines = spark.read.text(f"{path}/1-batch-*").select(F.from_json(F.substring("value", 2, 2_147_483_647), schema).alias("row"))
    return lines.select("row.*")


def zip_members(paths: DataFrame, archive: str, member: str = "member", of: str | None = None) -> DataFrame:
    """paths with data: the bytes of each named member, null where it is missing or the archive can't be read.

    The archive lies in a folder that all executors share, and is opened once a task. Where rows have several, of is
    the column with their archives' names and archive their folder; each is open while rows in a row name it.
    """
    kind = T.StructType([*paths.schema.fields, T.StructField("data", T.BinaryType())])

    def opened(name: str | None) -> zipfile.ZipFile | None:
        try:
            return zipfile.ZipFile(archive if of is None else os.path.join(archive, name)) if name else None
        except (OSError, zipfile.BadZipFile):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, now = None, None
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                names = b.column(member).to_pylist()
                own = b.column(of).to_pylist() if of else [archive] * len(names)
                out: list[bytes | None] = [None] * len(names)
                for i in sorted(range(len(names)), key=lambda i: own[i] or ""):
                    if own[i] != now:
                        if z:
                            z.close()
                        z, now = opened(own[i]), own[i]
                    try:
                        out[i] = z.read(names[i]) if z and names[i] else None
                    except (KeyError, zipfile.BadZipFile, OSError):
                        pass
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "data"])
        if z:
            z.close()

    return paths.mapInArrow(run, kind)


def write_archives(members: DataFrame, folder: str, category: str, root: str = "root/") -> DataFrame:
    """Write (archive, member, data) as zips of the folder, by their names: root + member each, in the order of the names, and the metadata last; archive and members.

    Each archive is one task's work and appears whole, by renaming.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        z, now, done = None, None, []

        def close() -> None:
            if z is not None:
                z.writestr(f"{root}meta_data_{category}.json", json.dumps([{"image_path": n} for n in meta], ensure_ascii=False))
                z.close()
                os.replace(z.filename, f"{folder}/{now}")
                done.append((now, len(meta)))

        for b in batches:
            for name, member, data in zip(*(b.column(c).to_pylist() for c in ("archive", "member", "data"))):
                if name != now:
                    close()
                    z, now, meta = zipfile.ZipFile(f"{folder}/{name}.{uuid.uuid4().hex}", "w", zipfile.ZIP_DEFLATED), name, []
                z.writestr(f"{root}{member}", data)
                meta.append(member)
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["archive", "members"])

    return members.select("archive", "member", "data").repartition("archive").sortWithinPartitions("archive", "member").mapInArrow(run, "archive string, members bigint")


def zip_layouts(archives: DataFrame, folder: str) -> DataFrame:
    """archive, metadata, category and root of each archive of a folder, told by the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told = [{"archive": n, **zip_layout(os.path.join(folder, n))} for n in b.column("archive").to_pylist()]
            yield pa.RecordBatch.from_pylist(told, pa.schema([(c, pa.string()) for c in ("archive", "metadata", "category", "root")]))

    return archives.select("archive").mapInArrow(run, "archive string, metadata string, category string, root string")


def zip_layout(archive: str) -> dict:
    """What an archive says of itself: its metadata member, the category in that name, and the root of its images."""
    with zipfile.ZipFile(archive) as z:
        names = z.namelist()
        meta = next((n for n in sorted(names) if os.path.basename(n).startswith("meta_data_") and n.endswith(".json")), None)
        category = os.path.basename(meta)[len("meta_data_") : -len(".json")] if meta else None
        root = ""
        if meta:
            rows = json.loads(z.read(meta))
            first = next((r["image_path"] for r in rows if r.get("image_path")), None) if isinstance(rows, list) else None
            hit = next((n for n in names if first and n.endswith(first)), None)
            root = hit[: -len(first)] if hit else ""
    return {"metadata": meta, "category": category, "root": root}


def write_zip(rows: DataFrame, path: str, category: str) -> int:
    """images/, codes/ and, last, the metadata; images are stored, texts deflated. Through the driver."""
    meta = []
    with zipfile.ZipFile(path, "w") as z:
        for r in rows.toLocalIterator():
            z.writestr(zipfile.ZipInfo(f"images/{r['name']}.png"), bytes(r["image"]), zipfile.ZIP_STORED)
            z.writestr(f"codes/{r['name']}.{r['code_language']}", r["code"], zipfile.ZIP_DEFLATED)
            meta.append({"source": r["source"], "code_language": r["code_language"], "image_path": f"images/{r['name']}.png", "code": r["code"]})
        z.writestr(f"meta_data_{category}.json", json.dumps(meta, ensure_ascii=False), zipfile.ZIP_DEFLATED)
    return len(meta)


def write_folder(rows: DataFrame, folder: str) -> DataFrame:
    """images/<name>.png and codes/<name>.<language> of each row, written by the tasks; the names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sub in ("images", "codes"):
            os.makedirs(f"{folder}/{sub}", exist_ok=True)
        for b in batches:
            for name, image, language, code in zip(*(b.column(c).to_pylist() for c in ("name", "image", "code_language", "code"))):
                with open(f"{folder}/images/{name}.png", "wb") as f:
                    f.write(image)
                with open(f"{folder}/codes/{name}.{language}", encoding="utf-8", mode="w") as f:
                    f.write(code)
            yield pa.RecordBatch.from_arrays([b.column("name")], names=["name"])

    return rows.select("name", "image", "code_language", "code").mapInArrow(run, "name string")


