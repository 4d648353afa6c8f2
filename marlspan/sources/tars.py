"""Sharded tar archives: a data source whose partitions are a large shard or several small ones, writers, and web datasets."""

from __future__ import annotations

import glob
import io
import os
import re
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SHARD_SIZE = 5000
#: Bytes of shards that a task reads, at most, what opening one counts, and bytes and rows of a batch.
SPLIT, OPEN, BATCH, ROWS = 64_000_000, 64_000, 8_000_000, 2000
SCHEMA = "shard string, member string, pos bigint, size bigint, data binary, error string"


class _Shards(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


def _together(paths: list[str], parts: int) -> list[list[str]]:
    """Shards in order, so many as make a task's work: SPLIT bytes at most, or one; fewer where that gives less than so many parts."""
    size = [os.path.getsize(p) + OPEN for p in paths]
    most = min(SPLIT, max(OPEN, sum(size) / max(1, parts)))
    out: list[list[str]] = []
    room = 0.0
    for p, n in zip(paths, size):
        if n > room:
            out.append([])
            room = most
        out[-1].append(p)
        room -= n
    return out


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.pattern, self.load, self.parts = options["path"], options.get("data", "true"), int(options.get("parts", "1"))

    def partitions(self):
        return [_Shards(own) for own in _together(sorted(glob.glob(self.pattern)), self.parts)] or [_Shards([])]

    def read(self, part: _Shards) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for path in part.paths:
            for row in self.members(path):
                rows.append(row)
                size += len(row[4] or b"")
                if size >= BATCH or len(rows) == ROWS:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)

    def members(self, path: str) -> Iterator[tuple]:
        shard, pos = os.path.basename(path), 0
        try:
            # A stream: members are never all in memory, however large the shard.
            with open(path, "rb") as f, tarfile.open(fileobj=f, mode="r|*") as tar:
                for m in tar:
                    if m.isfile():
                        data = tar.extractfile(m).read() if self.load != "false" else None
                        # Characters, not a prefix, are stripped: ".hidden" loses its dot too.
                        yield shard, m.name.lstrip("./"), pos, m.size, data if self.load == "true" else None, None
                        pos += 1
        except (tarfile.TarError, OSError, EOFError) as e:
            yield shard, None, pos, None, None, type(e).__name__


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


class TarShards(DataSource):
    """spark.read.format("tar_shards").load("dir/images-*.tar"): the members in order; a row with error where a shard breaks off."""

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_shards(spark: SparkSession, pattern: str, data: bool = True, checked: bool = False) -> DataFrame:
    """The members of shards. Without data a shard that breaks off within a member has that one still, unless bytes are checked: read, and not given."""
    spark.dataSource.register(TarShards)
    load = str(data).lower() if data or not checked else "checked"
    return spark.read.format("tar_shards").option("data", load).option("parts", str(4 * spark.sparkContext.defaultParallelism)).load(pattern)


def tar_index(members: DataFrame) -> DataFrame:
    """shard, member and the place of each; of members of one name in a shard the last counts."""
    return members.where("member IS NOT NULL").groupBy("shard", "member").agg(F.max_by("size", "pos").alias("size"), F.max("pos").alias("pos"))


def lookup(members: DataFrame) -> DataFrame:
    """name -> first shard and member: full names, their base names, and chunk_N prefixes of chunk_N_row_M members."""
    m = members.where("member IS NOT NULL").select("shard", "member", "pos")
    base = F.regexp_extract("member", r"([^/]*)$", 1)
    chunk = F.regexp_extract("member", r"(?:^|/)(chunk_\d+)_row_\d+[.][0-9A-Za-z]+$", 1)
    names = m.select(F.explode(F.array_distinct(F.array("member", base, F.when(chunk != "", chunk)))).alias("name"), "shard", "member", "pos").where("name IS NOT NULL")
    return names.groupBy("name").agg(F.min(F.struct("shard", "pos", "member")).alias("at")).select("name", "at.shard", "at.member")


def write_members(members: DataFrame, folder: str, together: bool = False) -> DataFrame:
    """Write (shard_no, idx, member, data) as images-%05d.tar with the members by idx; shard, members, first, last.

    Each shard is one task's work and appears whole, by renaming. together: a shard's rows are in one partition already.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tar = path = None
        done, shard = [], None
        os.makedirs(folder, exist_ok=True)

        def close() -> None:
            if tar is not None:
                tar.close()
                os.replace(tar.name, path)

        for b in batches:
            for s, i, name, data in zip(*(b.column(c).to_pylist() for c in ("shard_no", "idx", "member", "data"))):
                if s != shard:
                    close()
                    shard = s
                    path = f"{folder}/images-{s:05d}.tar"
                    tar = tarfile.open(f"{path}.{uuid.uuid4().hex}", "w")
                    done.append([os.path.basename(path), 0, i, i])
                info = tarfile.TarInfo(name)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                # The archive needs no list of what it holds.
                tar.members.clear()
                done[-1][1] += 1
                done[-1][3] = i
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["shard", "members", "first", "last"])

    rows = members.select(F.col("shard_no").cast("bigint").alias("shard_no"), F.col("idx").cast("bigint").alias("idx"), "member", "data")
    return (rows if together else rows.repartition("shard_no")).sortWithinPartitions("shard_no", "idx").mapInArrow(run, "shard string, members bigint, first bigint, last bigint")


def write_shards(images: DataFrame, folder: str, prefix: str, size: int = SHARD_SIZE) -> DataFrame:
    """Write (idx, data) as images-%05d.tar of `size` members {prefix}_%06d.png, in order; shard, members, first, last."""
    name = F.concat(F.lit(f"{prefix}_"), F.format_string("%06d.png", F.col("idx").cast("bigint")))
    return write_members(images.select(F.floor(F.col("idx") / size).alias("shard_no"), "idx", name.alias("member"), "data"), folder)


def repaired(path: str, prefix: str) -> int:
    """Rewrite a shard with its readable members of the prefix in order of their numbers; how many."""
    pattern = re.compile(re.escape(prefix) + r"_([0-9]{6,})[.]png\Z")
    kept: dict[int, tuple[str, bytes]] = {}
    try:
        with open(path, "rb") as f, tarfile.open(fileobj=f, mode="r|*") as tar:
            for m in tar:
                hit = pattern.match(m.name.lstrip("./"))
                if m.isfile() and hit:
                    data = tar.extractfile(m).read()
                    if len(data) == m.size:
                        kept[int(hit[1])] = (m.name.lstrip("./"), data)
    except (tarfile.TarError, OSError, EOFError):
        pass
    with tarfile.open(f"{path}.{uuid.uuid4().hex}", "w") as out:
        for _, (name, data) in sorted(kept.items()):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            out.addfile(info, io.BytesIO(data))
    os.replace(out.name, path)
    return len(kept)


def web_dataset(members: DataFrame) -> DataFrame:
    """key, html and png: members of one base name without its extension; bytes that aren't UTF-8 are replaced."""
    key, kind = F.regexp_replace("member", r"\.[^./]*$", ""), F.lower(F.regexp_extract("member", r"\.([^./]*)$", 1))
    rows = members.where("member IS NOT NULL").select("shard", key.alias("key"), kind.alias("kind"), "data", "pos")
    pairs = rows.groupBy("shard", "key").agg(F.max_by("data", F.when(F.col("kind") == "html", F.col("pos"))).alias("html"), F.max_by("data", F.when(F.col("kind") == "png", F.col("pos"))).alias("png"))
    return pairs.select("key", F.make_valid_utf8(F.col("html").cast("string")).alias("html"), "png").where("html IS NOT NULL AND png IS NOT NULL")
