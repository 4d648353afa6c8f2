"""Session-level helpers: the shared folder, lineage cuts and size-checked joins."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast; a larger side is joined by shuffle.
BROADCAST_ROWS = 2_000_000
#: Bytes of its plan (of its files, where it was written) up to which it may be broadcast.
BROADCAST_BYTES = 64_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir.

    Only where the setting is absent, in local mode, a temporary folder is used; a cluster must name one that all share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="marlspan-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def cut(df: DataFrame, kept: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, lost executors lose nothing.

    The files are removed when the driver's JVM ends, or, unless they are kept, with the scratch that they are in.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    own = _scratch.get()
    if own is not None and not kept:
        own.append(path)
    df.write.parquet(path)
    fs, at = _file_system(spark, path)
    fs.deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def folder_of(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one for files that tasks map; it is removed as what cut writes is."""
    scheme, _, rest = shared_dir(spark).rpartition(":")
    if scheme not in ("", "file"):
        raise RuntimeError("spark.checkpoint.dir must be a folder of a file system here")
    path = f"/{rest.lstrip('/')}/{name}-{uuid.uuid4().hex}" if rest.startswith("/") else f"{os.path.abspath(rest)}/{name}-{uuid.uuid4().hex}"
    own = _scratch.get()
    if own is not None:
        own.append(path)
    os.makedirs(path)
    fs, at = _file_system(spark, f"file:{path}")
    fs.deleteOnExit(at)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """Tables that are cut within are removed at its end; what is to be read later must be cut as kept."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            fs, at = _file_system(spark, path)
            fs.delete(at, True)


def discard(df: DataFrame) -> None:
    """Remove a table that was cut as kept."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if os.path.basename(folder).startswith("cut-"):
            fs, at = _file_system(df.sparkSession, folder)
            fs.delete(at, True)


def broadcastable(side: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a side of so many rows may be broadcast: by its rows and, where it was written, by its bytes."""
    written = int(str(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows <= limit and (written <= BROADCAST_BYTES or not side.inputFiles() or rows <= 10_000)


def sized_join(df: DataFrame, side: DataFrame, on, how: str, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join a narrow side: broadcast when its counted rows and its bytes stay under the limits, else by shuffle.

    The bytes are known where the side was written; else its rows alone decide.
    """
    small = broadcastable(side, side.count() if rows is None else rows, limit)
    return df.join(F.broadcast(side) if small else side, on, how)


def give_back() -> None:
    """Freed memory goes back to the system, as far as the allocators let go of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def in_slices(run: Callable[..., pa.Array], *columns: pa.Array, rows: int = 200) -> pa.Array:
    """run of a few rows of the columns at a time, put together: Python objects of a whole batch are never in memory.

    Workers wait for their next task with the most memory they held, so what is freed is given back.
    """
    done = [run(*(c.slice(lo, rows) for c in columns)) for lo in range(0, max(1, len(columns[0])), rows)]
    out = done[0] if len(done) == 1 else pa.concat_arrays(done)
    del done
    give_back()
    return out
