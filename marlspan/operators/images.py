"""Filters, statistics and near duplicates of rows with images in tar shards.

Members are read from their shards, measured where they are read, and joined to the rows as small
facts: image bytes are never shuffled.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspan.functions import jpeg, png
from marlspan.functions.hashes import IMAGE_HASHES, lanczos
from marlspan.functions.token_counters import token_count

FACTS = "shard string, member string, corrupted boolean, corruption_reason string, image_width int, image_height int, image_file_size bigint, pixel_std double, rgb_std double, thumb_std double, flat boolean, image_channels int, image_mode string, image_hash bigint"


def reader(data: bytes):
    """The module that reads an image's format: JPEG by its first bytes, else PNG."""
    return jpeg if data[:2] == b"\xff\xd8" else png


def as_png(data: bytes | None) -> bytes | None:
    """An image as an RGB PNG over white; None where it can't be read."""
    if data and reader(data) is jpeg:
        try:
            return png.encode(jpeg.decode(data, rgb=True))
        except png.BadPng:
            return None
    return png.normalised(data)


def measured(shard: str, member: str | None, data: bytes | None, error: str | None, hashed: str | None, pixels: bool) -> tuple:
    """The facts of a member; a shard that breaks off has one row without a member."""
    blank = (None,) * 9
    if error:
        return shard, member, True, f"tar: {error}", *blank, None
    kind = reader(data)
    try:
        w, h, mode, channels = kind.header(data)
    except png.BadPng as e:
        return shard, member, True, str(e), None, None, len(data), *(None,) * 6, None
    if not kind.verified(data):
        return shard, member, True, "verify", w, h, len(data), None, None, None, None, channels, mode, None
    if not pixels:
        return shard, member, False, None, w, h, len(data), None, None, None, None, channels, mode, None
    try:
        own = kind.decode(data)
        rgb = own if kind is png and mode == "RGB" else kind.decode(data, rgb=True)
    except png.BadPng as e:
        return shard, member, True, str(e), w, h, len(data), None, None, None, None, channels, mode, None
    small = np.stack([lanczos(rgb[:, :, c], min(128, h), min(128, w)) for c in range(3)], axis=2)
    flat = bool((own.reshape(-1, own.shape[2]).min(0) == own.reshape(-1, own.shape[2]).max(0)).all())
    return shard, member, False, None, w, h, len(data), float(own.std()), float(rgb.std()), float(small.std()), flat, channels, mode, IMAGE_HASHES[hashed](rgb) if hashed else None


def image_facts(members: DataFrame, hashed: str | None = None, pixels: bool = True) -> DataFrame:
    """Facts of each member; of members of one name in a shard those of the last."""
    names = [f.split()[0] for f in FACTS.split(", ")]
    kinds = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(p, *measured(s, m, d, e, hashed, pixels)) for s, m, d, e, p in zip(*(b.column(c).to_pylist() for c in ("shard", "member", "data", "error", "pos")))]
            cols = list(zip(*rows)) or [()] * (len(names) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *[pa.array(c, kinds[f.split()[1]]) for c, f in zip(cols[1:], FACTS.split(", "))]], names=["pos", *names])

    facts = members.mapInArrow(run, f"pos bigint, {FACTS}")
    last = facts.groupBy("shard", "member").agg(F.max_by(F.struct(*names[2:]), "pos").alias("f"))
    return last.select("shard", "member", "f.*")


def first_bad(rows: DataFrame, facts: DataFrame, reason: Column, key: str = "pos", images: str = "images") -> DataFrame:
    """rows with reason: that of the first image that has one, "missing" where an image isn't in its shard; no images: null.

    reason is an expression over the facts.
    """
    refs = rows.select(key, F.posexplode(images).alias("i", "path"))
    slash = F.locate("/", "path")
    refs = refs.select(key, "i", F.when(slash > 0, F.expr("substring(path, 1, locate('/', path) - 1)")).alias("shard"), F.when(slash > 0, F.expr("substring(path, locate('/', path) + 1)")).alias("member"))
    told = facts.where("member IS NOT NULL").select("shard", "member", F.lit(True).alias("there"), reason.alias("why"))
    seen = refs.join(told, ["shard", "member"], "left")
    bad = seen.select(key, "i", F.when(F.col("shard").isNull(), "bad path").when(F.col("there").isNull(), "missing").otherwise(F.col("why")).alias("why")).where("why IS NOT NULL")
    return rows.join(bad.groupBy(key).agg(F.min_by("why", "i").alias("reason")), key, "left")


def corrupt() -> Column:
    return F.when(F.col("corrupted"), "corrupt")


def too_large(width: int | None = 1280, height: int | None = 10_000) -> Column:
    out = F.when(F.col("image_width").isNull(), "corrupt")
    if height is not None:
        out = out.when(F.col("image_height") > height, "height")
    return out if width is None else out.when(F.col("image_width") > width, "width")


def misshapen(width: int = 1280, height: int = 5000, ratio: float = 10.0, least_std: float = 1.0) -> Column:
    """The first of: unreadable, too wide, too high, too long for its width, of one colour."""
    w, h = F.col("image_width"), F.col("image_height")
    return F.when(F.col("corrupted"), "corrupt").when(w > width, "width").when(h > height, "height").when(F.greatest(w, h) / F.least(w, h) > ratio, "aspect").when(F.col("rgb_std") < least_std, "pure")


def solid(mode: str, threshold: float = 0.0) -> Column:
    """Definitions of one colour that disagree on purpose: by extremes, by a thumbnail's, all values' or RGB's deviation."""
    rules = {"extrema": F.col("flat"), "thumb_std": F.col("thumb_std") <= threshold, "global_std_le": F.col("pixel_std") <= threshold, "rgb_std_lt": F.col("rgb_std") < threshold}
    return F.when(F.col("corrupted"), "corrupt").when(rules[mode], "solid")


def token_limit(rows: DataFrame, response: Column, most: int = 8000, name: str = "words", path: str | None = None) -> DataFrame:
    """rows with reason: over the limit, or not valid; a row without a response stays."""
    n = token_count(response, name, path)
    counted = rows.withColumn("tokens", n)
    valid = F.col("valid") if "valid" in rows.columns else F.lit(True)
    return counted.withColumn("reason", F.when(~valid, "invalid_json").when(F.col("tokens") > most, "too_long"))


def row_statistics(rows: DataFrame, facts: DataFrame, response: Column, name: str = "words", path: str | None = None) -> DataFrame:
    """The statistics of each row with a shard and an image; text statistics are null where the image is unreadable."""
    own = rows.where("shard IS NOT NULL AND shard <> '' AND image_in_tar IS NOT NULL").withColumn("__r", response)
    broken = facts.where("member IS NULL").select(F.col("shard").alias("__s"), F.col("corruption_reason").alias("__why")).distinct()
    seen = own.join(facts.where("member IS NOT NULL").withColumnRenamed("member", "image_in_tar"), ["shard", "image_in_tar"], "left").join(broken, F.col("shard") == F.col("__s"), "left")
    bad = F.col("__why").isNotNull() | F.coalesce("corrupted", F.lit(True))
    fine = lambda c: F.when(~bad, c)
    return seen.select(
        "id", "shard", "image_in_tar", bad.alias("corrupted"), F.when(bad, F.coalesce("__why", "corruption_reason", F.lit("missing"))).alias("corruption_reason"),
        *[fine(F.col(c)).alias(c) for c in ("image_mode", "image_channels", "image_width", "image_height", "pixel_std", "image_file_size")],
        fine(token_count(F.col("__r"), name, path)).alias("gpt_token_count"), fine(F.length("__r")).alias("gpt_char_count"),
    )


def normalised_png(data: Column) -> Column:
    """RGB over white; null where the image can't be read."""

    @F.arrow_udf("binary")
    def run(images: pa.Array) -> pa.Array:
        return pa.array([as_png(x) for x in images.to_pylist()], pa.binary())

    return run(data)


def loose_images(rows: DataFrame, folder: str, path: str = "image") -> DataFrame:
    """rows with data: the bytes of the file at folder/path, null where there is none.

    The folder is one that all executors share; each task reads the files of its rows. A path that leads out of
    the folder is missing.
    """
    kind = T.StructType([*rows.schema.fields, T.StructField("data", T.BinaryType())])
    root = os.path.realpath(folder)

    def read(name: str | None) -> bytes | None:
        at = os.path.realpath(os.path.join(root, name)) if name else root
        if not at.startswith(root + os.sep):
            return None
        try:
            with open(at, "rb") as f:
                return f.read()
        except OSError:
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([read(x) for x in part.column(path).to_pylist()], pa.binary())], names=[*b.schema.names, "data"])

    return rows.mapInArrow(run, kind)


def missing_image_policy(rows: DataFrame, missing: Column, policy: str) -> DataFrame:
    """keep or drop rows whose image is missing, or fail at the first."""
    if policy == "keep":
        return rows
    if policy == "drop":
        return rows.where(~missing)
    if policy == "fail":
        return rows.where(F.when(missing, F.raise_error(F.lit("an image is missing")).cast("boolean")).otherwise(True))
    raise ValueError(f"unknown policy {policy}")
