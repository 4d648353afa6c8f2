"""SimHash of token sequences, perceptual hashes of images, bands and distances; 64 bits as signed integers."""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspan.functions.markup import visible

_ADDRESS, _TOKEN = re.compile(r"https?://\S+"), re.compile(r"[a-z0-9]+")


def signed(bits: np.ndarray) -> int:
    """64 booleans, most significant first."""
    return int.from_bytes(np.packbits(bits).tobytes(), "big", signed=True)


def shingles(tokens: list[str], n: int) -> list[str]:
    return tokens if n <= 1 or len(tokens) < n else [" ".join(tokens[i : i + n]) for i in range(len(tokens) - n + 1)]


def simhash(tokens: list[str]) -> int:
    """Each token votes on each bit; a tie sets the bit; without tokens 0."""
    if not tokens:
        return 0
    votes = b"".join(hashlib.blake2b(t.encode(), digest_size=8).digest() for t in tokens)
    bits = np.unpackbits(np.frombuffer(votes, np.uint8).reshape(len(tokens), 8), axis=1)
    return signed(bits.sum(0, dtype=np.int64) * 2 >= len(tokens))


def page_hashes(html: str | None) -> tuple[int, int]:
    """SimHash of the visible text's tokens, and of pairs of neighbouring tags."""
    text, tags = visible(html)
    return simhash(_TOKEN.findall(_ADDRESS.sub(" ", text.lower()))), simhash(shingles(tags, 2))


_HASHES = T.StructType([T.StructField("text_hash", T.LongType()), T.StructField("dom_hash", T.LongType())])


@F.arrow_udf(_HASHES)
def page_simhash(html: pa.Array) -> pa.Array:
    got = [page_hashes(h) for h in html.to_pylist()]
    return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())], names=["text_hash", "dom_hash"])


def hamming(a: Column | str, b: Column | str) -> Column:
    x, y = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return F.bit_count(x.bitwiseXOR(y))


def bands(h: Column | str, bits: int = 16) -> Column:
    """Array of struct(band, key): the hash cut into 64 / bits slices, the lowest first."""
    c = F.col(h) if isinstance(h, str) else h
    return F.array(*[F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(c, i * bits).bitwiseAND((1 << bits) - 1).alias("key")) for i in range(64 // bits)])


def _weights(n: int, to: int) -> np.ndarray:
    scale = max(1.0, n / to)
    centre = (np.arange(to) + 0.5) * n / to
    x = (np.arange(n)[None, :] + 0.5 - centre[:, None]) / scale
    k = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0)
    return k / k.sum(1, keepdims=True)


#: Of small images the weights cost more than their use: a few MB of them are kept.
_kept_weights = functools.lru_cache(maxsize=256)(_weights)


def lanczos(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Separable resampling with the three-lobed window that widens when it shrinks; float64."""
    of = lambda n, to: (_kept_weights if n * to <= 4096 else _weights)(n, to)
    return of(image.shape[0], h) @ image.astype(np.float64) @ of(image.shape[1], w).T


def grey(image: np.ndarray) -> np.ndarray:
    """Luma of RGB in whole numbers."""
    if image.shape[2] < 3:
        return image[:, :, 0]
    r, g, b = (image[:, :, i].astype(np.int64) for i in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 32768) >> 16).astype(np.uint8)


def _small(image: np.ndarray, h: int, w: int) -> np.ndarray:
    return np.rint(lanczos(grey(image), h, w)).clip(0, 255)


# Bit i of an image hash is that of the i-th value in reading order.


def average_hash(image: np.ndarray) -> int:
    s = _small(image, 8, 8)
    return signed((s >= s.mean()).ravel()[::-1])


def gradient_hash(image: np.ndarray) -> int:
    s = _small(image, 8, 9)
    return signed((s[:, :-1] >= s[:, 1:]).ravel()[::-1])


def spectral_hash(image: np.ndarray) -> int:
    """Signs against the median of the real Fourier coefficients of low frequency, the constant one apart."""
    low = np.real(np.fft.fft2(_small(image, 32, 32)))[:8, :8].ravel()
    return signed((low >= np.median(low[1:]))[::-1])


IMAGE_HASHES = {"ahash": average_hash, "dhash": gradient_hash, "phash": spectral_hash}
