"""Media columns: Netpbm (P1 to P7) and BMP images to arrays, area-resized tiles in NPY form, and difference hashes.

An image is decoded to a (height, width, channels) array of 8-bit samples (samples of another range
are scaled to 0..255), resized to SIDE x SIDE by exact area averages, taken from its integral image,
and cut into tiles of TILE x TILE, each of which becomes the bytes of an NPY file (format 1.0). The
64-bit difference hash compares neighbours of a 9 x 8 area resize of the luma, row by row, most
significant bit first; an image has one, and each tile has its own.

Cases: a null payload gives one row with error "null"; an empty, truncated or unknown one
a row that names its error, with null arrays; nothing raises. Images of any size are resized from all
their samples, large ones in bands of rows (an image whose bytes can't hold the size that it announces is
"truncated"); equal neighbours give a bit of 0; repeated rows give repeated results; an empty table
gives none. Only the id and the payload are read, whatever other columns there are.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIDE, TILE = 32, 16
#: Samples from which an image is summed in bands of rows, of which the integral image keeps those that are asked for.
BAND = 1 << 22


class BadImage(ValueError):
    pass


def _header(raw: bytes, n: int, at: int = 2) -> tuple[list[int], int]:
    """n numbers of a Netpbm header, comments skipped, and the place after the one white space that ends it."""
    out: list[int] = []
    while len(out) < n:
        while at < len(raw) and raw[at : at + 1].isspace():
            at += 1
        if raw[at : at + 1] == b"#":
            while at < len(raw) and raw[at] not in b"\r\n":
                at += 1
            continue
        end = at
        while end < len(raw) and 48 <= raw[end] <= 57:
            end += 1
        if end == at or end - at > 9:
            raise BadImage("header")
        out.append(int(raw[at:end]))
        at = end
    return out, at + 1


def _checked(w: int, h: int, depth: int, most: int) -> None:
    """most: samples that the payload's bytes can hold."""
    if w < 1 or h < 1 or depth < 1:
        raise BadImage("size")
    if w * h * depth > most:
        raise BadImage("truncated")


def _scaled(samples: np.ndarray, most: int) -> np.ndarray:
    if not 0 < most < 65536:
        raise BadImage("maxval")
    if most == 255:
        return samples.astype(np.uint8)
    return ((np.minimum(samples, most).astype(np.int64) * 255 + most // 2) // most).astype(np.uint8)


def _binary(raw: bytes, at: int, w: int, h: int, depth: int, most: int) -> np.ndarray:
    kind = np.dtype(">u2") if most > 255 else np.dtype("u1")
    if len(raw) - at < w * h * depth * kind.itemsize:
        raise BadImage("truncated")
    return _scaled(np.frombuffer(raw, kind, w * h * depth, at), most).reshape(h, w, depth)


def decode_netpbm(raw: bytes) -> np.ndarray:
    kind = raw[1:2]
    if kind == b"7":
        fields, at = {}, 3
        while True:
            end = raw.find(b"\n", at)
            if end < 0:
                raise BadImage("header")
            line, at = raw[at:end].split(b"#")[0].split(), end + 1
            if line[:1] == [b"ENDHDR"]:
                break
            if len(line) == 2 and line[1].isdigit():
                fields[line[0]] = int(line[1])
        try:
            w, h, depth, most = (fields[k] for k in (b"WIDTH", b"HEIGHT", b"DEPTH", b"MAXVAL"))
        except KeyError:
            raise BadImage("header") from None
        _checked(w, h, depth, len(raw))
        out = _binary(raw, at, w, h, depth, most)
        # Of alpha channels nothing is kept.
        return out[:, :, :1] if depth < 3 else out[:, :, :3]
    if kind in b"14":
        (w, h), at = _header(raw, 2)
        _checked(w, h, 1, 8 * len(raw))
        if kind == b"4":
            row = -(-w // 8)
            if len(raw) - at < row * h:
                raise BadImage("truncated")
            bits = np.unpackbits(np.frombuffer(raw, np.uint8, row * h, at).reshape(h, row), axis=1)[:, :w]
        else:
            digits = np.frombuffer(raw, np.uint8, offset=min(at - 1, len(raw)))
            digits = digits[(digits == 48) | (digits == 49)]
            if len(digits) < w * h:
                raise BadImage("truncated")
            bits = (digits[: w * h] - 48).reshape(h, w)
        return ((1 - bits) * 255).astype(np.uint8)[:, :, None]
    depth = 3 if kind in b"36" else 1
    (w, h, most), at = _header(raw, 3)
    _checked(w, h, depth, len(raw))
    if kind in b"56":
        return _binary(raw, at, w, h, depth, most)
    words = raw[at:].split(None, w * h * depth)[: w * h * depth]
    if len(words) < w * h * depth:
        raise BadImage("truncated")
    try:
        return _scaled(np.array(words, dtype=np.int64), most).reshape(h, w, depth)
    except ValueError:
        raise BadImage("samples") from None


def _runs(raw: bytes, at: int, w: int, h: int, nibbles: bool) -> np.ndarray:
    """Run-length encoded palette indexes, from the bottom row up."""
    out = np.zeros((h, w), dtype=np.uint8)
    x = y = 0
    while at + 1 < len(raw) and y < h:
        n, v = raw[at], raw[at + 1]
        at += 2
        if n:
            values = ([v >> 4, v & 15] * (n // 2 + 1))[:n] if nibbles else [v] * n
        elif v == 0:
            x, y = 0, y + 1
            continue
        elif v == 1:
            break
        elif v == 2:
            if at + 1 >= len(raw):
                break
            x, y = x + raw[at], y + raw[at + 1]
            at += 2
            continue
        else:
            size = -(-v // 2) if nibbles else v
            part = raw[at : at + size]
            at += size + size % 2
            values = [z for b in part for z in (b >> 4, b & 15)][:v] if nibbles else list(part)
        values = values[: max(0, w - x)]
        if y < h and x < w:
            out[y, x : x + len(values)] = values
        x += n or v
    return out


def decode_bmp(raw: bytes) -> np.ndarray:
    def number(at: int, n: int, signed: bool = False) -> int:
        if at + n > len(raw):
            raise BadImage("truncated")
        return int.from_bytes(raw[at : at + n], "little", signed=signed)

    start, header = number(10, 4), number(14, 4)
    if header == 12:
        w, h, bits, method, colours, entry = number(18, 2), number(20, 2), number(24, 2), 0, 0, 3
    elif header >= 40:
        w, h, bits, method, colours, entry = number(18, 4, True), number(22, 4, True), number(28, 2), number(30, 4), number(46, 4), 4
    else:
        raise BadImage("header")
    down, h = h < 0, abs(h)
    # A byte holds 8 pixels at most, two bytes a run of 255.
    _checked(w, h, 1, (255 if method in (1, 2) else 8) * len(raw))
    if bits not in (1, 4, 8, 16, 24, 32) or method not in (0, 1, 2, 3, 6) or (method == 1 and bits != 8) or (method == 2 and bits != 4):
        raise BadImage("unsupported")
    if bits <= 8:
        n = min(colours or 1 << bits, 1 << bits)
        at = 14 + header
        if at + n * entry > len(raw):
            raise BadImage("truncated")
        palette = np.zeros((256, 3), dtype=np.uint8)
        palette[:n] = np.frombuffer(raw, np.uint8, n * entry, at).reshape(n, entry)[:, 2::-1]
    if method in (1, 2):
        return palette[_runs(raw, start, w, h, method == 2)[::-1]]
    row = -(-w * bits // 32) * 4
    if len(raw) - start < row * h:
        raise BadImage("truncated")
    rows = np.frombuffer(raw, np.uint8, row * h, start).reshape(h, row)
    if not down:
        rows = rows[::-1]
    if bits == 24:
        return rows[:, : w * 3].reshape(h, w, 3)[:, :, ::-1]
    if bits <= 8:
        index = rows[:, :w] if bits == 8 else np.unpackbits(rows, axis=1)[:, :w] if bits == 1 else np.stack([rows >> 4, rows & 15], axis=2).reshape(h, -1)[:, :w]
        return palette[index]
    pixels = np.ascontiguousarray(rows[:, : w * bits // 8]).view("<u2" if bits == 16 else "<u4").reshape(h, w).astype(np.int64)
    masks = [number(54 + 4 * i, 4) for i in range(3)] if method in (3, 6) else [0x7C00, 0x3E0, 0x1F] if bits == 16 else [0xFF0000, 0xFF00, 0xFF]
    parts = []
    for m in masks:
        if not m:
            raise BadImage("masks")
        low = (m & -m).bit_length() - 1
        most = m >> low
        parts.append((((pixels & m) >> low) * 255 + most // 2) // most)
    return np.stack(parts, axis=2).astype(np.uint8)


def decode(raw: bytes) -> np.ndarray:
    if not raw:
        raise BadImage("empty")
    if raw[:2] == b"BM":
        return decode_bmp(raw)
    if raw[:1] == b"P" and raw[1:2] in (b"1", b"2", b"3", b"4", b"5", b"6", b"7"):
        return decode_netpbm(raw)
    raise BadImage("unknown")


_edges: dict = {}


def _cuts(n: int, to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places i n / to as whole and fraction: the integral between two of them is exact."""
    if (n, to) not in _edges:
        if len(_edges) > 20_000:
            _edges.clear()
        at = np.arange(to + 1) * n
        low, part = at // to, at % to
        _edges[n, to] = low, np.minimum(low + 1, n), part / to, (np.arange(to) * 0 + n / to)
    return _edges[n, to]


def area_resize(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Each output sample is the mean of the input under it, from differences of the integral image (float64)."""
    low, high, part, _ = _cuts(image.shape[0], h)
    if image.size < BAND:
        total = np.zeros((image.shape[0] + 1, image.shape[1] + 1, image.shape[2]))
        total[1:, 1:] = image.cumsum(0, dtype=np.float64).cumsum(1)
    else:
        # Of a large image only the rows between which output rows lie are kept.
        at = np.unique(np.r_[low, high])
        total = np.zeros((len(at), image.shape[1] + 1, image.shape[2]))
        for k in range(1, len(at)):
            total[k, 1:] = total[k - 1, 1:] + image[at[k - 1] : at[k]].sum(0, dtype=np.float64)
        total.cumsum(1, out=total)
        low, high = np.searchsorted(at, low), np.searchsorted(at, high)
    rows = total[low] + (total[high] - total[low]) * part[:, None, None]
    low, high, part, _ = _cuts(image.shape[1], w)
    both = rows[:, low] + (rows[:, high] - rows[:, low]) * part[None, :, None]
    area = (image.shape[0] / h) * (image.shape[1] / w)
    return (both[1:, 1:] - both[:-1, 1:] - both[1:, :-1] + both[:-1, :-1]) / area


def luma(image: np.ndarray) -> np.ndarray:
    return image @ np.array([0.299, 0.587, 0.114]) if image.shape[2] == 3 else image[:, :, 0].astype(np.float64)


def difference_hash(image: np.ndarray) -> int:
    """64 bits, as a signed integer; a bit is 1 where the left neighbour is darker by a 1000th at least."""
    small = area_resize(luma(image)[:, :, None], 8, 9)[:, :, 0]
    bits = np.packbits((small[:, 1:] - small[:, :-1]).ravel() > 1e-3)
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def npy(tile: np.ndarray) -> bytes:
    """The bytes of an NPY file of format 1.0, as numpy.save writes them."""
    shape = ", ".join(map(str, tile.shape))
    text = f"{{'descr': '|u1', 'fortran_order': False, 'shape': ({shape}), }}"
    text += " " * (-(len(text) + 11) % 64) + "\n"
    return b"\x93NUMPY\x01\x00" + len(text).to_bytes(2, "little") + text.encode() + np.ascontiguousarray(tile).tobytes()


def tiles(raw: bytes | None, side: int, tile: int) -> Iterator[tuple]:
    """(error, height, width, channels, image hash, tile row, tile column, tile hash, NPY bytes) of each tile."""
    try:
        if raw is None:
            raise BadImage("null")
        image = decode(raw)
    except BadImage as e:
        yield (str(e), *[None] * 8)
        return
    small = np.rint(area_resize(image, side, side)).clip(0, 255).astype(np.uint8)
    whole = difference_hash(image)
    for y in range(0, side, tile):
        for x in range(0, side, tile):
            part = small[y : y + tile, x : x + tile]
            yield (None, *image.shape, whole, y // tile, x // tile, difference_hash(part), npy(part))


_FIELDS = (("error", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("image_hash", pa.int64()), ("tile_row", pa.int32()), ("tile_column", pa.int32()), ("tile_hash", pa.int64()), ("npy", pa.binary()))


def media_tiles(images: DataFrame, id_column: str = "doc_id", payload: str = "payload", side: int = SIDE, tile: int = TILE) -> DataFrame:
    """A row for each tile of each image, or one with its error."""
    kind = images.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                own, rows = [], []
                for k, raw in enumerate(part.column(1)):
                    for row in tiles(raw.as_py(), side, tile):
                        own.append(k)
                        rows.append(row)
                cols = [pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)] if rows else [pa.array([], t) for _, t in _FIELDS]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own, pa.int64())), *cols], names=[id_column, *[n for n, _ in _FIELDS]])

    return images.select(id_column, payload).mapInArrow(run, f"{id_column} {kind}, error string, height int, width int, channels int, image_hash bigint, tile_row int, tile_column int, tile_hash bigint, npy binary")


def write_npy(found: DataFrame, folder: str, id_column: str = "doc_id") -> DataFrame:
    """Write each tile as <folder>/<id>/<row>_<column>.npy, on a folder that all executors share; the paths.

    A file appears whole, by renaming; a task that runs again writes the same bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = []
            for k, y, x, data in zip(*(b.column(c).to_pylist() for c in (id_column, "tile_row", "tile_column", "npy"))):
                path = f"{folder}/{k}/{y}_{x}.npy"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(f"{path}.{uuid.uuid4().hex}", "wb") as f:
                    f.write(data)
                os.replace(f.name, path)
                paths.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    return found.where("npy IS NOT NULL").select(id_column, "tile_row", "tile_column", "npy").mapInArrow(run, "path string")


def rendered(docs: DataFrame) -> DataFrame:
    """A stand-in for a media column: each text's bytes as the samples of an image, doc_id and payload.

    All bytes of the text are used, in rows of 48 samples; the last row is filled up. The formats
    take turns by doc_id: P5, P6, P4, BMP of 8 bits and of 24, P7.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ramp = b"".join(bytes((i, i, i, 0)) for i in range(256))
        for b in batches:
            out = []
            for doc, raw in zip(b.column("doc_id").to_pylist(), b.column("raw").to_pylist()):
                if raw is None:
                    out.append(None)
                    continue
                n = max(1, -(-len(raw) // 48))
                body = raw.ljust(48 * n, b" ")
                kind = (doc or 0) % 6
                if kind == 0:
                    out.append(b"P5\n# text\n48 %d\n255\n" % n + body)
                elif kind == 1:
                    out.append(b"P6 16 %d 255\n" % n + body)
                elif kind == 2:
                    out.append(b"P4\n384 %d\n" % n + body)
                elif kind == 5:
                    out.append(b"P7\nWIDTH 12\nHEIGHT %d\nDEPTH 4\nMAXVAL 255\nTUPLTYPE RGB_ALPHA\nENDHDR\n" % n + body)
                else:
                    w, bits, table = (48, 8, ramp) if kind == 3 else (16, 24, b"")
                    at = 54 + len(table)
                    out.append(b"BM" + (at + len(body)).to_bytes(4, "little") + bytes(4) + at.to_bytes(4, "little") + b"".join(v.to_bytes(s, "little") for v, s in ((40, 4), (w, 4), (n, 4), (1, 2), (bits, 2), (0, 4), (len(body), 4), (2835, 4), (2835, 4), (0, 4), (0, 4))) + table + body)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "payload"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.encode("text", "UTF-8").alias("raw")).mapInArrow(run, "doc_id bigint, payload binary")
