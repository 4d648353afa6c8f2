"""PNG images of 8 bits a sample as arrays: grey, grey with alpha, RGB, RGBA and palettes, without interlacing."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIGN = b"\x89PNG\r\n\x1a\n"
_MODES = {0: ("L", 1), 2: ("RGB", 3), 3: ("P", 1), 4: ("LA", 2), 6: ("RGBA", 4)}


class BadPng(ValueError):
    pass


def _chunks(raw: bytes, check: bool = True):
    if raw[:8] != _SIGN:
        raise BadPng("signature")
    at = 8
    while at + 12 <= len(raw):
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + n]
        end = raw[at + 8 + n : at + 12 + n]
        if len(end) < 4 or (check and struct.unpack(">I", end)[0] != zlib.crc32(kind + body)):
            raise BadPng("chunk")
        yield kind, body
        if kind == b"IEND":
            return
        at += 12 + n
    raise BadPng("truncated")


def header(raw: bytes) -> tuple[int, int, str, int]:
    """Width, height, mode and channels, from the first chunk alone."""
    if raw[:8] != _SIGN or raw[12:16] != b"IHDR" or len(raw) < 33:
        raise BadPng("header")
    w, h, depth, colour = struct.unpack(">IIBB", raw[16:26])
    if colour not in _MODES or not w or not h:
        raise BadPng("header")
    return w, h, *_MODES[colour]


def verified(raw: bytes) -> bool:
    """Whether all chunks are whole and their checksums right."""
    try:
        header(raw)
        for _ in _chunks(raw):
            pass
    except (BadPng, struct.error):
        return False
    return True


def _unfiltered(data: bytes, h: int, row: int, step: int) -> np.ndarray:
    lines = np.frombuffer(data, np.uint8, h * (row + 1)).reshape(h, row + 1)
    out = np.zeros((h, row), dtype=np.uint8)
    before = np.zeros(row, dtype=np.uint8)
    for y in range(h):
        kind, line = lines[y, 0], lines[y, 1:]
        if kind == 0:
            now = line
        elif kind == 1:
            now = line.reshape(-1, step).cumsum(0, dtype=np.uint8).ravel()
        elif kind == 2:
            now = line + before
        elif kind in (3, 4):
            now = bytearray(row)
            src, up = line.tobytes(), before.tobytes()
            for i in range(row):
                a, b = now[i - step] if i >= step else 0, up[i]
                if kind == 3:
                    guess = (a + b) >> 1
                else:
                    c = up[i - step] if i >= step else 0
                    pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
                now[i] = (src[i] + guess) & 255
            now = np.frombuffer(bytes(now), np.uint8)
        else:
            raise BadPng("filter")
        out[y] = before = now
    return out


def decode(raw: bytes, rgb: bool = False) -> np.ndarray:
    """(height, width, channels); palettes and, with rgb, alpha are resolved, alpha over white."""
    try:
        w, h, mode, n = header(raw)
        depth, interlace = raw[24], raw[28]
        parts: dict[bytes, list[bytes]] = {}
        for kind, body in _chunks(raw):
            parts.setdefault(kind, []).append(body)
        if depth != 8 or interlace:
            raise BadPng("unsupported")
        data = zlib.decompress(b"".join(parts.get(b"IDAT", [])))
        if len(data) < h * (w * n + 1):
            raise BadPng("truncated")
        out = _unfiltered(data, h, w * n, n).reshape(h, w, n)
    except (zlib.error, struct.error, IndexError) as e:
        raise BadPng(str(e)) from None
    if mode == "P":
        table = np.zeros((256, 4), dtype=np.uint8)
        table[:, 3] = 255
        colours = np.frombuffer(parts.get(b"PLTE", [b""])[0], np.uint8).reshape(-1, 3)
        table[: len(colours), :3] = colours
        if b"tRNS" in parts:
            alpha = np.frombuffer(parts[b"tRNS"][0], np.uint8)
            table[: len(alpha), 3] = alpha
        out = table[out[:, :, 0]]
        mode = "RGBA" if b"tRNS" in parts else "RGB"
        out = out if mode == "RGBA" else out[:, :, :3]
    if not rgb:
        return out
    if mode in ("LA", "RGBA"):
        alpha = out[:, :, -1:].astype(np.int64)
        colour = out[:, :, :-1].astype(np.int64)
        out = ((colour * alpha + 255 * (255 - alpha) + 127) // 255).astype(np.uint8)
    return np.repeat(out, 3, 2) if out.shape[2] == 1 else out


def encode(image: np.ndarray) -> bytes:
    """Grey, grey with alpha, RGB or RGBA."""
    h, w, n = image.shape
    colour = {1: 0, 2: 4, 3: 2, 4: 6}[n]
    lines = np.zeros((h, w * n + 1), dtype=np.uint8)
    lines[:, 1:] = image.reshape(h, w * n)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return _SIGN + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def normalised(raw: bytes | None) -> bytes | None:
    """The image as an RGB PNG over white; None where it can't be read."""
    try:
        return encode(decode(raw or b"", rgb=True))
    except BadPng:
        return None
