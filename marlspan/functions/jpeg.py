"""JPEG, baseline and progressive with Huffman coding and 8 bits, to arrays.

Samples are those of the exact inverse transform, rounded; subsampled colour is repeated, where some
libraries blend neighbours, so that edges of colour may differ by a few steps from theirs.
"""

from __future__ import annotations

import numpy as np

from marlspan.functions.png import BadPng

_ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
_ANGLE = (2 * np.arange(8)[None, :] + 1) * np.arange(8)[:, None] * np.pi / 16
_BASIS = np.cos(_ANGLE) * np.where(np.arange(8) == 0, np.sqrt(1 / 8), 0.5)[:, None]


class BadJpeg(BadPng):
    pass


def _segments(raw: bytes):
    """(marker, body, place after it) up to the end of the image."""
    if raw[:2] != b"\xff\xd8":
        raise BadJpeg("header")
    at = 2
    while at + 4 <= len(raw):
        if raw[at] != 0xFF:
            raise BadJpeg("marker")
        kind = raw[at + 1]
        if kind == 0xFF or kind == 0x01 or 0xD0 <= kind <= 0xD7:
            at += 1 if kind == 0xFF else 2
            continue
        if kind == 0xD9:
            return
        n = int.from_bytes(raw[at + 2 : at + 4], "big")
        if n < 2 or at + 2 + n > len(raw):
            raise BadJpeg("truncated")
        at += 2 + n
        yield kind, raw[at - n + 2 : at], at
        if kind == 0xDA:
            at = _entropy_end(raw, at)


def _entropy_end(raw: bytes, at: int) -> int:
    while True:
        at = raw.find(b"\xff", at)
        if at < 0 or at + 1 >= len(raw):
            raise BadJpeg("truncated")
        if raw[at + 1] and not 0xD0 <= raw[at + 1] <= 0xD7:
            return at
        at += 2


def header(raw: bytes) -> tuple[int, int, str, int]:
    """Width, height, mode and channels."""
    for kind, body, _ in _segments(raw):
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            if len(body) < 6 or body[5] not in (1, 3, 4):
                break
            h, w, n = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big"), body[5]
            if not w or not h:
                break
            return w, h, {1: "L", 3: "RGB", 4: "CMYK"}[n], n
    raise BadJpeg("header")


def verified(raw: bytes) -> bool:
    """Whether its segments are whole and the image has an end."""
    try:
        header(raw)
        for _ in _segments(raw):
            pass
    except BadJpeg:
        return False
    return b"\xff\xd9" in raw[-64:] or raw.rstrip(b"\0").endswith(b"\xff\xd9")


def _table(body: bytes, at: int) -> tuple[list[tuple[int, int]], int]:
    """For each 16 bits the length of the code that they begin with, and its value."""
    counts = body[at : at + 16]
    values = body[at + 16 : at + 16 + sum(counts)]
    out: list[tuple[int, int]] = []
    k = 0
    for size, n in enumerate(counts, 1):
        for _ in range(n):
            if k >= len(values):
                raise BadJpeg("tables")
            out += [(size, values[k])] * (1 << 16 - size)
            k += 1
    if len(out) > 1 << 16:
        raise BadJpeg("tables")
    return out + [(0, 0)] * ((1 << 16) - len(out)), at + 16 + len(values)


class _Bits:
    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.acc, self.n = data, 0, 0, 0

    def _fill(self) -> None:
        part = self.data[self.at : self.at + 8]
        if not part and self.at > len(self.data) + 64:
            raise BadJpeg("truncated")
        self.at += 8
        self.acc = (self.acc << 64) | int.from_bytes(part.ljust(8, b"\0"), "big")
        self.n += 64

    def code(self, table: list[tuple[int, int]]) -> int:
        if self.n < 16:
            self._fill()
        size, value = table[self.acc >> self.n - 16 & 0xFFFF]
        if not size:
            raise BadJpeg("code")
        self.n -= size
        self.acc &= (1 << self.n) - 1
        return value

    def take(self, k: int) -> int:
        if not k:
            return 0
        if self.n < k:
            self._fill()
        self.n -= k
        out = self.acc >> self.n
        self.acc &= (1 << self.n) - 1
        return out

    def signed(self, k: int) -> int:
        v = self.take(k)
        return v if not k or v >> k - 1 else v - (1 << k) + 1


class _Component:
    def __init__(self, h: int, v: int, quant: int) -> None:
        self.h, self.v, self.quant = h, v, quant


def _scan(bits: _Bits, out: list[int], dc, ac, part: "_Component", ss: int, se: int, ah: int, al: int) -> None:
    """One block of a scan, into its 64 coefficients in zigzag order."""
    if ss == 0:
        if ah:
            out[0] |= bits.take(1) << al
        else:
            part.last += bits.signed(bits.code(dc))
            out[0] = part.last << al
        if se == 0:
            return
        ss = 1
    if not ah:
        if part.run:
            part.run -= 1
            return
        k = ss
        while k <= se:
            rs = bits.code(ac)
            r, s = rs >> 4, rs & 15
            if s:
                k += r
                if k > 63:
                    raise BadJpeg("run")
                out[k] = bits.signed(s) << al
                k += 1
            elif r == 15:
                k += 16
            else:
                part.run = (1 << r) + bits.take(r) - 1
                return
        return
    # A refinement: a bit for each coefficient that is there, and new ones of magnitude 1 between them.
    one, k = 1 << al, ss
    if not part.run:
        while k <= se:
            rs = bits.code(ac)
            r, s = rs >> 4, rs & 15
            if s == 0 and r < 15:
                part.run = (1 << r) + bits.take(r)
                break
            new = (one if bits.take(1) else -one) if s else 0
            while k <= se:
                if out[k]:
                    if bits.take(1) and not abs(out[k]) & one:
                        out[k] += one if out[k] > 0 else -one
                elif r:
                    r -= 1
                else:
                    out[k] = new
                    k += 1
                    break
                k += 1
    if part.run:
        while k <= se:
            if out[k] and bits.take(1) and not abs(out[k]) & one:
                out[k] += one if out[k] > 0 else -one
            k += 1
        part.run -= 1


def decode(raw: bytes, rgb: bool = False) -> np.ndarray:
    """(height, width, channels) of 8-bit samples; with rgb three channels."""
    quant: dict[int, np.ndarray] = {}
    huffman: dict[int, list] = {}
    parts: dict[int, _Component] = {}
    w, h, _, n = header(raw)
    interval, adobe, order = 0, None, []
    for kind, body, after in _segments(raw):
        if kind == 0xDB:
            at = 0
            while at < len(body):
                wide = body[at] >> 4
                size = 128 if wide else 64
                if at + 1 + size > len(body):
                    raise BadJpeg("tables")
                quant[body[at] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, at + 1).astype(np.int64)
                at += 1 + size
        elif kind == 0xC4:
            at = 0
            while at + 17 <= len(body):
                huffman[body[at]], at = _table(body, at + 1)
        elif kind == 0xDD:
            interval = int.from_bytes(body[:2], "big")
        elif kind == 0xEE and body[:5] == b"Adobe" and len(body) >= 12:
            adobe = body[11]
        elif kind in (0xC0, 0xC1, 0xC2):
            if body[0] != 8 or len(body) < 6 + 3 * n:
                raise BadJpeg("unsupported")
            for i in range(n):
                own, hv, q = body[6 + 3 * i : 9 + 3 * i]
                if not hv >> 4 or not hv & 15 or max(hv >> 4, hv & 15) > 4:
                    raise BadJpeg("sampling")
                parts[own] = _Component(hv >> 4, hv & 15, q)
                order.append(own)
            most_h, most_v = max(p.h for p in parts.values()), max(p.v for p in parts.values())
            across, down = -(-w // (8 * most_h)), -(-h // (8 * most_v))
            if across * down * 64 > (1 << 16) * len(raw):
                raise BadJpeg("truncated")
            for p in parts.values():
                p.wide, p.high = across * p.h, down * p.v
                p.own_wide, p.own_high = -(-w * p.h // (8 * most_h)), -(-h * p.v // (8 * most_v))
                p.blocks = [[0] * 64 for _ in range(p.wide * p.high)]
        elif 0xC3 <= kind <= 0xCF and kind not in (0xC8, 0xCC):
            raise BadJpeg("unsupported")
        elif kind == 0xDA:
            if not parts or len(body) < 4 + 2 * body[0]:
                raise BadJpeg("scan")
            chosen = [(body[1 + 2 * i], body[2 + 2 * i]) for i in range(body[0])]
            ss, se, approx = body[1 + 2 * body[0] : 4 + 2 * body[0]]
            if se > 63 or any(c not in parts for c, _ in chosen):
                raise BadJpeg("scan")
            coded = raw[after : _entropy_end(raw, after)]
            _entropy(coded, [(parts[c], huffman.get(t >> 4), huffman.get(16 | t & 15)) for c, t in chosen], interval, across, down, ss, se, approx >> 4, approx & 15)
    if not parts:
        raise BadJpeg("header")
    planes = []
    for own in order:
        p = parts[own]
        if p.quant not in quant:
            raise BadJpeg("tables")
        flat = np.zeros((len(p.blocks), 64))
        flat[:, _ZIGZAG] = np.array(p.blocks, dtype=np.int64) * quant[p.quant]
        pixels = _BASIS.T @ flat.reshape(-1, 8, 8) @ _BASIS
        plane = np.rint(pixels + 128).clip(0, 255).reshape(p.high, p.wide, 8, 8).transpose(0, 2, 1, 3).reshape(p.high * 8, p.wide * 8)
        y, x = np.arange(h) * p.v // most_v, np.arange(w) * p.h // most_h
        planes.append(plane[y[:, None], x[None, :]])
    image = np.stack(planes, axis=2)
    if n >= 3 and adobe != 0 and (n == 3 or adobe == 2) and order[:3] != [82, 71, 66]:
        y, cb, cr = image[:, :, 0], image[:, :, 1] - 128, image[:, :, 2] - 128
        image[:, :, :3] = np.rint(np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], axis=2)).clip(0, 255)
    if rgb and n == 1:
        image = np.repeat(image, 3, 2)
    if rgb and n == 4:  # inks are stored inverted by those who say so
        ink = image if adobe is not None else 255 - image
        image = np.rint(ink[:, :, :3] * ink[:, :, 3:] / 255)
    return image.astype(np.uint8)


def _entropy(coded: bytes, own: list, interval: int, across: int, down: int, ss: int, se: int, ah: int, al: int) -> None:
    if (ss == 0 and not ah and any(dc is None for _, dc, _ in own)) or (se > 0 and any(ac is None for *_, ac in own)):
        raise BadJpeg("tables")
    # Restarts cut the data; a byte of ones is followed by a zero.
    pieces, at = [], 0
    while True:
        nxt = coded.find(b"\xff", at)
        while nxt >= 0 and not 0xD0 <= coded[nxt + 1] <= 0xD7:
            nxt = coded.find(b"\xff", nxt + 2)
        pieces.append(coded[at : nxt if nxt >= 0 else len(coded)].replace(b"\xff\x00", b"\xff"))
        if nxt < 0:
            break
        at = nxt + 2
    if len(own) == 1:
        p = own[0][0]
        units = [[(0, y * p.wide + x)] for y in range(p.own_high) for x in range(p.own_wide)]
    else:
        units = [[(i, (v * p.v + y) * p.wide + u * p.h + x) for i, (p, *_) in enumerate(own) for y in range(p.v) for x in range(p.h)] for v in range(down) for u in range(across)]
    step = interval or len(units)
    for k in range(0, len(units), step):
        if k // step >= len(pieces):
            raise BadJpeg("truncated")
        bits = _Bits(pieces[k // step])
        for p, *_ in own:
            p.last = p.run = 0
        for unit in units[k : k + step]:
            for i, block in unit:
                p, dc, ac = own[i]
                _scan(bits, p.blocks[block], dc, ac, p, ss, se, ah, al)
