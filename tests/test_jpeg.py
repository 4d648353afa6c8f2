"""JPEGs that a small encoder writes here, baseline and progressive, against the samples that their coefficients stand for."""

import numpy as np
import pytest

from marlspan.functions import jpeg, png
from marlspan.operators import images

BASIS = np.array([[np.sqrt((1 if u else 0.5) / 4) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])
ORDER = [0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28, 35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63]
AC = [r << 4 | s for r in range(16) for s in range(11)]  # codes of 8 bits by place in this list; DC: of 4 bits


class Writer:
    def __init__(self):
        self.bits = ""

    def put(self, v, n):
        self.bits += format(v, f"0{n}b") if n else ""

    def magnitude(self, v):
        n = abs(v).bit_length()
        self.put(v if v > 0 else v + (1 << n) - 1, n)

    def bytes(self):
        bits = self.bits + "1" * (-len(self.bits) % 8)
        return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")


def segment(kind, body):
    return bytes((0xFF, kind)) + (len(body) + 2).to_bytes(2, "big") + body


def size_of(v):
    return abs(v).bit_length()


def block(w, z, last, ss, se, ah, al):
    """One block of a scan; the DC that the next one refers to."""
    shifted = lambda v: (abs(v) >> al) * (1 if v > 0 else -1)
    if ss == 0:
        dc = z[0] >> al
        if ah:
            w.put(dc & 1, 1)
        else:
            w.put(size_of(dc - last), 4)
            w.magnitude(dc - last)
        last = dc
        ss = 1
    if se == 0:
        return last
    run, pending = 0, []
    final = max((k for k in range(ss, se + 1) if abs(shifted(z[k])) == 1), default=-1)
    for k in range(ss, se + 1):
        v = shifted(z[k])
        if ah and abs(v) > 1:
            pending.append(abs(v) & 1)
            continue
        if v == 0:
            run += 1
            if ah and run == 16 and k < final:
                w.put(AC.index(0xF0), 8)
                for b in pending:
                    w.put(b, 1)
                run, pending = 0, []
            continue
        while run > 15:
            w.put(AC.index(0xF0), 8)
            run -= 16
        w.put(AC.index(run << 4 | (1 if ah else size_of(v))), 8)
        w.put(int(v > 0), 1) if ah else w.magnitude(v)
        for b in pending:
            w.put(b, 1)
        run, pending = 0, []
    if run or pending:
        w.put(AC.index(0), 8)
        for b in pending:
            w.put(b, 1)
    return last


def encoded(planes, factors, w, h, progressive=False, restart=0, extra=b""):
    """planes: (blocks down, blocks across, 64) of zigzag coefficients for whole units; quantisers are 3."""
    out = b"\xff\xd8" + extra + segment(0xDB, bytes([0]) + bytes([3] * 64))
    frame = bytes([8]) + h.to_bytes(2, "big") + w.to_bytes(2, "big") + bytes([len(planes)])
    for i, (a, b) in enumerate(factors):
        frame += bytes([i + 1, a << 4 | b, 0])
    out += segment(0xC2 if progressive else 0xC0, frame)
    out += segment(0xC4, bytes([0x00]) + bytes([0, 0, 0, 12] + [0] * 12) + bytes(range(12)))
    out += segment(0xC4, bytes([0x10]) + bytes([0] * 7 + [len(AC)] + [0] * 8) + bytes(AC))
    most_h, most_v = max(a for a, _ in factors), max(b for _, b in factors)
    if restart:
        out += segment(0xDD, restart.to_bytes(2, "big"))

    def scan(chosen, ss, se, ah, al):
        nonlocal out
        out += segment(0xDA, bytes([len(chosen)]) + b"".join(bytes([c + 1, 0]) for c in chosen) + bytes([ss, se, ah << 4 | al]))
        if len(chosen) == 1:
            [c] = chosen
            rows, cols = -(-h * factors[c][1] // (8 * most_v)), -(-w * factors[c][0] // (8 * most_h))
            units = [[(c, y, x)] for y in range(rows) for x in range(cols)]
        else:
            units = [[(c, v * factors[c][1] + y, u * factors[c][0] + x) for c in chosen for y in range(factors[c][1]) for x in range(factors[c][0])] for v in range(-(-h // (8 * most_v))) for u in range(-(-w // (8 * most_h)))]
        step = restart or len(units)
        for k in range(0, len(units), step):
            writer, last = Writer(), dict.fromkeys(chosen, 0)
            for unit in units[k : k + step]:
                for c, y, x in unit:
                    last[c] = block(writer, planes[c][y, x].tolist(), last[c], ss, se, ah, al)
            out += (bytes([0xFF, 0xD0 + (k // step - 1) % 8]) if k else b"") + writer.bytes()

    every = list(range(len(planes)))
    if progressive:
        scan(every, 0, 0, 0, 1)
        for c in every:
            scan([c], 1, 5, 0, 2)
            scan([c], 6, 63, 0, 1)
        scan(every, 0, 0, 1, 0)
        for c in every:
            scan([c], 1, 5, 2, 1)
            scan([c], 1, 63, 1, 0)
    else:
        scan(every, 0, 63, 0, 0)
    return out + b"\xff\xd9"


def picture(seed, w, h, factors):
    rng = np.random.default_rng(seed)
    most_h, most_v = max(a for a, _ in factors), max(b for _, b in factors)
    planes, want = [], []
    for a, b in factors:
        down, across = -(-h // (8 * most_v)) * b, -(-w // (8 * most_h)) * a
        z = np.where(rng.random((down, across, 64)) < 0.25, rng.integers(-9, 10, (down, across, 64)), 0)
        z[:, :, 0] = rng.integers(-150, 150, (down, across))
        flat = np.zeros((down, across, 64))
        flat[:, :, ORDER] = z * 3
        plane = np.einsum("ux,yzuv,vw->yxzw", BASIS, flat.reshape(down, across, 8, 8), BASIS).reshape(down * 8, across * 8)
        plane = np.rint(plane + 128).clip(0, 255)
        want.append(np.repeat(np.repeat(plane, most_v // b, 0), most_h // a, 1)[:h, :w])
        planes.append(z)
    return planes, np.stack(want, axis=2)


def in_rgb(x):
    y, b, r = x[:, :, 0], x[:, :, 1] - 128, x[:, :, 2] - 128
    return np.rint(np.stack([y + 1.402 * r, y - 0.344136 * b - 0.714136 * r, y + 1.772 * b], axis=2)).clip(0, 255)


@pytest.mark.parametrize("progressive", [False, True])
@pytest.mark.parametrize("factors,w,h,restart", [([(1, 1)], 21, 13, 0), ([(1, 1)] * 3, 16, 30, 0), ([(2, 2), (1, 1), (1, 1)], 35, 41, 0), ([(2, 1), (1, 1), (1, 1)], 35, 20, 2)])
def test_decoding(progressive, factors, w, h, restart):
    planes, want = picture(w * h, w, h, factors)
    raw = encoded(planes, factors, w, h, progressive, 0 if progressive else restart)
    assert jpeg.header(raw) == (w, h, "L" if len(factors) == 1 else "RGB", len(factors)) and jpeg.verified(raw)
    want = want if len(factors) == 1 else in_rgb(want)
    # Where a value lies midway, the two ways of summing may round apart.
    got = jpeg.decode(raw).astype(int)
    assert got.shape == want.shape and np.abs(got - want).max() <= 1 and (got != want).mean() < 0.02
    plain = encoded(planes, factors, w, h, False)
    assert (jpeg.decode(plain) == got).all()
    assert jpeg.decode(raw, rgb=True).shape == (h, w, 3)
    for cut in (3, 40, len(raw) // 2, len(raw) - 2):
        assert not jpeg.verified(raw[:cut])
        with pytest.raises(jpeg.BadJpeg):
            jpeg.decode(raw[:cut])


def test_images_of_either_kind_are_measured():
    planes, _ = picture(5, 30, 20, [(1, 1)] * 3)
    raw = encoded(planes, [(1, 1)] * 3, 30, 20)
    names = [f.split()[0] for f in images.FACTS.split(", ")]
    got = dict(zip(names, images.measured("s.tar", "a.jpg", raw, None, "phash", True)))
    assert not got["corrupted"] and (got["image_width"], got["image_height"], got["image_mode"]) == (30, 20, "RGB") and got["rgb_std"] > 1 and got["image_hash"] is not None
    broken = dict(zip(names, images.measured("s.tar", "a.jpg", raw[:-30], None, None, True)))
    assert broken["corrupted"] and broken["image_width"] == 30
    assert png.header(images.as_png(raw))[:3] == (30, 20, "RGB") and images.as_png(b"nothing") is None and images.as_png(None) is None
    assert (png.decode(images.as_png(raw)) == jpeg.decode(raw, rgb=True)).all()
    # One colour.
    flat = [np.zeros((1, 1, 64), dtype=np.int64) for _ in range(3)]
    got = dict(zip(names, images.measured("s", "b", encoded(flat, [(1, 1)] * 3, 8, 8), None, None, True)))
    assert got["flat"] and got["pixel_std"] == 0
