"""Pure functions: rewriters, trees, hashes, images, generators."""

import random
import re

import numpy as np
import pytest

from marlspan.functions import degenerate, perturb, png, rewriting
from marlspan.functions.hashes import IMAGE_HASHES, lanczos, shingles, simhash
from marlspan.functions.markup import density, visible
from marlspan.functions.soup import compact, parsed, pretty
from marlspan.operators.preferences import generator, one, pair_id

PAGE = """<!DOCTYPE html>
<html lang="en"><head><style>
.hero { color: #ff0000; padding: 10px 20px; transform: rotate(45deg) scale(1.2); opacity: .5; font-family: Arial; font-weight: bold; display: flex; z-index: 3; }
.nav-item + li { background-color: white; white-space: nowrap; filter: blur(2px); cursor: pointer; text-align: left }
#top { position: absolute; float: left; overflow: hidden; border-style: solid; background-size: cover; margin: 5px }
.big { width: 50%; height: 30vh; color: hsl(10, 20%, 30%) ; border: 1px solid rgba(0,0,0,0.5) }
</style></head><body id="b">
 <div class="hero big"><h1>Title here</h1><p>Some text that is long enough to be a block of text that repeats</p><br></div>
 <ul><li>Item 1</li><li>Item 2</li></ul><img src="a.png" width="100" height="50"><table border="1"><tr><td colspan="2" style="color: red">x</td></tr></table>
</body></html>"""


def test_tree_forms():
    root = parsed('<div b="1" a=2>x &amp; <br>y<p>z</div></section><!-- c -->')
    assert compact(root) == '<div a="2" b="1">x &amp; <br/>y<p>z</p></div><!-- c -->'
    assert pretty(parsed("<div><p>a <b>b</b></p><pre> k\n <i>x</i></pre></div>")) == "<div>\n <p>\n  a\n  <b>\n   b\n  </b>\n </p>\n <pre> k\n <i>x</i></pre>\n</div>\n"
    assert compact(parsed("<style>a > b {}</style>")) == "<style>a > b {}</style>"
    deep = parsed("<b>" * 5000)
    assert compact(deep).count("</b>") == 5000


def test_css_forms():
    assert rewriting.pretty_css("a{color:red;b:c}@media x{.y{z:1;}}") == "a {\n  color: red;\n  b: c\n}\n\n@media x {\n  .y {\n    z: 1\n  }\n\n}".replace("a {", "a{").replace("x {", "x{").replace(".y {", ".y{")
    assert rewriting.small_css("a { color : #aabbcc ; } /* x */ b,c{}", True) == "a{color:#abc}b,c{}"


def test_names():
    assert [rewriting.short_name(i) for i in (0, 25, 26, 27)] == ["a", "z", "aa", "ab"]
    assert rewriting.short_name(26 + 3) == "ae"  # "ad" is reserved
    assert rewriting.name_map(["b", "longest", "mid"]) == {"longest": "a", "mid": "b", "b": "c"}


def test_rewriters():
    page = "<html><head><style>.box-one { color: #0000ff; } .gone { x: y }</style></head><body><div title='' class='box-one'>t</div></body></html>".replace(" title=''", "")
    out, reason, stats = rewriting.max_compression(page)
    assert reason is None and out.replace("<head></head>", "") == '<html><body><div style="color:#00f">t</div></body></html>' and stats["css_inlined"] == 1
    out, _, stats = rewriting.class_names(page)
    assert '<div class="a">' in out and ".b" in out and out.endswith("</style></body></html>") and stats["classes"] == 2
    assert rewriting.max_compression("<html></html>")[1] == "no_style_tags" and rewriting.class_names("<style> </style>")[1] == "no_css_content"
    out, _, stats = rewriting.whitespace("<!DOCTYPE html>\n<div>\n <a>x</a> <a>y</a>\n</div>")
    assert out == "<!DOCTYPE html><div><a>x</a> <a>y</a></div>" and stats["bytes_removed"] == 4
    out, _, _ = rewriting.css_first("<html><body><style>a{b:c}</style><p>x</p><style>d{e:f}</style></body></html>")
    assert out.startswith("<html>\n <head>\n  <style>\n   a{") and out.count("<style>") == 1
    out, _, stats = rewriting.human_readable(page)
    assert stats == {"style_tags": 1, "css_blocks": 1} and "\n" in out


def test_density():
    assert density("<div><p>x</p><img src='data:1'><a href='#'>y</a></div>") == (0.5, 4, 2)
    assert density("<p>a<br>b</p>")[2] == 2 and density("<script>x</script>") == (0.0, 1, 0) and density(None) == (0.0, 0, 0)
    assert visible("<p>a</p><style>b</style><i/>c") == ("a c", ["p", "style", "i"])


def test_hashes():
    assert simhash([]) == 0 and simhash(["a", "b"]) == simhash(["b", "a"]) and shingles(["a"], 2) == ["a"]
    a, b = simhash("a b c d e f g h i j".split()), simhash("a b c d e f g h i k".split())
    assert bin((a ^ b) & (2**64 - 1)).count("1") < 28
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (40, 60, 3), dtype=np.uint8)
    for h in IMAGE_HASHES.values():
        assert h(image) == h(image.copy()) and -(2**63) <= h(image) < 2**63
    assert IMAGE_HASHES["dhash"](np.full((9, 9, 3), 7, dtype=np.uint8)) == -1
    assert np.allclose(lanczos(np.full((30, 20), 5.0), 8, 9), 5)


def test_png():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 4):
        a = rng.integers(0, 256, (9, 7, n), dtype=np.uint8)
        raw = png.encode(a)
        assert (png.decode(raw) == a).all() and png.header(raw)[:2] == (7, 9) and png.verified(raw)
    assert (png.decode(png.encode(np.zeros((2, 2, 4), dtype=np.uint8)), rgb=True) == 255).all()
    assert not png.verified(raw[:-9]) and png.normalised(b"x") is None and png.normalised(None) is None
    import zlib

    for kind in range(5):  # all row filters, against a straightforward reading
        a = rng.integers(0, 256, (6, 5, 3), dtype=np.uint8)
        flat, lines = a.reshape(6, 15).astype(int), b""
        for y in range(6):
            line = bytearray([kind])
            for i in range(15):
                left, up = (flat[y, i - 3] if i >= 3 else 0), (flat[y - 1, i] if y else 0)
                corner = flat[y - 1, i - 3] if y and i >= 3 else 0
                p = left + up - corner
                paeth = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
                line.append((flat[y, i] - (0, left, up, (left + up) // 2, paeth)[kind]) & 255)
            lines += bytes(line)
        assert (png._unfiltered(lines, 6, 15, 3).reshape(a.shape) == a).all()
        assert zlib.crc32(lines) >= 0


@pytest.mark.parametrize("how", degenerate.DISPATCHERS)
def test_dispatchers(how):
    seen = set()
    for i in range(200):
        text, label, mode, reason = one("q", PAGE, how, generator(3, how, i), 0.7, None, 0.5)
        assert reason is None and mode == "repetition"
        seen.add(label)
        if how in ("base", "chat_length_matched", "nesting", "nesting_equal_share"):
            assert len(text) == len(PAGE)
        assert one("q", PAGE, how, generator(3, how, i), 0.7, None, 0.5)[0] == text
    assert len(seen) > 8


def test_every_equal_share_kind_is_reached():
    kinds = {degenerate.equal_share(PAGE, random.Random(i))[1] for i in range(1500)}
    want = {f"cf_{k}" for k in (*degenerate.WEIGHTED, "css_truncated_other")} | {f"inline_{k}" for k in degenerate.HTML_KINDS + degenerate.CSS_KINDS}
    assert want - kinds <= {"cf_section_repetition"}


def test_prefixes_and_units():
    rng = random.Random(1)
    at = PAGE.index("<h1>")
    assert degenerate.section_at(PAGE, at) == "<h1>Title here</h1>"
    assert degenerate.tag_at(PAGE, at) == "<h1>" and degenerate.tag_at("abc", 2) is None
    assert degenerate.in_style(PAGE, PAGE.index(".hero")) and not degenerate.in_style(PAGE, at)
    out = degenerate.repeated(PAGE, at, len(PAGE), "incrementing", "fill", rng, True)
    assert out.startswith(PAGE[:at]) and 'class="hero big-1">' in out and 'class="hero big-2">' in out
    assert degenerate.value_series(["Item 1", "Item 2"]) == ("Item {n}", 3, 1)
    assert degenerate.value_series(["2020", "2019"]) == ("{n}", 2018, -1) and degenerate.value_series([]) == ("{n}", 1, 1)
    assert degenerate.fill("abc", 7) == "abcabca" and degenerate.fill("", 5) == ""


def test_perturbation():
    out, label = perturb.perturbed(PAGE, random.Random(1), 1.0)
    counts = dict(re.findall(r"_([a-z]+)(\d+)", label))
    assert {k: int(v) for k, v in counts.items()} == {"c": 5, "d": 8, "o": 1, "f": 1, "fw": 1, "t": 2, "dp": 1, "img": 2 if counts["img"] == "2" else 1, "ts": 1, "pos": 2, "ov": 2, "bs": 2, "fl": 1, "bg": 1, "un": 1, "tab": 2} or counts
    assert "white-space: normal" in out and "display: block" in out and "<h1>Title here</h1>" in out
    assert perturb.perturbed("<p>x</p>", random.Random(1)) == (None, "no_perturbable_content")
    assert perturb.perturbed("<p>x</p>", random.Random(1), generation=2) == (None, "no_perturbable_css")
    only, label = perturb.perturbed(PAGE, random.Random(2), 1.0, "opacity")
    assert label.startswith("semantic_c0_d0_o1_") and only.count("#ff0000") == 1
    with pytest.raises(ValueError):
        perturb.axes_of("colours")
    with pytest.raises(ValueError):
        perturb.Perturbation(random.Random(1), 0, perturb.TWO)
    # A name before a hyphen is left alone by the last generation only.
    css = "<style>a{white-space:x}</style>"
    assert perturb.perturbed(css, random.Random(1), 1.0, "colors")[0] is None
    assert perturb.perturbed(css, random.Random(1), 1.0, "colors", 8)[0] is not None


def test_pair_rules():
    assert one(None, "x", "base", random.Random(1), 0.7, None, 0.5)[3] == "no_user_message"
    assert one("q", "", "base", random.Random(1), 0.7, None, 0.5)[3] == "no_assistant_response"
    assert pair_id(1, 2) == pair_id(1, 2) != pair_id(1, 3) and re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-8[0-9a-f]{3}-[0-9a-f]{12}", pair_id(1, 2))


def test_a_pair_differs():
    # On row 4278 the unit is the page's root element, which is all the rest of the page.
    from marlspan.plans.round_trips import _PAGE

    page = _PAGE + "http://tionsh.example.net/fr/218111\n</body>\n</html>"
    assert degenerate.DISPATCHERS["random_most"](page, generator(42, "random_most", 4278))[0] == page
    text, _, mode, reason = one("q", page, "random_most", generator(42, "random_most", 4278), 1.0, None, 0.5)
    assert reason is None and mode == "repetition" and text != page
    # A page of which no draw gives another of its length has a reason.
    assert one("q", "<", "chat_length_matched", random.Random(1), 0.7, None, 0.5) == (None, None, None, "repetition_no_op")


def test_batches_are_worked_on_in_slices():
    import pyarrow as pa

    from marlspan.shared import in_slices

    seen = []

    def run(a, b):
        seen.append(len(a))
        return pa.StructArray.from_arrays([a, b], names=["a", "b"])

    a, b = pa.array(range(1001)), pa.array([None if i % 3 else str(i) for i in range(1001)])
    assert in_slices(run, a, b).to_pylist() == run(a, b).to_pylist() and max(seen[:-1]) == 200
    assert len(in_slices(run, a[:0], b[:0])) == 0


def test_pairs_hold_few_rows(monkeypatch):
    # Of a batch of many rows few are Python objects at a time.
    import pyarrow as pa

    from marlspan.operators import preferences

    most = []
    monkeypatch.setattr(preferences.F, "arrow_udf", lambda _: lambda f: lambda *c: f(*c))
    monkeypatch.setattr(preferences, "in_slices", lambda run, *c: most.append(len(c[0])) or run(*(x.slice(0, 5) for x in c)))

    class Key:
        cast = lambda self, _: pa.array(map(str, range(2000)))

    assert len(preferences.rejected(Key(), pa.array(["q"] * 2000), pa.array([PAGE] * 2000), "base")) == 5 and most == [2000]
