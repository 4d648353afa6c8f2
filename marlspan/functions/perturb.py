"""Rejected samples of another look: values of CSS and of a few attributes are changed, the structure stays."""

from __future__ import annotations

import random
import re
from collections import Counter

NAMES = "aqua beige black blue brown coral crimson cyan gold gray green grey indigo khaki lime magenta maroon navy olive orange pink purple red salmon silver tan teal turquoise violet white yellow".split()
SYNONYMS = {"aqua": "cyan", "cyan": "aqua", "grey": "gray", "gray": "grey"}
FONTS = tuple(
    f"{names}, {kind}"
    for names, kind in (("Verdana, Geneva", "sans-serif"), ("'Lucida Console', Monaco", "monospace"), ("Impact, 'Arial Black'", "sans-serif"), ("'Comic Sans MS', 'Comic Sans'", "cursive"), ("Georgia, 'Times New Roman'", "serif"), ("'Courier New', Courier", "monospace"), ("Arial, Helvetica", "sans-serif"), ("'Times New Roman', Times", "serif"))
)
#: Axis, properties, and what each keyword becomes.
KEYWORDS = (
    ("font_weight", "font-weight", "normal>bold lighter>bolder bolder>lighter bold>normal 900>400 800>200 700>300 600>200 500>100 400>900 300>700 200>800 100>900"),
    ("transform", None, ""),
    ("display", "display", "table>block table-cell>inline-block none>block inline>block inline-grid>block inline-flex>block inline-block>block grid>block flex>block block>inline-block"),
    ("display", "flex-direction", "row>column row-reverse>column-reverse column>row column-reverse>row-reverse"),
    ("display", "justify-content", "start>end space-evenly>flex-end space-between>center space-around>flex-start flex-start>flex-end flex-end>flex-start end>start center>space-between"),
    ("display", "align-items", "stretch>center start>end flex-start>flex-end flex-end>flex-start end>start center>baseline baseline>stretch"),
    ("text_style", "text-align", "start>end right>left left>right justify>center end>start center>justify"),
    ("text_style", "text-decoration(?:-line)?", "underline>line-through overline>underline none>underline line-through>none"),
    ("text_style", "text-transform", "uppercase>lowercase none>uppercase lowercase>capitalize capitalize>none"),
    ("text_style", "font-style", "oblique>normal normal>italic italic>normal"),
    ("position", "position", "sticky>fixed static>absolute relative>fixed fixed>relative absolute>static"),
    ("position", "float", "right>none none>left left>right"),
    ("position", "clear", "right>left none>both left>right both>none"),
    ("overflow", "overflow(?:-x|-y)?", "visible>hidden scroll>auto hidden>visible clip>visible auto>hidden"),
    ("overflow", "visibility", "visible>hidden hidden>visible collapse>visible"),
    ("overflow", "white-space", "pre>pre-wrap pre-wrap>pre pre-line>pre nowrap>normal normal>nowrap"),
    ("overflow", "box-sizing", "content-box>border-box border-box>content-box"),
    ("border_style", "(?:outline|border)(?:-(?:left|bottom|right|top))?-style", "solid>dashed ridge>groove outset>inset none>solid inset>outset groove>ridge double>none dotted>double dashed>dotted"),
    ("border_style", "list-style-type", "upper-roman>decimal upper-alpha>lower-alpha square>circle none>disc lower-roman>upper-roman lower-alpha>upper-alpha disc>square decimal>lower-roman decimal-leading-zero>decimal circle>disc"),
    ("border_style", "cursor", "wait>crosshair text>move pointer>default not-allowed>pointer move>wait help>default grabbing>grab grab>grabbing default>not-allowed crosshair>move auto>pointer"),
    ("filter", None, ""),
    ("filter", "mix-blend-mode", "soft-light>hard-light screen>overlay saturation>color overlay>darken normal>multiply multiply>screen luminosity>hue lighten>difference hue>saturation hard-light>soft-light exclusion>difference difference>exclusion darken>lighten color>luminosity color-dodge>color-burn color-burn>color-dodge"),
    ("background", "background-position", "top>bottom right>left left>right center>top bottom>top"),
    ("background", "background-size", "cover>contain contain>auto auto>cover"),
    ("background", "background-repeat", "space>round round>space repeat>no-repeat repeat-y>repeat-x repeat-x>repeat-y no-repeat>repeat"),
)
TWO = ("colors", "dimensions")
EIGHT = (*TWO, "opacity", "fonts", "font_weight", "transform", "display", "img_dims")
SIXTEEN = (*EIGHT, "text_style", "position", "overflow", "border_style", "filter", "background", "unitless_number", "table_attrs")
_SHORT = dict(zip(SIXTEEN, ("c", "d", "o", "f", "fw", "t", "dp", "img", "ts", "pos", "ov", "bs", "fl", "bg", "un", "tab")))

_H = "[0-9A-Fa-f]"
_HEX = rf"#(?:{'|'.join(f'{_H}{{{n}}}' for n in (8, 6, 4, 3))})(?!{_H})"
_NUMBER = r"(-?\d+(?:[.]\d+)?)"
_NAMED = r"(?i)\b(" + "|".join(sorted(NAMES, key=lambda n: -len(n))) + r")\b"
_SIZE = r"(?i)(?<![-#.\w])" + _NUMBER + r"(rem|em|px|vw|vh|pt|mm|cm|in|%s%%)\b"


def _value_of(prop: str) -> str:
    """A property and all up to the end of its declaration."""
    return rf"(?i)(\b{prop}\s*:\s*)([^\n;}}]+)"


def _attribute(tag: str, name: str, unit: str = "") -> str:
    """A number as an attribute's value, and what stands before and after it."""
    return rf"""(?i)(<{tag}\b[^>]*?\s{name}\s*=\s*['"]?)(\d+){unit}(['"]?)"""


def axes_of(given: str | None, known: tuple[str, ...] = SIXTEEN) -> tuple[str, ...]:
    """Axes of a list with commas; all if it is empty or "all"; an unknown one is an error."""
    if not (given or "").strip() or given.strip().lower() == "all":
        return known
    asked = {a.strip().lower() for a in given.split(",") if a.strip()}
    if asked - set(known):
        raise ValueError(f"unknown: {', '.join(sorted(asked - set(known)))}; known: {', '.join(known)}")
    return tuple(a for a in known if a in asked)


def written(x: float) -> str:
    return str(round(x)) if abs(x - round(x)) < 1e-9 else f"{x:g}"


class Perturbation:
    """One page's changes, each with the given probability, counted by axis.

    The generations differ: the first knows five- and seven-digit colours, no `deg` and no synonyms;
    the first two change colour names that a hyphen follows.
    """

    def __init__(self, rng: random.Random, rate: float, axes: tuple[str, ...], generation: int = 16) -> None:
        if not 0 < rate <= 1:
            raise ValueError("the rate lies in (0, 1]")
        self.rng, self.rate, self.axes, self.generation = rng, rate, axes, generation
        self.count: Counter[str] = Counter()
        self.hex = r"#[0-9a-fA-F]{3,8}\b" if generation == 2 else _HEX
        self.named = _NAMED + (r"(?!-[a-zA-Z])" if generation == 16 else "")
        self.size = re.compile(_SIZE % ("" if generation == 2 else "deg|"))

    def roll(self, axis: str) -> bool:
        hit = self.rng.random() < self.rate
        self.count[axis] += hit
        return hit

    def each(self, axis: str, pattern, change, text: str) -> str:
        return re.sub(pattern, lambda m: change(m) if self.roll(axis) else m[0], text)

    def scaled(self, x: str, unit: str) -> str:
        return written(float(x) * self.rng.choice((4.0, 3.0, 2.0, 0.5, 0.25))) + unit

    def number(self, *bounds: tuple[int, int]) -> list[int]:
        return [self.rng.randint(*b) for b in bounds]

    def colours(self, css: str) -> str:
        r = self.rng

        def rgb(m):
            x = ", ".join(map(str, self.number((0, 255), (0, 255), (0, 255))))
            return f"rgba({x}, {round(r.uniform(0.1, 1), 2)})" if "rgba" in m[0].lower() else f"rgb({x})"

        def hsl(m):
            h, s, l = self.number((0, 359), (20, 100), (15, 85))  # noqa: E741
            x = f"{h}, " + ", ".join(f"{v}%" for v in (s, l))
            return f"hsla({x}, {round(r.uniform(0.2, 1), 2)})" if "hsla" in m[0].lower() else f"hsl({x})"

        def name(m):
            own = m[0].lower()
            other = None if self.generation == 2 else SYNONYMS.get(own)
            return r.choice([n for n in NAMES if n not in (own, other)])

        css = self.each("colors", self.hex, lambda m: f"#{r.randint(0, 0xFFFFFF):06x}", css)
        css = self.each("colors", r"(?i)rgba?[(][\s\d.,%/]+[)]", rgb, css)
        if self.generation > 2:
            css = self.each("colors", r"(?i)hsla?[(][\s\d.,%/deg]+[)]", hsl, css)
        return self.each("colors", self.named, name, css)

    def opacity(self, css: str) -> str:
        def change(m):
            own = float(m[2])
            tries = (round(self.rng.uniform(0.1, 1), 2) for _ in range(10))
            return m[1] + f"{next((t for t in tries if abs(t - own) >= 0.2), round(max(0.1, min(1.0, 1 - own)), 2)):g}"

        return self.each("opacity", r"(?i)(\b(?:stroke-|fill-)?opacity\s*:\s*)(\d*[.]?\d+)", change, css)

    def fonts(self, css: str) -> str:
        head = lambda s: s.split(",")[0].strip().lower().strip("'\"")
        change = lambda m: m[1] + self.rng.choice([f for f in FONTS if head(f) != head(m[2])])
        return self.each("fonts", _value_of("font-family"), change, css)

    def turned(self, m: re.Match, units: str) -> str:
        n = re.match(rf"(?i){_NUMBER}\s*({units})?", m[2].strip())
        return f"{m[1]}({written(float(n[1]) + self.rng.choice((45, 90, 135, 180, -45, -90)))}{n[2] or 'deg'})" if n else m[0]

    def transform(self, css: str) -> str:
        def factor(part: str) -> str:
            try:
                return written(float(part) * self.rng.choice((3.0, 2.5, 1.8, 0.5, 0.3)))
            except ValueError:
                return part

        def change(m):
            kind = m[1].lower()
            if kind.startswith(("rotate", "skew")):
                return self.turned(m, "deg|rad|turn|grad")
            if kind.startswith("scale"):
                return f"{m[1]}({', '.join(factor(p.strip()) for p in m[2].split(','))})"
            return f"{m[1]}({self.size.sub(lambda d: self.scaled(d[1], d[2]), m[2].strip())})"

        inner = r"(?i)((?:rotate|scale|translate|skew)[XY]?|rotateZ)\(\s*([^)]*)\)"
        return re.sub(_value_of("transform"), lambda m: m[1] + self.each("transform", inner, change, m[2]), css)

    def filter(self, css: str) -> str:
        def change(m):
            kind, arg = m[1].lower(), m[2].strip()
            if kind == "hue-rotate":
                return self.turned(m, "deg|rad|turn|grad")
            n = re.match(rf"(?i){_NUMBER}\s*({'rem|em|px' if kind == 'blur' else '%'})?", arg)
            if not n:
                return m[0]
            if kind == "blur":
                return f"{m[1]}({self.scaled(n[1], n[2] or 'px')})"
            return f"{m[1]}({self.rng.randint(0, 200)}%)" if n[2] else f"{m[1]}({written(float(n[1]) * self.rng.choice((2.5, 1.8, 0.5, 0.3)))})"

        inner = r"(?i)(opacity|sepia|saturate|hue-rotate|invert|grayscale|contrast|brightness|blur)[(]\s*([^)]*)[)]"
        return re.sub(_value_of("filter"), lambda m: m[1] + self.each("filter", inner, change, m[2]), css)

    def keywords(self, axis: str, prop: str, table: dict[str, str], css: str) -> str:
        known = "|".join(map(re.escape, table))

        def change(m):
            new = table[m[2].lower()]
            if self.rng.random() < self.rate and new != m[2].lower():
                self.count[axis] += 1
                return m[1] + new
            return m[0]

        return re.sub(rf"(?i)(\b{prop}\s*:\s*)({known})\b", change, css)

    def css(self, css: str) -> str:
        on = self.axes
        for axis, f in (("colors", self.colours), ("opacity", self.opacity), ("fonts", self.fonts)):
            if axis in on:
                css = f(css)
        for axis, prop, pairs in KEYWORDS:
            if axis in on:
                css = self.keywords(axis, prop, dict(p.split(">") for p in pairs.split()), css) if prop else getattr(self, axis)(css)
        if "unitless_number" in on:
            plain = r"(?i)(\b(?:column-count|tab-size|line-height|flex-(?:shrink|grow)|order|z-index)\s*:\s*)" + _NUMBER + r"(?=\s*(?:\n|[;}]|\Z))"
            css = self.each("unitless_number", plain, lambda m: m[1] + self.scaled(m[2], ""), css)
        # Sizes come last: what other axes wrote may be scaled too.
        return self.each("dimensions", self.size, lambda m: self.scaled(m[1], m[2]), css) if "dimensions" in on else css

    def page(self, html: str) -> str:
        html = re.sub(r"(?is)(?P<tag><style\b[^>]*>)(?P<css>.*?)(?=</style>)", lambda m: m["tag"] + self.css(m["css"]), html)
        for q in "\"'":
            html = re.sub(rf"(?i)style\s*=\s*{q}([^{q}]*){q}", lambda m, q=q: f"style={q}{self.css(m[1])}{q}", html)
        if "img_dims" in self.axes:
            html = self.each("img_dims", _attribute("img", "(?:height|width)", "(?:px)?"), lambda m: m[1] + self.scaled(m[2], "") + m[3], html)
        if "table_attrs" in self.axes:
            for tag, names in (("table", ("border", "cellpadding", "cellspacing")), ("t[dh]", ("colspan", "rowspan"))):
                for n in names:
                    least = lambda x: x if float(x) >= 1 else "1"
                    html = self.each("table_attrs", _attribute(tag, n), lambda m: m[1] + least(self.scaled(m[2], "")) + m[3], html)
        return html

    def label(self) -> str:
        known = {2: TWO, 8: EIGHT, 16: SIXTEEN}[self.generation]
        return "semantic_" + "_".join(f"{_SHORT[a]}{self.count[a]}" for a in known)


def perturbed(html: str, rng: random.Random, rate: float = 0.7, axes: str | None = None, generation: int = 16) -> tuple[str | None, str]:
    """The page and its label; or None and the reason why not."""
    p = Perturbation(rng, rate, axes_of(axes, {2: TWO, 8: EIGHT, 16: SIXTEEN}[generation]), generation)
    out = p.page(html)
    if not sum(p.count.values()):
        return None, "no_perturbable_css" if generation == 2 else "no_perturbable_content"
    return (None, "perturbation_no_op") if out == html else (out, p.label())
