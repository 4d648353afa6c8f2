"""What needs an HTML parser: information density, visible text and tag sequence, for Arrow UDFs."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

SILENT = frozenset(("script", "style", "noscript", "template"))
TELLING = frozenset(("href", "src", "alt", "title", "value", "content", "aria-label", "placeholder"))


def telling(name: str, value: str | None) -> bool:
    """Whether an attribute says something: not blank, no placeholder link, no inline data."""
    v = (value or "").strip()
    if not v or name not in TELLING:
        return False
    low = v.lower()
    return not (name == "href" and (v == "#" or low.startswith("javascript:"))) and not (name == "src" and low.startswith("data:"))


class Density(HTMLParser):
    """Counts tags, and those that have text directly or a telling attribute.

    Text belongs to the innermost open tag. Void elements stay open until an ancestor closes.
    """

    def __init__(self) -> None:
        super().__init__()
        self.names: list[str] = []
        self.worth: list[bool] = []
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs):
        self.open.append(len(self.names))
        self.handle_startendtag(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.names.append(tag.lower())
        self.worth.append(any(telling((k or "").lower(), v) for k, v in attrs))

    def handle_endtag(self, tag):
        while self.open and self.names[self.open.pop()] != tag.lower():
            pass

    def handle_data(self, data):
        if self.open and self.names[self.open[-1]] not in SILENT and data.strip():
            self.worth[self.open[-1]] = True


class Visible(HTMLParser):
    """Text outside of silent elements, and the sequence of start tags."""

    def __init__(self) -> None:
        super().__init__()
        self.depth = 0
        self.text: list[str] = []
        self.tags: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.tags.append(tag.lower())
        self.depth += tag.lower() in SILENT

    def handle_startendtag(self, tag, attrs):
        self.tags.append(tag.lower())

    def handle_endtag(self, tag):
        if tag.lower() in SILENT and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth and data.strip():
            self.text.append(data)


def density(html: str | None) -> tuple[float, int, int]:
    """Ratio, tags, tags of value; 0 without a tag."""
    p = Density()
    p.feed(html or "")
    p.close()
    n = len(p.names)
    return (sum(p.worth) / n if n else 0.0), n, sum(p.worth)


def visible(html: str | None) -> tuple[str, list[str]]:
    p = Visible()
    p.feed(html or "")
    p.close()
    return " ".join(p.text), p.tags


_DENSITY = T.StructType([T.StructField("ratio", T.DoubleType()), T.StructField("total_tags", T.IntegerType()), T.StructField("value_tags", T.IntegerType())])


@F.arrow_udf(_DENSITY)
def value_density(html: pa.Array) -> pa.Array:
    got = [density(h) for h in html.to_pylist()]
    return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.int32())], names=["ratio", "total_tags", "value_tags"])
