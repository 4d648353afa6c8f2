"""Fenced code, HTML predicates and text normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlspan.functions.messages import strip

_LAYER = r"(?s)\A\s*`{3}[^`\n]*\n(.*?)\n`{3}\s*\z"
_OUTER = r"(?s)\A`{3}[A-Za-z]*\s*\n(.*?)`{3}\s*\z"


def strip_layer(code: Column) -> Column:
    """The inside of a text that is one fenced block, without outer line feeds; else the stripped text."""
    inner = F.regexp_replace(F.regexp_replace(F.regexp_extract(code, _LAYER, 1), r"^\n+", ""), r"\n+\z", "")
    return F.when(code.rlike(_LAYER), inner).otherwise(strip(F.coalesce(code, F.lit(""))))


def strip_outer(code: Column) -> Column:
    """The inside of a text that is one fenced block, without trailing line feeds; else the text as it is."""
    bare = strip(code)
    return F.when(bare.rlike(_OUTER), F.regexp_replace(F.regexp_extract(bare, _OUTER, 1), r"\n+\z", "")).otherwise(code)


def first_block(text: Column, languages: str = "html") -> Column:
    """The first fenced block anywhere, stripped; without one the stripped text."""
    pattern = rf"(?is)```(?:{languages})?\s*(.*?)```"
    bare = strip(F.coalesce(text, F.lit("")))
    return F.when(bare.rlike(pattern), strip(F.regexp_extract(bare, pattern, 1))).otherwise(bare)


def fenced(code: Column, tag: str) -> Column:
    """The code in a fence, unless it begins with one."""
    bare = strip(code)
    return F.when(bare.startswith("```"), bare).otherwise(F.concat(F.lit(f"```{tag}\n"), bare, F.lit("\n```")))


def valid_html(html: Column) -> Column:
    """Begins with <html or a doctype and ends with </html>, but for white space."""
    return html.rlike(r"(?i)\A\s*<(!DOCTYPE\s+html|html)") & html.rlike(r"(?i)</html>\s*\z")


def holds_html(text: Column) -> Column:
    low = F.lower(text)
    return low.contains("<html") | low.contains("<body")


def filled(text: Column) -> Column:
    return F.coalesce(strip(text) != "", F.lit(False))


def prefixed(path: Column, prefix: str) -> Column:
    return F.when(path.startswith(prefix), path).otherwise(F.concat(F.lit(prefix), path))


def normalised(text: Column) -> Column:
    """Lower case without addresses; the ASCII words and numbers, joined by spaces."""
    return F.array_join(F.regexp_extract_all(F.regexp_replace(F.lower(text), r"https?://\S+", " "), F.lit(r"([a-z0-9]+)"), 1), " ")


def sequence_id(prefix: str, index: Column) -> Column:
    return F.format_string(f"{prefix}_%06d", index)


def _spaced(css: Column) -> Column:
    out = F.regexp_replace(css, r"(?s)/\*.*?\*/", "")
    for mark in "{}:;,":
        out = F.regexp_replace(out, rf"\s*\{mark}\s*" if mark in "{}" else rf"\s*{mark}\s*", mark)
    return F.regexp_replace(out, r";\s*\}", "}")


def minified_css(css: Column, colours: bool = True) -> Column:
    """CSS without comments and needless white space; with colours, #aabbcc becomes #abc."""
    out = _spaced(css)
    if colours:
        out = F.regexp_replace(out, "#" + "".join(rf"([0-9A-Fa-f])\{i}" for i in (1, 2, 3)) + r"\b", "#$1$2$3")
    return strip(F.regexp_replace(out, r"\s+", " "))
