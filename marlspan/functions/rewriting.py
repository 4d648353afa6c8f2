"""HTML and CSS rewriters: each takes a page and returns (page, reason it was skipped or None, statistics)."""

from __future__ import annotations

import re
from collections.abc import Callable

from marlspan.functions.soup import Element, compact, parsed, pretty

RESERVED = frozenset(("ad", "ads", "banner", "if", "do", "for"))
#: Characters of CSS up to which simple class rules become style attributes.
INLINE = 100
BLOCKS = frozenset(
    "fieldset form tbody th details pre table ul li h5 ol dl tr nav figcaption aside dt section tfoot main summary h6 link h4 address title dialog style html td header h1 head p figure blockquote h2 script thead article body br div meta hr dd h3 footer".split()
)


def pretty_css(css: str) -> str:
    """A declaration a line, indented by braces, rules apart by a blank line."""
    css = " ".join(css.split())
    for pattern, by in ((r"\{\s*", "{\n  "), (r";\s*", ";\n  "), (r"\s*\}", "\n}"), (r"\s*:\s*", ": "), (r"\}\s*", "}\n\n"), (r"\n\s+\n", "\n\n")):
        css = re.sub(pattern, by, css)
    lines, depth = [], 0
    for line in map(str.strip, css.split("\n")):
        if line.startswith("}"):
            depth = max(0, depth - 1)
        lines.append("  " * depth + line if line else "")
        depth += line.endswith("{")
    css = re.sub(r";\s*\n(\s*\})", r"\n\1", "\n".join(lines))
    return re.sub(r"\n{3,}", "\n\n", css).strip()


def small_css(css: str, colours: bool) -> str:
    css = re.sub(r"(?s)/\*.*?\*/", "", css)
    for mark in "{}:;,":
        css = re.sub(rf"\s*{re.escape(mark)}\s*", mark, css)
    css = css.replace(";}", "}") if not re.search(r";\s+\}", css) else re.sub(r";\s*\}", "}", css)
    if colours:
        css = re.sub(r"#" + "".join(rf"([0-9A-Fa-f])\{i}" for i in (1, 2, 3)) + r"\b", r"#\1\2\3", css)
    return re.sub(r"\s+", " ", css).strip()


def short_name(index: int) -> str:
    """a..z, aa..zz and so on; a reserved name gives way to the next index's."""
    width, i = 1, index
    while i >= 26**width:
        i -= 26**width
        width += 1
    name = ""
    for _ in range(width):
        i, k = divmod(i, 26)
        name = chr(97 + k) + name
    return short_name(index + 1) if name in RESERVED else name


def _styles(root: Element) -> tuple[list[Element], list[str]]:
    tags = root.all("style")
    return tags, [t.string for t in tags if (t.string or "").strip()]


def names_in(root: Element, css: str) -> tuple[list[str], list[str]]:
    """Classes and ids of attributes and of the CSS; hex colours that look like ids count as ids."""
    classes: dict[str, None] = {}
    ids: dict[str, None] = {}
    for e in root.walk():
        classes |= dict.fromkeys(e.classes())
        if (e.attributes.get("id") or "").strip():
            ids[e.attributes["id"].strip()] = None
    classes |= dict.fromkeys(re.findall(r"\.([A-Z_a-z][-\w]*)", css))
    ids |= dict.fromkeys(re.findall(r"#([A-Z_a-z][-\w]*)", css))
    return list(classes), list(ids)


def name_map(names: list[str], safe: frozenset[str] = frozenset()) -> dict[str, str]:
    """Short names by length, the longest first; equal lengths alphabetically, so that the result is one."""
    ranked = sorted((n for n in names if n not in safe), key=lambda n: (-len(n), n))
    out, taken = {}, set(safe)
    k = 0
    for n in ranked:
        name = short_name(k)
        while name in safe and name in taken:
            k += 1
            name = short_name(k)
        out[n] = name
        k += 1
    return out


def renamed_css(css: str, classes: dict[str, str], ids: dict[str, str]) -> str:
    """One name after another, the longest first, as selectors and in attribute selectors."""
    for kind, mark, names in (("class", r"\.", classes), ("id", "#", ids)):
        for old, new in sorted(names.items(), key=lambda x: -len(x[0])):
            css = re.sub(mark + re.escape(old) + r"\b", mark[-1] + new, css)
            css = re.sub(rf"""(\[{kind}[~*^$|]?=["']?){re.escape(old)}\b""", rf"\g<1>{new}", css)
    return css


def _rename(root: Element, classes: dict[str, str], ids: dict[str, str]) -> None:
    for e in root.walk():
        if own := e.classes():
            e.attributes["class"] = " ".join(classes.get(c, c) for c in own)
        if e.attributes.get("id") in ids:
            e.attributes["id"] = ids[e.attributes["id"]]


def purged(css: str, root: Element) -> str:
    """Rules that mention a used class or id, or whose selector begins with neither mark."""
    used = {f".{c}" for e in root.walk() for c in e.classes()} | {f"#{e.attributes['id']}" for e in root.walk() if e.attributes.get("id")}
    anywhere = (["[class"] if any(u[0] == "." for u in used) else []) + (["[id"] if any(u[0] == "#" for u in used) else [])
    kept = []
    for rule in filter(None, map(str.strip, css.split("}"))):
        selector = rule.split("{")[0].strip() if "{" in rule else ""
        if any(u in rule for u in used) or any(a in rule for a in anywhere) or (selector and selector[0] not in ".#"):
            kept.append(rule + "}")
    return "".join(kept)


def _inlined(root: Element, css: str) -> None:
    rules = {}
    for rule in css.split("}"):
        selector, brace, body = rule.partition("{")
        selector = selector.strip()
        if brace and selector.startswith(".") and not set(" >") & set(selector):
            rules[selector[1:]] = body.strip()
    for e in root.walk():
        own = [rules[c] for c in e.classes() if c in rules]
        if own:
            e.attributes["style"] = ";".join(([e.attributes["style"]] if e.attributes.get("style") else []) + own)
            del e.attributes["class"]


def small_html(html: str) -> str:
    html = re.sub(r"(?s)<!--.*?-->", "", html)
    return re.sub(r">\s+<", "><", re.sub(r"\s+", " ", html)).strip()


def _body(root: Element) -> Element:
    body = root.first("body")
    if body is None:
        top = root.first("html")
        if top is None:
            top = Element("html")
            root.append(top)
        body = Element("body")
        top.append(body)
    return body


def human_readable(html: str) -> tuple[str, str | None, dict]:
    root = parsed(html)
    tags = root.all("style")
    n = 0
    for t in tags:
        if (t.string or "").strip():
            t.set_text("\n" + pretty_css(t.string) + "\n")
            n += 1
    return pretty(root), None, {"style_tags": len(tags), "css_blocks": n}


def css_first(html: str) -> tuple[str, str | None, dict]:
    """All styles merged into one at the beginning of the head."""
    root = parsed(html)
    tags, css = _styles(root)
    merged = "\n\n".join(c.strip() for c in css)
    for t in tags:
        t.remove()
    head = root.first("head")
    if head is None:
        head = Element("head")
        (root.first("html") or root).insert(0, head)
    if merged:
        style = Element("style")
        style.set_text("\n" + pretty_css(merged) + "\n")
        head.insert(0, style)
    return pretty(root), None, {"style_tags": len(tags), "css_blocks": len(css)}


def _shortened(html: str, most: bool, safe: frozenset[str] = frozenset(), tighten: bool = True) -> tuple[str, str | None, dict]:
    root = parsed(html)
    tags, css = _styles(root)
    if not tags:
        return html, "no_style_tags", {}
    if not css:
        return html, "no_css_content", {}
    size = sum(map(len, css))
    merged = "\n\n".join(css)
    classes, ids = names_in(root, merged)
    cmap, imap = name_map(classes, safe), name_map(ids, safe)
    short = renamed_css(merged, cmap, imap)
    _rename(root, cmap, imap)
    saved = sum(map(len, classes)) + sum(map(len, ids)) - sum(map(len, cmap.values())) - sum(map(len, imap.values()))
    stats = {"classes": len(cmap), "ids": len(imap), "css_size": size, "name_bytes_removed": saved}
    if most:
        kept = purged(short, root)
        stats["css_purged_bytes"] = len(short) - len(kept)
        short = small_css(kept, True)
        stats["css_minified_bytes"] = len(kept) - len(short)
    for t in tags:
        t.remove()
    if most and 0 < len(short) <= INLINE:
        _inlined(root, short)
        stats["css_inlined"] = 1
    else:
        style = Element("style")
        style.set_text(short)
        _body(root).append(style)
    out = compact(root)
    before = len(out)
    if tighten:
        out = small_html(out)
    stats |= {"css_small_size": len(short), "css_bytes_removed": size - len(short), "html_minified_bytes": before - len(out)}
    stats["total_bytes_removed"] = stats["css_bytes_removed"] + saved + stats["html_minified_bytes"]
    return out, None, stats


def max_compression(html: str) -> tuple[str, str | None, dict]:
    """Short names, unused rules purged, CSS minified, inlined when small, HTML minified."""
    return _shortened(html, True)


def class_names(html: str, safe: frozenset[str] = frozenset(), tighten: bool = True) -> tuple[str, str | None, dict]:
    """Short names, and the styles as one at the end of the body."""
    return _shortened(html, False, safe, tighten)


def whitespace(html: str) -> tuple[str, str | None, dict]:
    """White space of styles, after the doctype, and between tags of which one at least is a block."""
    out = re.sub(r"(?s)(?P<tag><style[^>]*>)(?P<css>.*?)</style>", lambda m: m["tag"] + small_css(m["css"], False) + "</style>", html)
    out = re.sub(r"(?i)(<!DOCTYPE[^>]*>)\s+", r"\1", out)
    out = re.sub(r"</?(?P<a>\w+)[^>]*>(?P<gap>\s+)(?=</?(?P<b>\w+))", lambda m: m[0][: -len(m["gap"])] if {m["a"].lower(), m["b"].lower()} & BLOCKS else m[0], out).strip()
    return out, None, {"original_size": len(html), "minified_size": len(out), "bytes_removed": len(html) - len(out)}


REWRITERS: dict[str, Callable[[str], tuple[str, str | None, dict]]] = {"human_readable": human_readable, "css_first": css_first, "max_compression": max_compression, "class_names": class_names, "whitespace": whitespace}
