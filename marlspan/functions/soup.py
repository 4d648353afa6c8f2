"""A small HTML tree on the standard library's parser, with compact and indented forms.

End tags without an open element are ignored; void elements close at once; attributes are written in
alphabetical order, text with the three markup characters escaped (but in script and style).
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input keygen link menuitem meta param source track wbr basefont bgsound command frame image isindex nextid spacer".split())
RAW = frozenset(("script", "style"))
KEPT = frozenset(("pre", "textarea"))


class Text:
    def __init__(self, text: str, before: str = "", after: str = "") -> None:
        self.text, self.before, self.after = text, before, after
        self.parent: Element | None = None

    def written(self) -> str:
        if self.before or (self.parent is not None and self.parent.name in RAW):
            return self.before + self.text + self.after
        return self.text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


class Element:
    def __init__(self, name: str, attributes: dict[str, str] | None = None) -> None:
        self.name, self.attributes, self.children = name, attributes or {}, []
        self.parent: Element | None = None

    def insert(self, at: int, node: Element | Text) -> None:
        node.parent = self
        self.children.insert(at, node)

    def append(self, node: Element | Text) -> None:
        self.insert(len(self.children), node)

    def remove(self) -> None:
        if self.parent:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def walk(self) -> Iterator[Element]:
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, Element):
                yield node
                stack.extend(reversed(node.children))

    def all(self, name: str) -> list[Element]:
        return [e for e in self.walk() if e.name == name]

    def first(self, name: str) -> Element | None:
        return next((e for e in self.walk() if e.name == name), None)

    @property
    def string(self) -> str | None:
        """The text of an element with one child only."""
        if len(self.children) != 1:
            return None
        only = self.children[0]
        return only.text if isinstance(only, Text) else only.string

    def set_text(self, text: str) -> None:
        self.children = []
        self.append(Text(text))

    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def opening(self) -> str:
        out = [self.name]
        for k, v in sorted(self.attributes.items()):
            if v is None:
                out.append(k)
                continue
            v = v.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
            quote = '"'
            if '"' in v:
                v, quote = (v.replace('"', "&quot;"), '"') if "'" in v else (v, "'")
            out.append(f"{k}={quote}{v}{quote}")
        return "<" + " ".join(out) + ("/>" if self.name in VOID else ">")


class _Builder(HTMLParser):
    """Builds the tree; neighbouring data become one text."""

    def __init__(self) -> None:
        super().__init__()
        self.root = Element("")
        self.open = [self.root]
        self.held: list[str] = []

    def flush(self) -> None:
        if self.held:
            self.open[-1].append(Text("".join(self.held)))
            self.held = []

    def handle_starttag(self, tag, attrs):
        self.flush()
        e = Element(tag, {k: "" if v is None else v for k, v in attrs})
        if "class" in e.attributes:
            e.attributes["class"] = " ".join(e.attributes["class"].split())
        self.open[-1].append(e)
        if tag not in VOID:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        self.held.append(data)

    def special(self, text: str, before: str, after: str) -> None:
        self.flush()
        self.open[-1].append(Text(text, before, after))

    def handle_comment(self, data):
        self.special(data, "<!--", "-->")

    def handle_decl(self, decl):
        if decl[:7].lower() == "doctype":
            self.special(decl[7:].strip(), "<!DOCTYPE ", ">")
        else:
            self.special(decl, "<!", ">")

    def unknown_decl(self, data):
        self.special(data[6:] if data.upper().startswith("CDATA[") else data, "<![CDATA[", "]]>")

    def handle_pi(self, data):
        self.special(data, "<?", ">")


def parsed(html: str) -> Element:
    b = _Builder()
    b.feed(html)
    b.close()
    b.flush()
    return b.root


def _events(root: Element) -> Iterator[tuple[Element | Text, bool]]:
    """Nodes in order; elements that aren't void twice, the second time with True."""
    stack: list[tuple[Element | Text, bool]] = [(c, False) for c in reversed(root.children)]
    while stack:
        node, closing = stack.pop()
        yield node, closing
        if not closing and isinstance(node, Element) and node.name not in VOID:
            stack.append((node, True))
            stack.extend((c, False) for c in reversed(node.children))


def compact(root: Element) -> str:
    out = []
    for node, closing in _events(root):
        if isinstance(node, Text):
            # A doctype is followed by a line feed, as parsers write it.
            out.append(node.written() + ("\n" if node.before == "<!DOCTYPE " else ""))
        else:
            out.append(f"</{node.name}>" if closing else node.opening())
    return "".join(out)


def pretty(root: Element) -> str:
    """One node a line, one space a level; text stripped, but kept as it is in pre and textarea."""
    out, depth, kept = [], 0, 0
    for node, closing in _events(root):
        if isinstance(node, Text):
            if kept:
                out.append(node.written())
            elif text := node.written().strip():
                out.append(" " * depth + text + "\n")
        elif closing:
            depth -= 1
            if node.name in KEPT:
                kept -= 1
                out.append(f"</{node.name}>" + ("" if kept else "\n"))
            else:
                out.append(f"</{node.name}>" if kept else " " * depth + f"</{node.name}>\n")
        else:
            inside = kept > 0
            if node.name in KEPT:
                kept += 1
            out.append(node.opening() if inside else " " * depth + node.opening() + ("" if kept else "\n"))
            if node.name not in VOID:
                depth += 1
    return "".join(out)
