"""Rejected samples that degenerate: a prefix of a page, and then something again and again.

Every function takes the row's own random generator; nothing depends on other rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable

_N = "[A-Za-z][0-9A-Za-z]*"
_SIMPLE = r"[#.]?[-\w]+"
_TAG = re.compile(rf"</?{_N}(?:\s[^>]*)?/?>")
_OPEN = re.compile(rf"<({_N})[^>]*>")
_RULE = re.compile(r"[^{}]+[{][^{}]*[}]")
_STYLE = re.compile(r"(?i)<style[^>]*>")
_STYLE_END = re.compile(r"(?i)</style>")
_EMPTY_TAG = re.compile(r"(?i)<(?:hr|br|link|meta|input|img)[^>]*>")
_CLOSING = re.compile(rf"</{_N}>")
HTML_KINDS = ("section", "tag", "char", "closing_tag", "self_closing", "incrementing", "deeply_nested")
CSS_KINDS = ("css_value", "css_rule", "css_selector", "css_property", "css_incrementing", "css_multi_rule")
NESTED = ("cycling", "incrementing", "pure")
WEIGHTED = {"cycling": 2, "incrementing": 2, "pure": 2, "css_rule_cycling": 12, "enumeration": 2, "whitespace_runaway": 37, "css_bloat": 12, "section_repetition": 10, "self_closing_spam": 8, "closing_tag_spam": 6, "truncated_padded": 5}
EQUAL = tuple(("cf", k) for k in (*WEIGHTED, "css_truncated_other")) + tuple(("inline", k) for k in HTML_KINDS + CSS_KINDS)


# What stands near a place


def style_regions(page: str) -> list[tuple[int, int]]:
    ends = ((m.end(), _STYLE_END.search(page, m.end())) for m in _STYLE.finditer(page))
    return [(a, z.start()) for a, z in ends if z]


def in_style(page: str, at: int) -> bool:
    return any(a <= at < z for a, z in style_regions(page))


def _near(pattern: re.Pattern, page: str, at: int, reach: int) -> re.Match | None:
    found = pattern.finditer(page, max(0, at - reach), min(at + reach, len(page)))
    return min(found, key=lambda m: abs(m.start() - at), default=None)


def indent_at(page: str, at: int) -> str:
    """The line feed and white space that begin the line of a place."""
    line = page.rfind("\n", 0, at)
    if line < 0:
        return page[:at] if page[:at].strip() == "" else ""
    lead = page[line + 1 : at]
    return "\n" + lead[: len(lead) - len(lead.lstrip(" \t"))]


def tag_at(page: str, at: int) -> str | None:
    """The next tag, else the last before."""
    m = _TAG.search(page, at)
    if m:
        return m.group()
    for i in range(min(at, len(page)), -1, -1):
        if page[i : i + 1] == "<" and (m := _TAG.match(page, i)):
            return m.group()
    return None


def section_at(page: str, at: int) -> str | None:
    """The nearest element with all it holds; 100 characters where it isn't closed."""
    m = _near(_OPEN, page, at, 200)
    if m is None or m.group().endswith("/>"):
        return m and m.group()
    depth = 0
    for t in re.compile(rf"(?i)<(/?){m[1]}(?:>|(?<!/)[^>]*>)").finditer(page, m.start()):
        if t[1] and not t.group().lower() == f"</{m[1].lower()}>":
            continue
        depth += -1 if t[1] else 1
        if not depth:
            return page[m.start() : t.end()]
    return page[m.start() : m.start() + 100]


def rule_at(page: str, at: int) -> str | None:
    m = _near(_RULE, page, at, 500)
    return m and m.group().strip()


def rules_at(page: str, at: int, n: int) -> str | None:
    """n rules in a row, from the nearest on or the last n."""
    every = [(m.start(), m.group().strip()) for m in _RULE.finditer(page)]
    if len(every) < n or n < 2:
        return None
    k = min(range(len(every)), key=lambda i: abs(every[i][0] - at))
    k = min(k, len(every) - n)
    return "\n".join(r for _, r in every[k : k + n])


def property_at(page: str, at: int) -> str:
    m = _near(re.compile(r"[-\w]+\s*:\s*[^{};]+;?"), page, at, 200)
    return m.group().strip().removesuffix(";") + ";" if m else "color: red;"


def selector_at(page: str, at: int, default: str) -> str:
    m = _near(re.compile(rf"({_SIMPLE}(?:\s+{_SIMPLE})*)\s*{{"), page, at, 300)
    return m[1].strip() if m else default


# Units that repeat


def _char(page, at, rng, indented):
    n = rng.choice((1, 2))
    return page[at : at + n] or "a"


def _tag(page, at, rng, indented):
    t = tag_at(page, at)
    return indented(t) if t else _char(page, at, rng, indented)


def _section(page, at, rng, indented):
    s = section_at(page, at)
    return indented(s) if s else _tag(page, at, rng, indented)


def _counted(page, at, rng, indented):
    m = _near(re.compile(rf'<({_N})\s+class="([^"]{{1,}})"[^>]*>'), page, at, 200)
    return (lambda i: indented(f'<{m[1]} class="{m[2]}-{i}">')) if m else _tag(page, at, rng, indented)


def _closing(page, at, rng, indented):
    m = _CLOSING.search(page, max(0, at - 50))
    return indented(m.group() if m else "</div>")


def _empty(page, at, rng, indented):
    m = _EMPTY_TAG.search(page, max(0, at - 100))
    return indented(m.group() if m else rng.choice(("<br/>", "<hr/>", "<input/>", '<img src=""/>')))


def _nested(page, at, rng, indented):
    m = re.compile(rf"<({_N})(?:\s[^>]*)?>(?!/)").search(page, max(0, at - 50))
    return indented(f"<{m[1] if m else 'div'}>")


def _css_rule(page, at, rng, indented):
    r = rule_at(page, at)
    return indented(r) + "\n" if r else _char(page, at, rng, indented)


def _css_rules(page, at, rng, indented, sizes=(2, 3)):
    r = rules_at(page, at, rng.choice(sizes))
    return indented(r) + "\n" if r else _css_rule(page, at, rng, indented)


def _css_block(page, at, rng, indented):
    for n in (rng.choice((5, 6, 7, 8, 9, 10)), 5, 4, 3, 2):
        if r := rules_at(page, at, n):
            return r + "\n"
    return _css_rule(page, at, rng, indented)


def _css_counted(page, at, rng, indented):
    base = re.sub(r"-?\d+$", "", selector_at(page, at, ".item"))
    return lambda i: indented(f"{base}-{i} {{ }}") + "\n"


def _css_value(page, at, rng, indented):
    m = re.compile(r":\s*([.\d]+(?:vw|vh|%|rem|em|px)?|\w+)").search(page, max(0, at - 100))
    return (m[1] if m else "10px") + " "


def _css_growing(page, at, rng, indented):
    m = _near(re.compile(rf"({_SIMPLE}(?:\s*[~>+\s]\s*{_SIMPLE})*)\s*{{"), page, at, 300)
    base = m[1].strip() if m else ".nav--list"
    more = re.findall(rf"\s*[~>+]\s*{_N}", base) if m else []
    step = more[-1] if more else rng.choice((" + ul", " + li", " + div", " > div", " > li", " ~ p"))
    body = re.search(r"\{([^}]*)\}", rule_at(page, at) or "")
    if len(re.findall(r"[+>~]", base)) < 3:
        base += step * rng.randint(3, 6)
    return lambda i: f"{base}{step * (i - 1)} {{\n {body[1].strip() if body else 'margin-top: 0'}\n}}\n"


def _text(page, at, rng, indented):
    found = [m for m in re.compile(r">([^<]+)<").finditer(page, max(0, at - 200), min(at + 200, len(page))) if m[1].strip()]
    m = min(found, key=lambda m: abs(m.start() - at), default=None)
    if m is None or len(m[1].strip()) < 2:
        return _section(page, at, rng, indented)
    text = m[1].strip()
    lead = list(re.compile(rf"<({_N})(?:\s[^>]*)?>").finditer(page, max(0, m.start() - 100), m.start() + 1))
    return f"{lead[-1].group()}{text}</{lead[-1][1]}>" if lead and rng.choice((True, False)) else text + " "


UNITS: dict[str, Callable] = {
    "char": _char, "tag": _tag, "section": _section, "incrementing": _counted, "closing_tag": _closing, "self_closing": _empty, "deeply_nested": _nested,
    "css_rule": _css_rule, "css_property": lambda p, a, r, i: property_at(p, a) + " ", "css_selector": lambda p, a, r, i: selector_at(p, a, ".class") + " ",
    "css_incrementing": _css_counted, "css_value": _css_value, "css_multi_rule": _css_rules, "css_large_block": _css_block, "css_growing_selector": _css_growing, "text_content": _text,
}


def repetitions(space: int, unit: int, rng: random.Random) -> int:
    """A random count: 40 at least for short units, 20 for others, or what there is room for; one at least."""
    most = max(1, space // max(1, unit))
    return rng.randint(min(40 if unit < 5 else 20, most), most)


def fill(unit: str, n: int) -> str:
    return (unit * (n // len(unit) + 1))[:n] if unit and n > 0 else ""


def repeated(page: str, at: int, target: int, kind: str, how: str, rng: random.Random, indent: bool, sizes=(2, 3)) -> str:
    """The page up to a place, and a unit from around it. how: "trim" and "fill" end at target, "random" doesn't."""
    prefix = page[:at]
    room = target - len(prefix)
    if kind == "stuttering":
        unit = tag_at(page, at) or (m.group() if (m := re.compile(r"(?a)[A-Za-z][-\w]*").search(page, at)) else "")
        if len(unit) < 2:
            return repeated(page, at, target, "char", how, rng, indent)
        start = unit[: rng.randint(1, min(len(unit) - 1, 4))]
        room -= len(start) + 1
        unit += "" if unit.startswith("<") else " "
        return prefix[:target] if room <= 0 else f"{prefix}{start} {unit * repetitions(room, len(unit), rng)}"
    if kind == "attribute":
        m = _near(re.compile(rf"<({_N})\s+([^>]+)>"), page, at, 200)
        own = m and re.search(r"""(?a)[A-Za-z][-\w]*\s*=\s*["'][^"']*["']""", m[2])
        if not own:
            return repeated(page, at, target, "tag", how, rng, indent)
        if room <= 0:
            return prefix[:target]
        tag = f"<{m[1]} {' '.join([own.group()] * repetitions(room, len(own.group()) + 1, rng))}>"
        left = room - len(tag)
        return prefix + tag * (1 if left <= 0 else max(1, left // len(tag)) + 1)
    lead = indent_at(page, at) if indent else ""
    make = UNITS[kind]
    unit = make(page, at, rng, lambda s: lead + s, sizes) if make is _css_rules else make(page, at, rng, lambda s: lead + s)
    if room <= 0:
        return prefix[:target]
    if isinstance(unit, str):
        return prefix + (unit * repetitions(room, len(unit), rng) if how == "random" else fill(unit, room))
    if how == "random":
        return prefix + "".join(unit(i) for i in range(1, repetitions(room, len(unit(1)), rng) + 1))
    parts, n, i = [], 0, 1
    while n < room:
        parts.append(unit(i))
        n += len(parts[-1])
        i += 1
    return (prefix + "".join(parts))[:target]


# Pages that never end


def _line_at(page: str, share: float) -> int:
    return page.rfind("\n", 0, int(len(page) * share)) + 1


def _padded(page: str, cut: int, chunks, target: int) -> str:
    parts, n = [page[:cut]], cut
    while n < target:
        parts.append(chunks())
        n += len(parts[-1])
    return "".join(parts)[:target]


def nested(page: str, kind: str, target: int, rng: random.Random, trim: bool = True) -> tuple[str, str]:
    """Opening tags from around the cut, deeper and deeper: in turn, with numbers, or one of them."""
    cut = page.rfind("\n", 0, int(target * rng.uniform(0.3, 0.7))) + 1
    prefix = page[:cut]
    last = prefix.rstrip("\n").rsplit("\n", 1)[-1]
    depth = len(last) - len(last.lstrip(" ")) + 1
    around = page[max(0, cut - 2000) : cut + 2000]
    tags = "article|section|a|li|p|span|input|div"
    pairs = list(dict.fromkeys((m[1], m[2].split()[0]) for m in re.finditer(rf'<({tags})\s+class="([-\s\w]+)"[^>]*>', around) if m[2].strip()))[:50]
    pairs = pairs or list(dict.fromkeys((m[1], "") for m in re.finditer(rf"<({tags})>", around)))[:10] or [("div", "item")]
    if len(prefix) >= target:
        return prefix[:target], f"cf_{kind}"
    cycle = rng.sample(pairs, min(rng.randint(3, 5), len(pairs))) if kind == "cycling" else [rng.choice(pairs)]
    number = rng.randint(1, 100)
    base = re.sub(r"\d+$", "", cycle[0][1]) or "item"
    parts, n, i = [prefix], len(prefix), 0
    while n < target:
        tag, own = cycle[i % len(cycle)]
        own = f"{base}{number + i}" if kind == "incrementing" else own
        parts.append(" " * depth + (f'<{tag} class="{own}">\n' if own else f"<{tag}>\n"))
        n += len(parts[-1])
        i += 1
        depth += kind != "incrementing" or rng.random() < 0.5
    out = "".join(parts)
    return (out[:target] if trim else out), f"cf_{kind}"


def _cut_style(page: str, least: int, most_cut: float, rng: random.Random):
    m = re.search(r"(?is)<style\b[^>]*>(.*?)</style", page)
    if not m or len(m[1]) < least:
        return None
    rules = [(r[1].strip(), r[2].strip()) for r in re.finditer(r"([^\n{}]+)[{]([^{}]*)[}]", m[1])]
    if len(rules) < 3:
        return None
    cut = m.start(1) + int(len(m[1]) * rng.uniform(0.4, most_cut))
    end = page.find("}", cut, m.end(1))
    if end >= 0:
        cut = end + 1
        while page[cut : cut + 1] == "\n":
            cut += 1
    return rules, cut


def css_rule_cycling(page: str, rng: random.Random) -> str | None:
    got = _cut_style(page, 200, 0.8, rng)
    if not got:
        return None
    rules, cut = got
    selector = max((s for s, _ in rules), key=len)
    if len(selector) < 5:
        return None
    own = [b for _, b in rules if b]
    n = rng.randint(4, 5)
    spare = ["display: block", ";\n  ".join(f"{p}: 40px" for p in ("width", "height", "line-height")), "text-align: center", "font-size: 16px", "color: #fff", "margin: 0;\n  padding: 0", "background-color: #002386"]
    bodies = rng.sample(own, n) if len(own) >= n else own + rng.sample(spare, n - len(own))
    turn = iter(range(1 << 60))
    return _padded(page, cut, lambda: f"\n{selector}{{\n  {bodies[next(turn) % n]}\n}}\n", len(page))


def css_bloat(page: str, rng: random.Random, low: bool | None = None) -> tuple[str, str] | None:
    got = _cut_style(page, 300, 0.75, rng)
    if not got:
        return None
    rules, cut = got
    selectors, bodies = [s for s, _ in rules if s], [b for _, b in rules if b]
    if not selectors or not bodies:
        return None
    low = rng.random() < 0.3 if low is None else low
    left = rng.randint(3, 8) if low else 1 << 60
    ends = ("", ":hover", ":focus", " span", " a", ">li", ">p", " img", ".active")

    def chunk() -> str:
        nonlocal left
        left -= 1
        return f"\n{rng.choice(selectors)}{rng.choice(ends)}{{\n  {rng.choice(bodies)}\n}}\n" if left >= 0 else "\n" + " " * 30

    return _padded(page, cut, chunk, len(page)), "css_truncated_other" if low else "css_bloat"


def value_series(samples: list[str]) -> tuple[str, int, int]:
    """A text with {n}, and the next number and step of what numbers in the samples do."""
    first = samples[0].strip() if samples else ""
    numbers = list(re.finditer(r"\d+", first))
    if not samples or not numbers:
        return f"{first} {{n}}".strip(), 1, 1
    for m in numbers:
        around = [re.search(r"\d+", s.strip()[max(0, m.start() - 5) : m.start() + 10]) for s in samples[:5]]
        found = [int(x.group()) for x in around if x]
        if len(found) > 1 and len(set(found)) > 1:
            step = found[1] - found[0] or -1
            return first[: m.start()] + "{n}" + first[m.end() :], found[-1] + step, step
    m = numbers[0]
    return first[: m.start()] + "{n}" + first[m.end() :], int(m.group()) - 1, -1


def enumeration(page: str, rng: random.Random) -> str | None:
    """Children of a list go on and on, with numbers that follow theirs."""
    found = []
    for outer, item in (("dl", "dd"), ("table", "tr"), ("tbody", "tr"), ("ol", "li"), ("ul", "li"), ("select", "option")):
        found += [(item, m) for m in re.finditer(rf"(?is)<{outer}[^>]*>(.*?)</{outer}>", page) if len(re.findall(rf"(?i)<{item}\b", m[1])) > 1]
    if not found:
        return None
    child, m = rng.choice(found)
    texts = [t.strip() for t in re.findall(rf"(?is)<{child}[^>]*>(.*?)</{child}>", m[1])]
    close = page.rfind(f"</{child}>", 0, m.end())
    if not texts or close < 0:
        return None
    cut = close + len(child) + 3
    cut += page[cut : cut + 1] == "\n"
    begin = page.rfind(f"<{child}", 0, close)
    lead = page[page.rfind("\n", 0, begin) + 1 : begin] if begin >= 0 else " " * 8
    text, n, step = value_series(texts)

    def chunk() -> str:
        nonlocal n
        n += step
        return f"{lead}<{child}>\n{lead} {text.replace('{n}', str(n - step))}\n{lead}</{child}>\n"

    return _padded(page, cut, chunk, len(page))


def whitespace_runaway(page: str, rng: random.Random) -> str | None:
    if len(page) < 100:
        return None
    cut = _line_at(page, rng.uniform(0.5, 0.8))
    lead, orphan = indent_at(page, cut) or "\n", tag_at(page, cut) or "<div>"
    return _padded(page, cut, lambda: lead + " " * rng.randint(40, 200) + (orphan if rng.random() < 0.05 else ""), len(page))


def truncated_padded(page: str, rng: random.Random) -> str | None:
    if len(page) < 100:
        return None
    cut = _line_at(page, rng.uniform(0.7, 0.9))
    pad = (indent_at(page, cut) or "\n") + " " * rng.randint(15, 25)
    return _padded(page, cut, lambda: pad, len(page))


def section_repetition(page: str, rng: random.Random) -> str | None:
    blocks = [m for m in re.finditer(r'(?s)<(?P<t>li|section|article|div)\s+class="[^"]{1,}"[^>]*>.*?</(?P=t)>', page) if 100 <= len(m.group()) <= 2000]
    if not blocks:
        return None
    m = rng.choice(blocks)
    cut = m.end() + (page[m.end() : m.end() + 1] == "\n")
    return page[:cut] + fill((indent_at(page, cut) or "\n") + m.group(), len(page) - cut)


def self_closing_spam(page: str, rng: random.Random) -> str | None:
    cut = _line_at(page, rng.uniform(0.5, 0.8))
    m = _EMPTY_TAG.search(page)
    if not m:
        return None
    tag = m.group() if m.group().endswith("/>") else m.group().rstrip(">") + "/>"
    return page[:cut] + fill((indent_at(page, cut) or "\n") + tag, len(page) - cut)


def closing_tag_spam(page: str, rng: random.Random) -> str | None:
    cut = _line_at(page, rng.uniform(0.5, 0.8))
    tags = _CLOSING.findall(page[:cut])
    return page[:cut] + fill((indent_at(page, cut) or "\n") + rng.choice(tags[-10:]), len(page) - cut) if tags else None


def unfinished(page: str, kind: str, rng: random.Random) -> tuple[str, str] | None:
    """A page that never ends, of a kind that needs something of the page; None if that is missing."""
    if kind in ("css_bloat", "css_truncated_other"):
        got = css_bloat(page, rng, kind == "css_truncated_other")
        return got and (got[0], f"cf_{got[1]}")
    text = {"css_rule_cycling": css_rule_cycling, "enumeration": enumeration, "whitespace_runaway": whitespace_runaway, "section_repetition": section_repetition, "self_closing_spam": self_closing_spam, "closing_tag_spam": closing_tag_spam, "truncated_padded": truncated_padded}[kind](page, rng)
    return None if text is None else (text, f"cf_{kind}")


# Dispatchers: a page's rejected form and its label


def loop(page: str, rng: random.Random, start=(0.01, 0.95), how="random", indent=True, extra_html=(), extra_css=(), sizes=(2, 3), multi=True) -> tuple[str, str]:
    at = int(len(page) * rng.uniform(*start))
    css = CSS_KINDS if multi else CSS_KINDS[:-1]
    kind = rng.choice((*css, *extra_css) if in_style(page, at) else (*HTML_KINDS, *extra_html))
    return repeated(page, at, len(page), kind, how, rng, indent, sizes), kind


def inline(page: str, rng: random.Random, free: bool = False) -> tuple[str, str]:
    target = rng.randint(min(len(page), max(64, len(page) // 3)), len(page)) if free else len(page)
    at = int(target * rng.uniform(0.01, 0.95))
    kind = rng.choice(CSS_KINDS if in_style(page, at) else HTML_KINDS)
    return repeated(page, at, target, kind, "fill", rng, True), f"inline_{kind}"


def weighted(page: str, rng: random.Random, free: bool = False) -> tuple[str, str]:
    """Half loops, half pages that never end, by their weights; free: of a random length."""
    if not page:
        return page, "cf_pure"
    target = rng.randint(min(len(page), max(64, len(page) // 3)), len(page)) if free else len(page)
    if rng.random() < 0.5:
        return inline(page, rng, free)
    kind = rng.choices(list(WEIGHTED), list(WEIGHTED.values()))[0]
    if kind not in NESTED:
        got = css_bloat(page, rng) if kind == "css_bloat" else unfinished(page, kind, rng)
        if got:
            return (got[0], f"cf_{got[1]}") if kind == "css_bloat" else got
        kind = rng.choice(NESTED)
    return nested(page, kind, target, rng, not free)


def equal_share(page: str, rng: random.Random) -> tuple[str, str]:
    """Each of 25 kinds alike; one that the page can't have gives way to another."""
    if not page:
        return page, "cf_pure"
    for mode, kind in rng.sample(EQUAL, len(EQUAL)):
        if mode == "inline":
            if kind in CSS_KINDS:
                regions = [(a, z) for a, z in style_regions(page) if z - a > 50]
                if not regions:
                    continue
                a, z = rng.choice(regions)
                at = rng.randint(a, z - 1)
            else:
                places = (int(len(page) * rng.uniform(0.01, 0.95)) for _ in range(8))
                at = next((p for p in places if not in_style(page, p)), int(len(page) * 0.05))
            return repeated(page, at, len(page), kind, "fill", rng, True), f"inline_{kind}"
        got = nested(page, kind, len(page), rng) if kind in NESTED else unfinished(page, kind, rng)
        if got:
            return got
    return nested(page, rng.choice(NESTED), len(page), rng)


_MORE = ("stuttering", "attribute", "text_content")
DISPATCHERS: dict[str, Callable[[str, random.Random], tuple[str, str]]] = {
    "base": lambda p, r: loop(p, r, (0.05, 0.75), "trim", False, multi=False),
    "random": lambda p, r: loop(p, r, indent=False),
    "random_more": lambda p, r: loop(p, r, indent=False, extra_html=_MORE),
    "random_most": lambda p, r: loop(p, r, indent=False, extra_html=_MORE, extra_css=("css_large_block", "css_growing_selector"), sizes=(3, 4, 5)),
    "chat_random": loop,
    "chat_length_matched": lambda p, r: loop(p, r, how="fill"),
    "nesting": weighted,
    "nesting_equal_share": equal_share,
    "nesting_free_length": lambda p, r: weighted(p, r, True),
}
