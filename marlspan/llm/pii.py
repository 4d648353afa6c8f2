"""Redaction of private data by candidate gradient boosting.

Generators of high recall propose spans, which may overlap; boosted trees score each by its format
and its context; a threshold of each kind, set on held-out examples, selects; of overlapping
selections the most probable stays (then the longer, then the earlier). The trees are fitted on
generated examples, of both private data and look-alikes, with a seed. Nothing is fitted on documents.
Seven kinds are covered: mail addresses, telephone numbers, IPv4 and IPv6 addresses, payment cards, keys
and other secrets, identity numbers and IBANs; no span has a greatest length. Names, postal addresses
and dates of birth are not candidates: they have no format to go by.

Cases: a null text stays null and has no redaction, an empty one stays empty; texts of any length
are searched whole; equal probabilities fall by length, then place; repeated rows get equal results;
an empty table gives an empty one. Other columns pass through whatever their names (but for FOUND).
"""

from __future__ import annotations

import functools
import ipaddress
import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspan.llm import boosting

#: Examples, seed and the least precision on the held-out half that a threshold must have.
EXAMPLES, SEED, PRECISION = 6000, 5, 0.98
CONTEXT = 32
#: The column of what is found, while it is beside those of documents.
FOUND = "__marlspan_pii_4c1e"

KINDS = ("EMAIL", "PHONE", "IP", "CARD", "SECRET", "ID", "IBAN")
GENERATORS = (
    ("EMAIL", re.compile(r"(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)*")),
    ("PHONE", re.compile(r"(?<![\w.])\+?\(?\d(?:[ ().\-/]{0,2}\d){6,14}(?!\w)")),
    ("IP", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w])")),
    ("IP", re.compile(r"(?<![\w:])[0-9A-Fa-f]*:[0-9A-Fa-f:]*:[0-9A-Fa-f:]*(?!\w)")),
    ("CARD", re.compile(r"(?<![\w.])\d(?:[ -]?\d){11,18}(?!\w)")),
    ("SECRET", re.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|key|bearer)[\"']?\s{0,2}(?:[:=]|is)?\s{0,2}[\"']?([^\s\"'<>]{6,})")),
    ("SECRET", re.compile(r"(?<![\w+/=-])[\w+/=-]{16,}(?![\w+/=-])")),
    ("ID", re.compile(r"(?<![\w-])\d{3}[- ]\d{2}[- ]\d{4}(?![\w-])")),
    ("IBAN", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{2,4}){3,8}(?!\w)")),
)
#: Every generator's matches contain one of these: other texts have no candidate.
TRIGGER = r"[0-9@]|:[0-9A-Fa-f:]|(?i:token|secret|passwd|password|pwd|key|bearer)"

_WORDS = tuple(
    re.compile(rf"(?i)\b(?:{w})\w*[\s:=\"'(#.]{{0,4}}$")
    for w in (
        "token|secret|passw|pwd|api.?key|key|auth|bearer|credential",
        "phone|call|tel|mobile|fax|contact",
        "version|release|v|section|chapter|isbn|license",
        "commit|sha1?|hash|md5|checksum|digest|uuid|revision",
        "card|visa|credit|payment|account|iban",
        "order|invoice|item|part|serial|tracking|ref|number|no",
    )
)

_TRIGGERS = re.compile(r"[0-9@TtSsPpKkBb:](?:(?<=[0-9@])|(?<=:)(?=[0-9A-Fa-f:])|(?<=[Tt])(?i:oken)|(?<=[Ss])(?i:ecret)|(?<=[Pp])(?i:assw|wd)|(?<=[Kk])(?i:ey)|(?<=[Bb])(?i:earer))")
#: Characters around a trigger that hold every match with it, but for what is left of a secret's characters.
REACH = 420
_LOWER, _UPPER = set("abcdefghijklmnopqrstuvwxyz"), set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SOLID = re.compile(r"[^\s\"'<>]*")


def windows(text: str) -> list[tuple[int, int]]:
    """The parts of a text around its triggers, to the ends of unbroken characters, merged."""
    out: list[list[int]] = []
    for m in _TRIGGERS.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and b <= out[-1][1]:
            continue
        b = _SOLID.match(text, b).end()
        while a and (not out or a > out[-1][1]) and not (text[a - 1].isspace() or text[a - 1] in "\"'<>"):
            a -= 1
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2]) and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def mod97(text: str) -> bool:
    s = re.sub(r"\s", "", text)
    s = s[4:] + s[:4]
    return s.isalnum() and s.isascii() and int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def _numbered(s: str) -> bool:
    """Whether groups of hexadecimals and colons are an address; times and hardware addresses aren't."""
    try:
        ipaddress.IPv6Address(s)
    except ValueError:
        return False
    return True


def candidates(text: str, within: list[tuple[int, int]] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind), overlaps included. within: parts that hold all of them."""
    found = set()
    for lo, hi, kind, pattern in ((lo, hi, *g) for lo, hi in (windows(text) if within is None else within) for g in GENERATORS):
        for m in pattern.finditer(text, lo, hi):
            g = 1 if pattern.groups else 0
            a, b = m.span(g)
            while b > a and text[b - 1] in ".,;:!?)" and kind in ("EMAIL", "SECRET", "IP"):
                b -= 1
            if b <= a or (kind == "SECRET" and not g and not any(c.isdigit() for c in m.group())):
                continue
            if kind != "IP" or "." in text[a:b] or _numbered(text[a:b]):
                found.add((a, b, kind))
    return sorted(found)


def features(text: str, a: int, b: int, kind: str) -> list[float]:
    s = text[a:b]
    n = len(s)
    digits = "".join(c for c in s if c.isascii() and c.isdigit())
    count: dict[str, int] = {}
    for c in s:
        count[c] = count.get(c, 0) + 1
    entropy = -sum(v / n * math.log2(v / n) for v in count.values())
    before, after = text[max(0, a - CONTEXT) : a], text[b : b + 8]
    octets = s.split(".")
    valid_ip = len(octets) == 4 and all(o.isdigit() and int(o) < 256 and (o == "0" or o[0] != "0") for o in octets)
    brand = len(digits) in (13, 15, 16, 19) and bool(re.match(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|30", digits))
    host = s.partition("@")[2].rstrip(".")
    return [
        *[float(kind == k) for k in KINDS],
        n,
        len(digits),
        len(digits) / n,
        sum(c.isalpha() for c in s) / n,
        sum(c.isupper() for c in s) / n,
        sum(c in "0123456789abcdefABCDEF" for c in s) / n,
        entropy,
        len(count) / n,
        float(12 <= len(digits) <= 19 and luhn(digits)),
        float(brand),
        float(valid_ip or (kind == "IP" and ":" in s)),
        float(kind == "IBAN" and mod97(s)),
        float(s[0] == "+" or before.endswith("+")),
        float("(" in s and ")" in s),
        float(sum(c in " -./" for c in s)),
        float(bool(re.fullmatch(r"[\w-]+(\.[\w-]+)*\.[A-Za-z]{2,}", host))),
        float(digits.startswith(("0", "9", "666")) if kind == "ID" else 0),
        float(bool(re.match(r"(19|20)\d\d[-/.]", s))),
        float(s.startswith(("AKIA", "ghp_", "sk-", "eyJ"))),
        float(count.keys() & _LOWER != set() and count.keys() & _UPPER != set() and bool(digits)),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before.rstrip()[-1:] in "\"'=:"),
        *[float(bool(w.search(before))) for w in _WORDS],
    ]


def _made(rng: random.Random, kind: str) -> tuple[str, str, int]:
    """Words before, the text of an example, and whether it is private."""
    pick, digits = rng.choice, lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-") for _ in range(n))
    word = lambda: "".join(rng.choice(("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "es", "la", "que", "sch", "ung")) for _ in range(rng.randint(1, 9)))
    private = rng.random() < 0.5
    plain = rng.random() < 0.6  # no telling word before
    sep = pick((" ", "-"))
    if kind == "EMAIL":
        if private:
            return pick(("", "mail ", "contact ")), f"{word()}{pick(('.', '_', '', '+'))}{pick((digits(2), word()))}@{word()}{pick(('', digits(1)))}{pick(('', '.example', '.mail'))}.{pick(('com', 'org', 'net', 'de', 'fr', 'es', 'io'))}", 1
        return "", pick((f"{word()}@{word()}", f"{digits(2)}@{digits(1)}.{digits(2)}", f"{word()}@{digits(2)}", f"@{word()}")), 0
    if kind == "PHONE":
        if private:
            d = pick((f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}", f"{digits(2)} {digits(4)} {digits(4)}"))
            lead = pick(("+1 ", "+44 ", "+33 ", "+49 ", "1-", "")) if "(" not in d or rng.random() < 0.8 else ""
            return "" if plain and (lead or "(" in d) else pick(("phone ", "call ", "tel: ", "mobile ")), lead + d, 1
        return pick(("", "order ", "from ", "ref ", "number ")), pick((f"{pick(('19', '20'))}{digits(2)}-{digits(2)}-{digits(2)}", f"19{digits(2)}-20{digits(2)}", digits(8), digits(12), digits(16), digits(10), f"{digits(2)}.{digits(2)}.{digits(4)}", f"{digits(1)}.{digits(3)}.{digits(3)}.{digits(3)}")), 0
    if kind == "IP":
        if rng.random() < 0.4:
            groups = lambda n: ":".join(hexes(rng.randint(1, 4)) for _ in range(n))
            if private:
                return pick(("", "", "host ", "from ")), pick((groups(8), f"2001:db8::{groups(rng.randint(1, 4))}", f"fe80::{groups(rng.randint(1, 4))}", f"2001:{groups(2)}::{groups(rng.randint(1, 3))}", f"{groups(5).upper()}::{hexes(3).upper()}")), 1
            part = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 4)))
            return pick(("", "class ", "at ", "use ")), pick((f"{part()}::{part()}", f"{part()}::", f"::{part()}", f"{part()}::{digits(1)}")), 0
        if private:
            return pick(("", "", "host ", "from ")), ".".join(str(rng.randint(0 if i else 1, 255)) for i in range(4)), 1
        return pick(("version ", "release ", "v", "section ")), ".".join(str(rng.randint(0, pick((9, 30, 255)))) for _ in range(4)), 0
    if kind == "CARD":
        body = pick(("4", "4", "4", "51", "55", "37", "6011", "22"))
        n = 15 if body == "37" else 16
        body += digits(n - 1 - len(body))
        check = next(c for c in "0123456789" if luhn(body + c))
        if private:
            full = body + check
            if rng.random() < 0.3 and n == 16:
                full = sep.join(full[i : i + 4] for i in range(0, 16, 4))
            return "" if plain else pick(("card ", "visa ", "credit card: ")), full, 1
        r = rng.random()
        if r < 0.5:
            full = digits(16)
            return "" if plain else pick(("order ", "invoice ", "tracking ", "serial ")), full if not luhn(full) else full[:-1] + str((int(full[-1]) + 1) % 10), 0
        if r < 0.8:
            return "", body + pick([c for c in "0123456789" if c != check]), 0
        return "", digits(pick((12, 13, 14, 17, 18))), 0
    if kind == "SECRET":
        if private:
            s = pick((hexes(40), hexes(32), mixed(rng.randint(20, 48)), "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), "ghp_" + mixed(36).replace("-", "x").replace("_", "y"), "sk-" + mixed(40), mixed(rng.randint(100, 900)), "eyJ" + mixed(rng.randint(60, 900))))
            quote = pick(('"', "'", ""))
            if rng.random() < 0.15:
                s = s.upper()
            if s[:3] in ("AKI", "ghp", "sk-", "eyJ") and plain:
                return "", s, 1
            lead = pick(("token", "TOKEN", "secret", "password", "api_key", "API-KEY", "key", "bearer"))
            return f"{lead}{pick((' = ', '=', ': ', ' '))}{quote}", s, 1
        return pick(("commit ", "sha1 ", "md5: ", "checksum ", "", "uuid ", "the key ", "a token ", "secret ")), pick((hexes(40), hexes(32), digits(16), digits(20), f"{hexes(8)}-{hexes(4)}-{hexes(4)}-{hexes(4)}-{hexes(12)}")) if rng.random() < 0.6 else "-".join(word() for _ in range(4)), 0
    if kind == "ID":
        if private:
            return pick(("", "ssn ", "social security ")), f"{rng.randint(100, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}", 1
        return pick(("part ", "item ", "no. ", "serial ")), f"{pick(('000', '666', '9' + digits(2)))}-{digits(2)}-{digits(4)}", 0
    country, body = pick(("DE", "FR", "ES", "GB")), digits(18)
    check = 98 - int(body + "".join(str(int(c, 36)) for c in country) + "00") % 97
    if private:
        return pick(("", "iban ", "account ")), f"{country}{check:02d}{body}", 1
    return pick(("", "part ", "serial ")), f"{country}{(check + rng.randint(1, 90)) % 97:02d}{body}", 0


def examples(n: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and kinds of the candidates that the generators find in generated texts."""
    rng = random.Random(seed)
    x, y, kinds = [], [], []
    syllables = ("th", "er", "on", "an", "re", "ti", "es", "que", "la", "ion", "sch", "der", "ment")
    around = lambda: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 5)))
    while len(y) < n:
        kind = rng.choice(KINDS)
        lead, body, private = _made(rng, kind)
        lead = f"{around()}{rng.choice((' ', '. ', ', ', '\n', '*** ', ' | '))}{lead}" if rng.random() < 0.95 else lead
        close = lead[-1:] if lead[-1:] in "\"'" else ""
        text = lead + body + close + rng.choice((" ", ". ", ", ", "### ", "!! ", "\n", "$$$ ")) + around()
        a, b = len(lead), len(lead) + len(body)
        for s, e, k in candidates(text):
            x.append(features(text, s, e, k))
            # A candidate counts as private when it is this example, give or take an end.
            near = abs(s - a) <= 1 and abs(e - b) <= 1
            y.append(float(private and near and (k == kind or {k, kind} == {"CARD", "CARD"})))
            kinds.append(KINDS.index(k))
    return np.array(x), np.array(y), np.array(kinds)


@functools.cache
def trained(n: int = EXAMPLES, seed: int = SEED) -> tuple[boosting.Model, tuple[float, ...]]:
    """The model, and each kind's threshold: the least with the required precision on held-out examples."""
    x, y, _ = examples(n, seed)
    hx, hy, hk = examples(n, seed + 1)
    half = len(hy) // 2
    model = boosting.calibrated(boosting.fit(x, y), hx[:half], hy[:half])
    p = boosting.probability(model, hx[half:])
    out = []
    for k in range(len(KINDS)):
        own = hk[half:] == k
        q, t = p[own], hy[half:][own]
        grid = [float(c) for c in np.arange(0.1, 0.91, 0.05)]
        hit = [(t[q >= c].sum(), (q >= c).sum()) for c in grid]
        precise = [c for c, (h, n) in zip(grid, hit) if n and h >= PRECISION * n]
        # Where no threshold is precise enough, the one of the best F1.
        out.append(precise[0] if precise else max(zip(grid, hit), key=lambda z: 2 * z[1][0] / (t.sum() + z[1][1] + 1e-9))[0])
    return model, tuple(out)


def selected(texts: list[str], model: boosting.Model, thresholds: tuple[float, ...]) -> list[list[tuple[int, int, str, float]]]:
    """Each text's redactions, (start, end, kind, probability), without overlap, by place."""
    found = [candidates(t) if t else [] for t in texts]
    rows = [features(t, *c) for t, own in zip(texts, found) for c in own]
    p = iter(boosting.probability(model, np.array(rows)).round(6).tolist() if rows else [])
    result = []
    for own in found:
        ranked = sorted((-q, a - b, a, b, k) for (a, b, k), q in zip(own, p) if q >= thresholds[KINDS.index(k)])
        out: list[tuple[int, int, str, float]] = []
        for q, _, a, b, k in ranked:
            if all(b <= s or e <= a for s, e, _, _ in out):
                out.append((a, b, k, -q))
        result.append(sorted(out))
    return result


def redact(text: str, spans: list[tuple[int, int, str, float]]) -> str:
    parts, at = [], 0
    for a, b, kind, _ in spans:
        parts += [text[at:a], f"[{kind}]"]
        at = b
    return "".join(parts) + text[at:]


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("probability", T.DoubleType())])
RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("spans", T.ArrayType(_SPAN))])
_ARROW_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])


def redacted(docs: DataFrame) -> DataFrame:
    """docs with FOUND: struct(text, spans), null where nothing is redacted."""
    model, thresholds = trained()

    @F.arrow_udf(RESULT)
    def found(text: pa.Array) -> pa.Array:
        whole, spans = [], []
        texts = text.to_pylist()
        for t, own in zip(texts, selected(texts, model, thresholds)):
            whole.append(redact(t, own) if own else None)
            spans.append([{"kind": k, "start": a, "end": b, "probability": p} for a, b, k, p in own] if own else None)
        return pa.StructArray.from_arrays([pa.array(whole, pa.string()), pa.array(spans, pa.list_(_ARROW_SPAN))], names=["text", "spans"])

    # Texts without a trigger have no candidate: they don't go to Python.
    return docs.withColumn(FOUND, found(F.when(F.col("text").rlike(TRIGGER), F.col("text"))))


def private_data(docs: DataFrame) -> DataFrame:
    """doc_id, redacted text, and the redactions with places in the text as it came (empty: none)."""
    got = redacted(docs.select("doc_id", "text"))
    none = F.from_json(F.lit("[]"), T.ArrayType(_SPAN))
    return got.select("doc_id", F.coalesce(f"{FOUND}.text", "text").alias("text"), F.coalesce(f"{FOUND}.spans", none).alias("redactions"))


def keep_redacted(docs: DataFrame) -> DataFrame:
    """docs with redacted texts; n_chars, if there, counts the new text's characters where it changed."""
    got = redacted(docs)
    changed = F.col(f"{FOUND}.text").isNotNull()
    new = {"text": F.coalesce(f"{FOUND}.text", "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(f"{FOUND}.text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return got.withColumns(new).select(docs.columns)
