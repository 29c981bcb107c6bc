"""Personal data: generators propose spans, boosted trees choose among them.

Base spans (email, ip, card, phone in strict formats) are always reported. A
wider set of generators proposes further, overlapping spans (written-out
addresses, national phone numbers, social security numbers, bank accounts, IPv6);
trees trained on made-up snippets score them by format and context, and each
kind's threshold on the calibrated probability is set for a precision on
held-out snippets.
"""

from __future__ import annotations

import bisect
import functools
import random
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import boosting

BASE = ("email", "ip", "card", "phone")
MORE = ("email2", "phone2", "ssn", "iban", "ipv6", "card2")
PLACE = {kind: i for i, kind in enumerate(BASE + MORE)}
SPANS = "array<struct<start:int,place:int,end:int,kind:string>>"

Span = tuple[int, int, int, str]  # start, place of the kind, end, kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WIDE_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _addresses(text: str, local: Callable[[str], bool], domain: re.Pattern) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, led by the @ signs, so that long runs
    without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and local(text[start - 1]):
            start -= 1
        end = domain.match(text, at + 1) if start < at else None
        if end:
            done = end.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    """Whether a number without leading zeros is at most 255."""
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """The strict kinds, each leftmost and non-overlapping, failing matches dropped."""
    out = [(s, 0, e, "email") for s, e in _addresses(text, _LOCAL.__contains__, _DOMAIN)]
    if not _DIGIT.search(text):
        return out
    for chain in _DOTTED.finditer(text):
        parts, start = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(_small(p.lstrip("0")) for p in four):
                out.append((start, 1, end, "ip"))
            start = end + 1
    for m in _CHAIN.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


# Written-out addresses, led by their "(at)"; its two sides are read from there.
_AT = re.compile(r"\s?[\[(]\s?at\s?[\])]\s?", re.I)
_WRITTEN_DOMAIN = re.compile(r"[\w-]+(?:(?:\.|\s?[\[(]\s?dot\s?[\])]\s?)[\w-]+)+", re.I)
_COLONS = re.compile("[0-9A-Fa-f:]{3,}")
#: The longest written IPv6 address (of 8 groups of 4), and lengths of bank account numbers.
IPV6_CHARS, IBAN_CHARS = 39, range(15, 35)
_GENERATORS = {
    "phone2": re.compile(r"(?<![0-9])(?:\([0-9]{2,5}\)[-\x20]?|00[0-9]{1,3}[-./\x20]?)?[0-9]{2,6}(?:[-./\x20][0-9]{2,6})+(?![0-9])"
                         r"|(?<![0-9])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,4}[-./\x20]|00[0-9]{1,3}[-./\x20]?)[0-9]{3,4}[-./\x20]?[0-9]{3,5}(?![0-9])"),
    "ssn": re.compile(r"(?<![0-9])[0-9]{3}[-\x20][0-9]{2}[-\x20][0-9]{4}(?![0-9])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]{4}){2,7}(?:\x20?[A-Za-z0-9]{1,3})?(?![A-Za-z0-9])"),
    "card2": re.compile(r"(?<![0-9])[0-9]{4}(?:[-.\x20/]{1,3}[0-9]{4}){2}[-.\x20/]{1,3}[0-9]{2,7}(?![0-9])"),
}


def _written(text: str) -> Iterator[tuple[int, int]]:
    """Addresses such as ``name (at) host (dot) org``, of any length."""
    done = 0
    for at in _AT.finditer(text):
        start = at.start()
        while start > done and (text[start - 1].isalnum() or text[start - 1] in "_.+-"):
            start -= 1
        end = _WRITTEN_DOMAIN.match(text, at.end()) if start < at.start() else None
        if end:
            done = end.end()
            yield start, done


def _colon_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of hexadecimal digits and two or more colons that can be IPv6 addresses;
    a single colon at either end belongs to the sentence."""
    for m in _COLONS.finditer(text):
        start, end = m.span()
        start += text[start] == ":" and text[start + 1] != ":"
        end -= text[end - 1] == ":" and text[end - 2] != ":"
        alone = not text[max(0, start - 1):start].isalnum() and not text[end:end + 1].isalnum()
        if alone and end - start <= IPV6_CHARS and text.count(":", start, end) >= 2:
            yield start, end


def is_ipv6(body: str) -> bool:
    """Eight groups of at most four digits, or fewer with one ``::`` for the rest."""
    sides = body.split("::")
    given = [g for side in sides for g in side.split(":") if side]
    fits = len(given) <= 7 if len(sides) == 2 else len(sides) == 1 and len(given) == 8
    return fits and all(1 <= len(g) <= 4 for g in given)


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of the further kinds."""
    out = [(s, PLACE["email2"], e, "email2") for s, e in _addresses(text, lambda c: c.isalnum() or c in "._%+-", _WIDE_DOMAIN)]
    out += [(s, PLACE["email2"], e, "email2") for s, e in _written(text)]
    if "::" in text or _DIGIT.search(text):
        out += [(s, PLACE["ipv6"], e, "ipv6") for s, e in _colon_runs(text)]
    if _DIGIT.search(text):
        for kind, pattern in _GENERATORS.items():
            out += [(m.start(), PLACE[kind], m.end(), kind) for m in pattern.finditer(text)]
    return out


#: Words that speak for a kind, and for none, in the text just before a span.
HINTS = {
    "email": ("mail", "contact", "write", "reach"), "phone": ("phone", "tel", "call", "mobile", "fax"),
    "card": ("card", "visa", "credit", "payment"), "ssn": ("ssn", "social", "security"),
    "iban": ("iban", "account", "bank", "transfer"), "ip": ("ip", "host", "address", "server", "login"),
    "none": ("order", "invoice", "version", "isbn", "serial", "part", "ref", "price", "total", "page", "build", "date", "hash"),
}


def features(text: str, span: Span) -> list[float]:
    """Format and context of one proposal."""
    start, place, end, _ = span
    body, before, after = text[start:end], text[max(0, start - 40):start].lower(), text[end:end + 20]
    digits = "".join(c for c in body if c in "0123456789")
    letters = [c for c in body if c.isalpha()]
    packed = "".join(c for c in body if c.isalnum()).upper()
    money = packed[4:] + packed[:4]
    valid = len(packed) in IBAN_CHARS and packed.isascii() and int("".join(str(int(c, 36)) for c in money)) % 97 == 1
    groups = re.findall("[0-9]+", body[:80])
    seps = [c for c in body if not c.isalnum()]
    return [
        place, len(body), len(digits), len(letters), len(set(digits)), sum(c.isupper() for c in letters),
        len(seps), len(set(seps)), float(luhn(digits)) if digits else -1.0, float(valid),
        float(body[:1] == "("), float("-" in body), float(" " in body), float("." in body), float("/" in body),
        float(text[start - 1:start].isalnum()) if start else 0.0, float(after[:1].isalnum()),
        float(text[start - 1:start] in "-./#$€_") if start else 0.0, float(after[:1] in ("-", "/", "_", "%")),
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in after), float(digits[:1] or 0),
        float(digits[:3] in ("000", "666") or digits[:1] == "9"), float(is_ipv6(body)),
        len(groups), min(map(len, groups), default=0), max(map(len, groups), default=0),
        float(len(groups) == 3 and 4 in (len(groups[0]), len(groups[2])) and len(groups[1]) == 2),
        *(float(any(re.search(rf"\b{w}", before) for w in words)) for words in HINTS.values()),
    ]


def _made(rng: random.Random) -> tuple[str, str, bool]:
    """One made-up body, its kind and whether it is personal data."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(2, 9)))
    sep = rng.choice("- .")
    kind = rng.choice(MORE)
    good = rng.random() < 0.5
    if kind == "email2":
        body = rng.choice([f"{word()}@{word()}ü.de", f"{word()} (at) {word()} (dot) com", f"{word()}.é{word()}@{word()}.org",
                           f"{word()}[at]{word()}.net"]) if good else rng.choice([f"{word()}é@2.0", f"ü{word()}@1.2.3", f"{word()} (at) 5.30"])
    elif kind == "phone2":
        z = lambda n: "0" + d(n - 1)
        day, month, year = f"{rng.randint(1, 31):02d}", f"{rng.randint(1, 12):02d}", str(rng.randint(1900, 2040))
        body = rng.choice([
            f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}{sep}{d(3)}{sep}{d(4)}", f"00{d(2)} {d(3)} {d(5)}", sep.join([z(2), *(d(2) for _ in range(4))]),
            f"{z(3)}{sep}{d(4)}{sep}{d(4)}", f"{z(5)}{sep}{d(5)}", f"{z(5)} {d(6)}", f"({z(rng.randint(3, 5))}) {d(4)} {d(4)}", f"{z(4)}{sep}{d(2)}{sep}{d(2)}{sep}{d(2)}",
            f"{z(3)} {d(3)} {d(2)} {d(2)}", f"00{d(2)} {d(2)} {d(3)} {d(4)}"]) if good else rng.choice([
            f"{d(4)}-{d(4)}", f"{d(2)}/{d(4)}", f"{d(3)}.{d(3)}", f"{d(3)} {d(3)}", f"20{d(2)} {d(4)}", f"{d(4)}.{d(3)}.{d(3)}",
            f"{year}-{month}-{day}", f"{day}.{month}.{year}", f"{month}/{day}/{year}", f"{year}-{year}", f"{d(2)}.{d(2)}", f"{d(2)} {d(3)} {d(3)}",
            f"978-{d(2)}-{d(4)}-{d(3)}-{d(2)}", f"{d(2)}.{d(2)}.{d(2)}.{d(2)}", " ".join(d(rng.randint(2, 5)) for _ in range(rng.randint(2, 8))),
            f"{day}-{month}-{year} {d(2)}", f"{d(3)}-{d(3)}"])
    elif kind == "ssn":
        body = f"{rng.randint(1, 8)}{d(2)}-{d(2)}-{d(4)}" if good else rng.choice([f"9{d(2)}-{d(2)}-{d(4)}", f"000-{d(2)}-{d(4)}", f"{d(3)} {d(2)} {d(4)}"])
    elif kind == "iban":
        tail = d(18)
        check = 98 - int(tail + "131400") % 97
        check = f"{check:02d}"
        body = f"DE{check}{tail}"
        if rng.random() < 0.3:
            body = body.lower()
        if rng.random() < 0.5:
            body = " ".join(body[i:i + 4] for i in range(0, len(body), 4))
        if not good:
            four = lambda: "".join(rng.choice("abcdefnorst") for _ in range(4))
            body = f"{rng.choice('ABDEFGabde')}{rng.choice('CDEFRScdef')}{d(2)} " + rng.choice([
                d(4) + " " + d(4), "".join(rng.choice("ABCDEF0123") for _ in range(12)), f"{four()} {four()}", f"{four()} {d(4)} {four()}"])
    elif kind == "ipv6":
        h = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
        some = lambda n: ":".join(h(rng.randint(1, 4)) for _ in range(n))
        cut = rng.randint(0, 5)
        body = rng.choice([some(8), f"{some(cut)}::{some(rng.randint(1, 6 - cut))}", f"{some(rng.randint(1, 5))}::"]) if good else rng.choice([
            ":".join(d(2) for _ in range(rng.randint(3, 5))), "::".join(h(rng.randint(1, 3)) for _ in range(3)), some(rng.randint(3, 7)), f"{d(2)}:{d(2)}:{d(2)}", some(9),
            f"{some(rng.randint(1, 2))}::{some(rng.randint(1, 2))}::{some(1)}", f"{some(rng.randint(4, 6))}::{some(rng.randint(4, 6))}"])
    else:
        first = d(15)
        last = next(c for c in "0123456789" if luhn(first + c) == good)
        full = first + last
        body = rng.choice([".", " / ", "--"]).join(full[i:i + 4] for i in range(0, 16, 4))
    return body, kind, good


def _snippets(rows: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = random.Random(seed)
    key = {"email2": "email", "phone2": "phone", "ipv6": "ip", "card2": "card"}
    x, y, kinds = [], [], []
    while len(x) < rows:
        body, kind, good = _made(rng)
        if rng.random() < (0.6 if good else 0.4):
            hint = rng.choice(HINTS[key.get(kind, kind) if good or rng.random() < 0.1 else "none"])
            lead = f"{hint}{rng.choice([' ', ': ', ' no. ', ' is '])}"
        else:
            lead = rng.choice(["the ", "and ", "", "at ", "of "])
        glue = "" if good or rng.random() < 0.7 else rng.choice("#$-/_")
        text = " ".join(rng.choice(["the", "of", "and", "in", "to", "is"]) for _ in range(rng.randint(0, 6)))
        text = f"{text} {lead}{glue}{body}{'' if good or rng.random() < 0.7 else rng.choice('%-/_x')} and more of it"
        place = text.index(body)
        for span in candidates(text):
            x.append(features(text, span))
            y.append(float(good and span[3] == kind and span[0] == place and span[2] == place + len(body)))
            kinds.append(span[1])
    return np.array(x), np.array(y), np.array(kinds)


@functools.lru_cache(maxsize=4)
def model(rows: int = 3000, precision: float = 0.97, seed: int = 11) -> tuple[boosting.Trees, dict[int, float]]:
    """Trees and a probability threshold per kind. Trained on the driver from
    ``rows`` made-up proposals (the bound of the training set), calibrated on half
    as many others."""
    x, y, _ = _snippets(rows, seed)
    trees = boosting.fit(x, y)
    held, labels, kinds = _snippets(rows // 2, seed + 1)
    boosting.calibrate(trees, held, labels)
    p = trees.probability(held)
    return trees, {k: max(0.5, boosting.threshold(p[kinds == k], labels[kinds == k], precision)) for k in np.unique(kinds)}


def all_spans(text: str, trees: boosting.Trees, limits: dict[int, float]) -> tuple[list[Span], list[Span]]:
    """Base spans, and all chosen spans: base ones first, then proposals by
    probability as far as they overlap nothing chosen before."""
    base = base_spans(text)
    proposed = candidates(text)
    chosen = list(base)
    if proposed:
        p = trees.probability(np.array([features(text, s) for s in proposed]))
        # Chosen extents by start: a proposal is compared with its neighbours only.
        extents = _merged(base)
        starts = [s for s, _ in extents]
        for i in np.argsort(-p, kind="stable"):
            span = proposed[i]
            if p[i] < limits.get(span[1], 2.0):
                continue
            k = bisect.bisect_right(starts, span[0])
            if (k and extents[k - 1][1] > span[0]) or (k < len(starts) and starts[k] < span[2]):
                continue
            starts.insert(k, span[0])
            extents.insert(k, (span[0], span[2]))
            chosen.append(span)
    return base, sorted(chosen)


def _merged(spans: list[Span]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, _, end, _ in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _array(rows: list[list[Span]]) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("place", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    return pa.array([[dict(zip(("start", "place", "end", "kind"), s)) for s in spans] for spans in rows], kind)


def find_pii(text: Column) -> Column:
    """Struct (base, spans) of arrays (start, place, end, kind), sorted; positions
    are code points, end exclusive. Null and empty texts have none; rows are
    independent, so repeated rows agree."""
    trees, limits = model()

    @F.arrow_udf(f"struct<base:{SPANS},spans:{SPANS}>")
    def run(texts: pa.Array) -> pa.Array:
        found = [all_spans(t.as_py() or "", trees, limits) for t in texts]
        return pa.StructArray.from_arrays([_array([f[0] for f in found]), _array([f[1] for f in found])], ["base", "spans"])

    return run(text)


def redact(text: Column) -> Column:
    """The text with every chosen span (overlapping ones as one) replaced by its
    first kind in capitals and brackets, such as ``[EMAIL]``; null stays null."""
    trees, limits = model()

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if (t := x.as_py()) is None else _redacted(t, all_spans(t, trees, limits)[1]) for x in texts], pa.string())

    return run(text)


def _redacted(text: str, spans: list[Span]) -> str:
    if not spans:
        return text
    kind = {s[0]: s[3] for s in reversed(spans)}
    out, at = [], 0
    for start, end in _merged(spans):
        out += [text[at:start], f"[{kind[start].rstrip('2').upper()}]"]
        at = end
    return "".join(out + [text[at:]])
