"""Personal data (12): a semi-Markov conditional random field over candidate spans, beside fixed patterns.

The patterns of ``base_spans`` stand.  What they miss (other notations,
numbers that run together with their neighbours) is found by a semi-Markov
field: candidate spans of bounded length, each with the types that its
characters allow, have features of the whole span (groups of digits,
separators, check sums, what stands before and behind, the words before);
the weight of a segmentation is the sum over its entities, plus a term for
entities that follow each other closely, and text outside has weight 0.  A
dynamic program over the candidates by their ends chooses boundaries and
types jointly.  Candidates that overlap a base span are left out.

The weights are trained here, by gradient ascent on the likelihood of
segmentations: entities of all types, and numbers that are none (dates,
prices, versions, article numbers), are written in many notations into
passages of at most ``CARRIERS`` documents, chosen by hash.  That sample is
bounded whatever the size of the table; the search covers all texts whole.
"""

from __future__ import annotations

import functools
import ipaddress
import math
import random
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapmart.llm.common import byte_groups, prepare

# Documents whose passages carry the training entities, the characters of a passage, and the examples made.
CARRIERS = 300
PASSAGE = 400
EXAMPLES = 1800
EPOCHS = 8
RATE, DECAY = 0.25, 1e-4
# Bounds of an entity: groups of digits, characters.
MOST_GROUPS = 8
MOST_CHARS = 64
# Entities of an island are at most so many characters apart; closer than NEAR they have a weight as neighbours.
ISLAND_GAP = 80
NEAR = 3
# What a segmentation with entities must weigh more than the one without.
MARGIN = 1.0

# fixed values: types as they are listed in results
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "ssn", "iban")
_ORDER = {k: i for i, k in enumerate(KINDS)}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, leftmost and non-overlapping per kind; time is linear in the text."""
    out = []
    at, floor = text.find("@"), 0
    while at >= 0:
        first = at
        while first > floor and text[first - 1] in _LOCAL:
            first -= 1
        m = _DOMAIN.match(text, at + 1) if first < at else None
        if m:
            out.append(("email", first, m.end()))
            floor = m.end()
        at = text.find("@", m.end() if m else at + 1)
    for m in _DOTTED.finditer(text):
        parts, where = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(map(_octet, four)):
                out.append(("ip", where, where + size))
            where += size + 1
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# --------------------------------------------------------------------------- candidates

_STRETCH = re.compile(r"[+(\[]{0,2}[0-9](?:[\])]?[  .,/_·:‐-―()\[\]+-]{0,3}[0-9])+")
_DIGITS = re.compile(r"[0-9]+")
_DOT = r"(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\sdot\s|\s?\.\s?)"
_AT = re.compile(r"\s?[\[({<]\s?(?:at|@)\s?[\])}>]\s?|\sat\s|\s?[@＠]\s?", re.I)
_LABELS = re.compile(rf"[^\W_][\w-]{{0,40}}(?:{_DOT}[^\W_][\w-]{{0,40}}){{1,4}}", re.I)
_DOTS = re.compile(_DOT, re.I)
_V6 = re.compile(r"(?<![\w:])(?=[0-9A-Fa-f]*:)[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,8}(?![\w:])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[ -]?[A-Z0-9]{1,4}){3,8}(?!\w)")
_WORDS = re.compile(r"[^\W\d_]+")


def _class(c: str) -> str:
    return "" if not c else "0" if c.isdigit() else "a" if c.isalpha() else " " if c.isspace() else c


@functools.lru_cache(1 << 14)
def _numeric(span: str) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """(kind, features) for each type that a span of digits and separators may have."""
    digits = "".join(_DIGITS.findall(span))
    groups = [len(g) for g in _DIGITS.findall(span)]
    seps = _DIGITS.split(span)[1:-1]
    kinds = "".join(sorted(set("".join(seps))))
    n = len(digits)
    same = len(set(seps)) <= 1
    shape = "-".join(map(str, groups))
    lead = span[0] if span[0] in "+([" else digits[:2] if digits.startswith("00") else digits[0] if digits[0] in "01" else ""
    common = (f"n{n}", f"g{shape}", f"s{kinds}", f"s{kinds}n{n}", f"l{lead}", f"same{same}", f"k{len(groups)}",
              f"last{groups[-1]}", f"most{max(groups)}", f"b{span.count('(') == span.count(')')}")
    values = [int(g) for g in _DIGITS.findall(span)]
    if len(groups) == 3 and sorted(groups) in ([1, 1, 4], [1, 2, 4], [2, 2, 4], [1, 1, 2], [1, 2, 2], [2, 2, 2]):
        if sum(v <= 12 for v in values) >= 1 and sum(v <= 31 for v in values) >= 2 and "(" not in span:
            common += ("date",)
    if n == 8 and groups == [8] and digits[:2] in ("19", "20") and digits[4:6] <= "12":
        common += ("date",)
    if n in (10, 13) and digits[:3] in ("978", "979"):
        common += ("isbn",)
    if len(groups) > 1 and groups[0] <= 3 and set(groups[1:]) == {3} and same:
        common += ("thousands",)
    out = []
    if 7 <= n <= 15:
        out.append(("phone", common))
    if 13 <= n <= 19:
        out.append(("card", (*common, f"luhn{luhn(digits)}", f"first{digits[0]}", f"luhn{luhn(digits)}n{n}same{same}")))
    if n == 9 and groups in ([3, 2, 4], [9]):
        area = digits[:3]
        out.append(("ssn", (*common, f"area{area not in ('000', '666') and area < '900' and digits[3:5] != '00'}")))
    if len(groups) == 4 and max(groups) <= 3 and max(values) <= 255 and same and "." in kinds and kinds != ".":
        out.append(("ip", common))
    return tuple(out)


def _around(text: str, a: int, b: int) -> tuple[str, ...]:
    before, after = text[a - 1:a], text[b:b + 1]
    words = _WORDS.findall(text, max(0, a - 32), a)[-3:]
    more = "0" if re.match(r"[ .-]?[0-9]", text[b:b + 2]) else ""
    less = "0" if re.search(r"[0-9][ .-]?$", text[max(0, a - 2):a]) else ""
    return (f"<{_class(before)}", f">{_class(after)}", f"more{more}", f"less{less}",
            *{f"w{w.lower()[:12]}" for w in words})


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str, tuple[str, ...]]]:
    """(start, end, kind, features) of the spans that may be entities, by end and start, clear of ``taken``."""
    found: dict[tuple[int, int, str], tuple[str, ...]] = {}
    starts, ends = [a for a, _ in taken], [b for _, b in taken]

    def clear(a, b):
        i = bisect_right(ends, a)
        return i == len(starts) or starts[i] >= b

    for m in _STRETCH.finditer(text):
        groups = [(g.start(), g.end()) for g in _DIGITS.finditer(text, m.start(), m.end())]
        for i, (a, _) in enumerate(groups):
            lead = a
            while lead > m.start() and lead > a - 2 and text[lead - 1] in "+([":
                lead -= 1
            n = 0
            for size, (x, b) in enumerate(groups[i:i + MOST_GROUPS], 1):
                n += b - x
                if n > 19 or b - lead > MOST_CHARS:
                    break
                for first in {a, lead} if n >= 7 or size == 4 else ():
                    if clear(first, b):
                        for kind, features in _numeric(text[first:b]):
                            found[first, b, kind] = features
    for m in _AT.finditer(text):
        labels = _LABELS.match(text, m.end())
        if not labels:
            continue
        dots = list(_DOTS.finditer(text, labels.start(), labels.end()))
        form = re.sub(r"\s", " ", m[0].lower())
        if form == " at " and not any("dot" in d[0].lower() for d in dots):
            continue
        a = m.start()
        while a > 0 and a > m.start() - 40 and (text[a - 1].isalnum() or text[a - 1] in "._%+-"):
            a -= 1
        while a < m.start() and not text[a].isalnum():
            a += 1
        if a == m.start():
            continue
        for j, d in enumerate(dots):
            b = dots[j + 1].start() if j + 1 < len(dots) else labels.end()
            last = text[d.end():b]
            if b - a > MOST_CHARS or not clear(a, b):
                continue
            forms = {re.sub(r"\s", " ", x[0].lower()) for x in dots[:j + 1]}
            found[a, b, "email"] = (f"@{form}", f"tld{len(last) if last.isalpha() else 0}", f"labels{j + 2}", *(f".{x}" for x in forms),
                                    f"title{last[:1].isupper() and not last.isupper()}", f"ascii{text[a:b].isascii()}",
                                    f"local{min(3, m.start() - a)}", f"rest{j + 1 < len(dots)}")
    for m in _V6.finditer(text):
        a, b = m.span()
        groups = m[0].split(":")
        try:
            valid = bool(ipaddress.IPv6Address(m[0]))
        except ValueError:
            valid = False
        if _DIGITS.search(m[0]) and clear(a, b):
            found[a, b, "ip"] = (f"v6{valid}", f"groups{len(groups)}", f"long{max(map(len, groups))}", f"dbl{'::' in m[0]}",
                                 f"dec{m[0].replace(':', '').isdigit()}")
    for m in _IBAN.finditer(text):
        for b in sorted({m.end(), *(m.start() + x.start() for x in re.finditer("[ -]", m[0]))}):
            span = re.sub("[ -]", "", text[m.start():b])
            if 15 <= len(span) <= 34 and clear(m.start(), b):
                value = int("".join(str(int(c, 36)) for c in span[4:] + span[:4]))
                found[m.start(), b, "iban"] = (f"mod{value % 97 == 1}", f"size{len(span) // 4}")
    return [(a, b, kind, tuple(f"{kind}|{f}" for f in ("", *features, *_around(text, a, b))))
            for (a, b, kind), features in sorted(found.items(), key=lambda x: (x[0][1], x[0][0], _ORDER[x[0][2]]))]


def islands(found: list) -> list[list]:
    """Candidates in groups that stand apart."""
    out, reach = [], -1 << 60
    for c in sorted(found, key=lambda c: c[0]):
        if c[0] > reach + ISLAND_GAP:
            out.append([])
        out[-1].append(c)
        reach = max(reach, c[1])
    return [sorted(g, key=lambda c: (c[1], c[0], _ORDER[c[2]])) for g in out]


# --------------------------------------------------------------------------- the field

def _links(group: list) -> list[tuple[int, list[int]]]:
    """For each candidate: how many end well before it starts, and those that end close before."""
    ends = [c[1] for c in group]
    out = []
    for a, *_ in group:
        far = bisect_right(ends, a - NEAR - 1)
        out.append((far, list(range(far, bisect_right(ends, a)))))
    return out


def _pair(first: str, second: str) -> str:
    return f"near|{first}|{second}"


def decode(group: list, weights: dict[str, float]) -> list[tuple[str, int, int]]:
    """The entities of the segmentation with the greatest weight, if that is above ``MARGIN``."""
    best, came = [0.0], [None]          # over the first m candidates: weight, last entity
    weight, before = [], []
    for c, (far, near) in zip(group, _links(group), strict=True):
        top, link = best[far], came[far]
        for j in near:
            x = weight[j] + weights.get(_pair(group[j][2], c[2]), 0.0)
            if x > top:
                top, link = x, j
        weight.append(top + sum(weights.get(f, 0.0) for f in c[3]) - MARGIN)
        before.append(link)
        better = weight[-1] > best[-1]
        best.append(weight[-1] if better else best[-1])
        came.append(len(weight) - 1 if better else came[-1])
    out, j = [], came[-1]
    while j is not None:
        a, b, kind, _ = group[j]
        out.append((kind, a, b))
        j = before[j]
    return out[::-1]


class _Example:
    """An island with its feature numbers and the candidates that are entities."""

    def __init__(self, group: list, truth: set, number: dict[str, int]):
        self.links = _links(group)
        rows = [[number.setdefault(f, len(number)) for f in c[3]] for c in group]
        self.index = np.array([i for r in rows for i in r], np.int64)
        self.first = np.cumsum([0] + [len(r) for r in rows[:-1]])
        self.size = np.array([len(r) for r in rows])
        self.pairs = {(j, i): number.setdefault(_pair(group[j][2], group[i][2]), len(number))
                      for i, (_, near) in enumerate(self.links) for j in near}
        self.truth = np.array([(c[2], c[0], c[1]) in truth for c in group], float)

    def gradient(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(feature numbers, gradient of the log likelihood at each)."""
        score = np.add.reduceat(w[self.index], self.first).tolist()
        n = len(score)
        total, alpha, into = [0.0], [], []
        for i, (far, near) in enumerate(self.links):
            terms = [total[far], *(alpha[j] + w[self.pairs[j, i]] for j in near)]
            top = max(terms)
            into.append(top + math.log(sum(math.exp(t - top) for t in terms)))
            alpha.append(score[i] + into[i])
            top = max(total[i], alpha[i])
            total.append(top + math.log(math.exp(total[i] - top) + math.exp(alpha[i] - top)))
        of_total, of_alpha = [0.0] * n + [1.0], [0.0] * n
        index, value = [], []
        for i in range(n - 1, -1, -1):
            of_total[i] += of_total[i + 1] * math.exp(total[i] - total[i + 1])
            of_alpha[i] += of_total[i + 1] * math.exp(alpha[i] - total[i + 1])
            far, near = self.links[i]
            of_total[far] += of_alpha[i] * math.exp(total[far] - into[i])
            for j in near:
                share = of_alpha[i] * math.exp(alpha[j] + w[self.pairs[j, i]] - into[i])
                of_alpha[j] += share
                index.append(self.pairs[j, i])
                value.append(self.truth[j] * self.truth[i] - share)
        each = np.repeat(self.truth - np.array(of_alpha), self.size)
        return np.concatenate([self.index, np.array(index, np.int64)]), np.concatenate([each, np.array(value)])


@functools.lru_cache(4)
def train(passages: tuple[str, ...], seed: int = 12) -> dict[str, float]:
    """Weights by feature; the same for the same passages."""
    rng = random.Random(seed)
    number: dict[str, int] = {}
    examples = []
    while len(examples) < EXAMPLES:
        text, truth = example(rng, passages)
        examples += [_Example(g, truth, number) for g in islands(candidates(text, []))]
    w, seen = np.zeros(len(number)), np.full(len(number), 1e-6)
    for _ in range(EPOCHS):
        rng.shuffle(examples)
        for e in examples:
            index, grad = e.gradient(w)
            at, where = np.unique(index, return_inverse=True)
            g = np.bincount(where, grad) - DECAY * w[at]
            seen[at] += g * g
            w[at] += RATE * g / np.sqrt(seen[at])
    return {f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-3}


# --------------------------------------------------------------------------- training texts

# fixed values: words before entities and before other numbers, in the languages of the corpus
_CUES = {
    "phone": "phone tel call fax mobile telefon téléphone teléfono ruf whatsapp contact",
    "card": "card visa mastercard credit karte carte tarjeta payment",
    "email": "email mail write e-mail correo kontakt contact",
    "ip": "ip host server address from client",
    "ssn": "ssn social security number",
    "iban": "iban account konto compte cuenta bank",
    "": "order invoice id version isbn page total date no ref item code bestellung commande rechnung population",
}


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card_number(rng: random.Random) -> str:
    n = rng.choice([16, 16, 16, 16, 15, 19, 14])
    head = rng.choice("3456") + _digits(rng, n - 2)
    return next(head + d for d in "0123456789" if luhn(head + d))


def _grouped(rng: random.Random, digits: str, sizes: list[int], sep: str) -> str:
    out, at = [], 0
    for s in sizes:
        out.append(digits[at:at + s])
        at += s
    return sep.join([*out, *([digits[at:]] if at < len(digits) else [])])


def _entity(rng: random.Random, kind: str) -> str:
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvwyz") for _ in range(rng.randrange(2, 9)))
    if kind == "phone":
        area, mid, end = str(rng.randrange(201, 990)), _digits(rng, 3), _digits(rng, 4)
        sep = rng.choice([" ", "-", ".", "-", " ", "–", "/", " "])
        cc = rng.choice(["1", "44", "49", "33", "34", "7", "91"])
        return rng.choice([
            f"({area}) {mid}-{end}", f"({area}) {mid} {end}", f"({area}){mid}-{end}", f"{area}{sep}{mid}{sep}{end}",
            f"{area}-{mid}-{end}", f"1-{area}-{mid}-{end}", f"1 ({area}) {mid}-{end}", f"00{cc} {area} {mid} {end}",
            f"00{cc}{area}{mid}{end}", f"(+{cc}) {area} {mid}{end}", f"+{cc} ({area}) {mid}-{end}", f"0{area[:2]}/{mid}{end}",
            f"+{cc}{sep}{area}{sep}{mid}{sep}{end}", f"0{area} {mid}{end}", f"0{area}-{mid}{end}", f"+{cc}{area}{mid}{end}",
            f"{mid}-{end}" if rng.random() < 0.2 else f"({area}) {mid}-{end}",
            "0" + " ".join(_digits(rng, 2) for _ in range(5))[1:], f"{cc}-{area}-{mid}-{end}"])
    if kind == "card":
        c = _card_number(rng)
        sizes = [4, 6] if len(c) < 16 else [4, 4, 4]
        sep = rng.choice([" ", "-", ".", "/", "_", "–", " "])
        return rng.choice([c, _grouped(rng, c, sizes, sep)])
    if kind == "ssn":
        area = f"{rng.choice([*range(1, 666), *range(667, 900)]):03d}"
        return rng.choice(["-", "-", "-", " "]).join([area, f"{rng.randrange(1, 100):02d}", f"{rng.randrange(1, 10000):04d}"])
    if kind == "iban":
        body = rng.choice(["", "ABCD", "NWBK"]) + _digits(rng, rng.choice([14, 18, 20]))
        land = rng.choice(["DE", "GB", "FR", "ES", "NL", "IT"])
        value = int("".join(str(int(c, 36)) for c in body + land)) * 100
        iban = f"{land}{98 - value % 97:02d}{body}"
        return iban if rng.random() < 0.5 else " ".join(iban[i:i + 4] for i in range(0, len(iban), 4))
    if kind == "ip":
        four = [str(rng.randrange(256)) for _ in range(4)]
        six = [f"{rng.randrange(1, 65536):x}" for _ in range(8)]
        cut = rng.randrange(1, 6)
        return rng.choice(["[.]".join(four), "(.)".join(four), " . ".join(four), ":".join(six), ":".join(six),
                           ":".join(six[:cut]) + "::" + ":".join(six[cut + 2:]), "[.]".join(four)])
    local = rng.choice([word(), f"{word()}.{word()}", f"{word()}{rng.randrange(99)}", f"{word()}.{rng.randrange(10, 99)}", f"{word()}_{word()}"])
    name = rng.choice([word(), f"{word()}{rng.randrange(9)}"])
    tld = rng.choice(["com", "org", "net", "de", "fr", "es", "co.uk", "example.com", "edu"]).split(".")
    at = rng.choice([" at ", " [at] ", "[at]", "(at)", " (at) ", " AT ", " @ ", "@ ", " @", "{at}", "＠", "@", "@"])
    dot = rng.choice([" dot ", " [dot] ", "[dot]", "(dot)", " (dot) ", " DOT ", "[.]"])
    if at.strip() in ("@", "＠") or "(" in at or "[" in at:
        dot = rng.choice([dot, ".", "."])
    if at == "@" and dot == ".":
        local = rng.choice("éüñö") + local if rng.random() < 0.5 else local + rng.choice("éüñö")
    return f"{local}{at}{dot.join([name, *tld])}"


def _other(rng: random.Random) -> str:
    """A number, or something like an address, that is no personal data."""
    y, mo, d = rng.randrange(1900, 2040), rng.randrange(1, 13), rng.randrange(1, 29)
    h, mi, s = rng.randrange(24), rng.randrange(60), rng.randrange(60)
    return rng.choice([
        lambda: f"{y}-{mo:02d}-{d:02d}", lambda: f"{d:02d}/{mo:02d}/{y}", lambda: f"{d}.{mo}.{y}", lambda: f"{y}{mo:02d}{d:02d}",
        lambda: f"{y}-{mo:02d}-{d:02d} {h:02d}:{mi:02d}:{s:02d}", lambda: f"{h:02d}:{mi:02d}:{s:02d}", lambda: f"{d}-{mo}-{y}",
        lambda: f"{rng.randrange(10**3, 10**9):,}.{rng.randrange(100):02d}", lambda: f"{rng.randrange(10**6, 10**10):,}".replace(",", rng.choice(" .,")),
        lambda: _digits(rng, rng.randrange(7, 12)), lambda: _digits(rng, rng.randrange(12, 20)),
        lambda: f"978-{_digits(rng, 1)}-{_digits(rng, 2)}-{_digits(rng, 6)}-{_digits(rng, 1)}", lambda: f"978{_digits(rng, 10)}",
        lambda: ".".join(str(rng.randrange(30)) for _ in range(rng.choice([3, 3, 5]))), lambda: f"{y}-{y + rng.randrange(1, 30)}",
        lambda: f"{_digits(rng, 4)}-{_digits(rng, 4)}", lambda: f"{_digits(rng, 3)}-{_digits(rng, 3)}-{_digits(rng, 3)}",
        lambda: " ".join(str(rng.randrange(1000)) for _ in range(rng.randrange(4, 12))), lambda: f"{rng.randrange(90)}.{_digits(rng, 6)}, {rng.randrange(90)}.{_digits(rng, 6)}",
        lambda: "-".join(f"{rng.getrandbits(4 * k):0{k}x}" for k in (8, 4, 4, 4, 12)), lambda: ":".join(f"{rng.randrange(256):02x}" for _ in range(6)),
        lambda: f"{_digits(rng, 2)}-{_digits(rng, 7)}", lambda: f"16{_digits(rng, 8)}", lambda: f"{rng.randrange(1, 20)} @ {rng.randrange(90)}.{_digits(rng, 2)} each",
        lambda: f"@{rng.choice(['user', 'team', 'news'])}{rng.randrange(99)}. The next", lambda: "meet at the dot on it", lambda: f"{_digits(rng, 5)}-{_digits(rng, 4)}",
        lambda: ", ".join(str(rng.randrange(10**4)) for _ in range(6)), lambda: f"{_digits(rng, 8)}-{_digits(rng, 8)}-{_digits(rng, 4)}",
        lambda: f"{_digits(rng, 3)}.{_digits(rng, 3)}.{_digits(rng, 3)}-{_digits(rng, 2)}", lambda: f"{rng.randrange(9)}/{rng.randrange(9)}/{_digits(rng, 6)}",
        lambda: " ".join(_digits(rng, 4) for _ in range(4)),
    ])()


def example(rng: random.Random, passages: tuple[str, ...]) -> tuple[str, set[tuple[str, int, int]]]:
    """(text, its entities): up to three items between words of a passage."""
    words = (rng.choice(passages) if passages else "and the").split() or ["and"]
    at = rng.randrange(len(words))
    text, truth = " ".join(words[at:at + 6]) + rng.choice([" ", " ", ": ", ", ", "\n"]), set()
    for _ in range(rng.choice([1, 1, 2, 3])):
        kind = rng.choice([*KINDS, "card", "phone", "phone", "email", "", "", "", "", "", ""])
        if rng.random() < 0.3:
            text += rng.choice(_CUES[kind].split()) + rng.choice([": ", " ", ". ", " no. ", ":"])
        item = _entity(rng, kind) if kind else _other(rng)
        repeat = 2 if kind and rng.random() < 0.15 else 1
        for i in range(repeat):
            if kind:
                truth.add((kind, len(text), len(text) + len(item)))
            text += item + ("" if i == repeat - 1 else " ")
        text += rng.choice([" ", " ", ". ", ", ", "\n", "%%% ", "!! ", " "])
        at = rng.randrange(len(words))
        text += " ".join(words[at:at + rng.choice([0, 0, 3, 8])]) + " "
    return text, truth


# --------------------------------------------------------------------------- the operator

_TRIGGER = np.zeros(256, bool)
_TRIGGER[0x30:0x3A] = _TRIGGER[0x40] = True
_OPEN = np.zeros(256, bool)
_OPEN[list(b"[({<")] = True
_FULL_AT = "＠".encode()


def _rows_with_triggers(texts: pa.Array):
    """Rows that hold a digit, an at sign, ``at`` up to four bytes behind an opening bracket, or the letters ``dot``:
    all others have no candidates."""
    for lo, _, data, offsets in byte_groups(texts):
        low = data | 0x20
        t = low[1:] == 0x74
        dots = np.flatnonzero(t[1:] & (low[1:-1] == 0x6F) & (low[:-2] == 0x64))
        ats = np.flatnonzero(t & (low[:-1] == 0x61))
        behind = np.zeros(len(ats), bool)
        for back in range(1, 5):
            behind |= (ats >= back) & _OPEN[data[np.maximum(ats - back, 0)]]
        found = np.concatenate([np.flatnonzero(_TRIGGER[data]), dots, ats[behind], np.flatnonzero(data == _FULL_AT[0])])
        rows = np.searchsorted(offsets, found, "right") - 1
        yield from (np.unique(rows) + lo).tolist()


def search(text: str, weights: dict[str, float]) -> tuple[list, list]:
    """(base spans, added spans) of a text, by kind as listed and start."""
    base = sorted(base_spans(text), key=lambda s: (_ORDER[s[0]], s[1]))
    merged: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    added = [s for g in islands(candidates(text, [(a, b) for a, b in merged])) for s in decode(g, weights)]
    return base, sorted(added, key=lambda s: (_ORDER[s[0]], s[1]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SPANS = "array<struct<kind: string, start: long, end: long>>"


def fit(docs: DataFrame) -> dict[str, float]:
    """Weights trained in passages of at most ``CARRIERS`` rows, which come to the driver (some 120,000 characters)."""
    h = F.xxhash64(F.col("doc_id").cast("string"), "text")
    docs = docs.withColumn("h", h)
    few = 4 * CARRIERS / max(1, docs.count())
    if few < 1:  # some four times as many rows as are needed, so that their number doesn't grow with the table
        docs = docs.where(F.col("h") < int(-(1 << 63) + few * (1 << 64)))
    place = F.pmod(F.shiftright("h", 7), F.greatest(F.length("text"), F.lit(1))).cast("int") + 1
    rows = (docs.where(F.length("text") > 0).select("h", F.substr("text", place, F.lit(PASSAGE)).alias("passage"))
            .groupBy("h").agg(F.min("passage").alias("passage")).orderBy("h").limit(CARRIERS).collect())
    return train(tuple(r["passage"] for r in rows))


def personal_data(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Personal data in ``docs(doc_id, text)``, one row per row.

    Returns doc_id, base and added: arrays of (kind, start, end) in code
    points, end exclusive, by kind as listed in ``KINDS`` and start.  ``base``
    has the fixed patterns' spans, ``added`` those of the field, which overlap
    none of them.  Null and empty texts have none; null doc_ids and repeated
    rows are searched like any other; other columns are ignored; an empty
    table gives no rows.  ``weights``: as from ``fit``; by default trained in
    passages of these documents.
    """
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    weights = fit(docs) if weights is None else weights

    def find(batches):
        for batch in batches:
            texts = batch.column("text")
            found = {r: search(texts[r].as_py(), weights) for r in _rows_with_triggers(texts)}
            spans = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in found[r][j]] if r in found else []
                               for r in range(len(texts))], pa.list_(_SPAN)) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *spans], ["doc_id", "base", "added"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(find, f"doc_id {kind}, base {_SPANS}, added {_SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns: counts and digest of base spans, and all spans."""
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(spans: str, kind: str) -> Column:
        return F.filter(spans, lambda s: s["kind"] == kind)

    by_kind = F.flatten(F.array(*(F.array_sort(F.concat(of("base", k), of("added", k))) for k in KINDS)))
    return found.select(
        "doc_id",
        *(F.size(of("base", k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(by_kind).alias("spans"))
