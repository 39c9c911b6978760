"""Personal data by patterns and by a semi-Markov conditional random field.

Four patterns give the base: e-mail addresses, IP addresses, card and phone numbers. Each takes
the leftmost match and drops it if its digits fail a test, so numbers that stand side by side
hide each other: `+1 (269) 555-3296 4524132264652876` is one failing phone number and
one failing card number. The field decides what such stretches hold. A stretch is cut into
segments, each either other text or one whole entity; features look at a segment as a
whole (its digits, groups, check digit, separators, what stands around it), and dynamic
programming over the begins and ends of all candidates finds the best sequence of
segments, so that borders and types are chosen together. An entity has up to ENTITY characters and
TOKENS tokens, so the work is linear in the text.

Weights maximise the likelihood of segmentations: of numbers and addresses made up in many
formats, alone and side by side, of numbers that are nothing personal, and of stretches of the
documents themselves that the patterns explain wholly. All stand in words of a bounded sample
of the documents.
"""

from __future__ import annotations

import bisect
import itertools
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_chunks, texts_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

#: Characters and tokens (groups of digits and the signs between them) of an entity.
ENTITY, TOKENS = 128, 12
#: Documents that the words around training examples come from, and examples.
DOCUMENTS, EXAMPLES = 400, 2400
#: Characters of context on either side of an example.
AROUND = 40

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = str.maketrans("", "", " ().+-")
#: Digits with up to three signs in between.
_STRETCH = re.compile(r"[+(]{0,2}[0-9](?:[ ().+-]{0,3}[0-9])*+")
_TOKEN = re.compile(r"[0-9]+|[^0-9]")
_AT = re.compile(r" ?@ ?| ?[\[({][aA][tT][\])}] ?| [aA][tT] ")
_DOT = re.compile(r"\.| ?[\[({][dD][oO][tT][\])}] ?| [dD][oO][tT] ")
_WRITTEN = re.compile(r"@ | @|[\[({][aA][tT][\])}]|[ \[({][dD][oO][tT][ \])}]")
_NAME = re.compile(r"[A-Za-z0-9-]{1,63}")
_WORDS_BEFORE = re.compile(r"([^\W\d_]+)\W{0,3}$")
#: Words in front of a number that say what it is.
CLUES = {
    "phone": "tel phone telephone call fax mobile cell whatsapp telefon anruf teléfono llame téléphone",
    "card": "card visa mastercard amex credit karte kreditkarte tarjeta carte",
    "ip": "ip host server address adresse addr ping",
    "email": "mail email contact write kontakt correo courriel",
}
_CLUE = {word: kind for kind, words in CLUES.items() for word in words.split()}


# Base patterns


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield "email", begin, end
            at = end
        else:
            at += 1


def octet(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, by begin and kind; each kind by itself without overlaps."""
    found = list(_emails(text)) if "@" in text else []
    for m in _DOTTED.finditer(text):
        if "." in (chain := m.group()) and len(parts := chain.split(".")) > 3:
            begin = m.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                end = begin + sum(map(len, four)) + 3
                if all(map(octet, four)):
                    found.append(("ip", begin, end))
                begin = end + 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().translate(_NO_DIGIT)
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(m.group().translate(_NO_DIGIT)) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


# Candidates and their features


def _numbers(text: str, begin: int, end: int) -> Iterator[Span]:
    """Segments of a stretch of digits that can be an entity at all: they begin with a digit, a
    plus or a bracket, and end with a digit."""
    tokens = [m.span() for m in _TOKEN.finditer(text, begin, end)]
    for i, (a, _) in enumerate(tokens):
        if not (text[a].isdecimal() or text[a] in "+("):
            continue
        signs, digits, groups = "", 0, 0
        for c, b in tokens[i : i + TOKENS]:
            if not text[c].isdecimal():
                signs += text[c]
                continue
            digits, groups = digits + b - c, groups + 1
            if digits > 19 or b - a > ENTITY:
                break
            if groups == 4 and signs == "...":
                yield "ip", a, b
            if digits >= 14 and not signs.strip(" -"):
                yield "card", a, b
            if 10 <= digits <= 15 and "+" not in signs[text[a] == "+" :]:
                yield "phone", a, b


def _addresses(text: str, at: re.Match) -> Iterator[Span]:
    """Addresses around a sign or word for at, up to each part of the domain."""
    begin = at.start()
    while at.start() - begin < ENTITY // 2 and begin and text[begin - 1] in LOCAL:
        begin -= 1
    part = _NAME.match(text, at.end())
    if begin == at.start() or not part:
        return
    while (dot := _DOT.match(text, part.end())) and (part := _NAME.match(text, dot.end())):
        if part.end() - begin > ENTITY:
            return
        yield "email", begin, part.end()


def features(text: str, span: Span) -> tuple[str, ...]:
    """What the model knows of a candidate, as names."""
    kind, a, b = span
    return _features(kind, text[max(0, a - 24) : a], text[a:b], text[b : b + 4])


def _beside(c: str) -> str:
    return "edge" if not c else "digit" if c.isdecimal() else "letter" if c.isalpha() else "space" if c.isspace() else c


@lru_cache(1 << 14)
def _features(kind: str, before: str, line: str, after: str) -> tuple[str, ...]:
    left, right = _beside(before[-1:]), _beside(after[:1])
    out = ["bias", f"left {left}", f"right {right}"]
    if "letter" in (left, right) or "digit" in (left, right):
        out.append("inside a word")
    if any(c.isdecimal() for c in before[-4:]):
        out.append("number before")
    if any(c.isdecimal() for c in after):
        out.append("number after")
    if m := _WORDS_BEFORE.search(before):
        out.append(f"clue {_CLUE.get(m.group(1).lower(), 'none')}")
    if kind == "email":
        last = re.split("[^A-Za-z0-9]", line)[-1]
        out += [
            f"at {'word' if '@' not in line else 'spaced' if ' @' in line or '@ ' in line else 'sign'}",
            f"dot {'word' if 'dot' in line.lower() else 'sign'}",
            f"top {min(len(last), 6)} {'letters' if last.isalpha() else 'other'}",
        ]
        if _DOT.match(after):
            out.append("goes on")
    else:
        groups = re.findall("[0-9]+", line)
        digits = "".join(groups)
        out += [
            f"digits {len(digits)}",
            f"groups {'-'.join(str(len(g)) for g in groups)}",
            f"signs {''.join(sorted(set(re.sub('[0-9]', '', line))))}",
            f"first {line[0] if line[0] in '+(' else 'digit'}",
        ]
        if line.count("(") != line.count(")"):
            out.append("open bracket")
        if kind == "card":
            out += [f"check {luhn(digits)}", f"issuer {digits[0]}", f"even {len(set(map(len, groups))) == 1}"]
        elif kind == "ip":
            out += [f"octets {all(map(octet, groups))}", f"zeros {any(g[0] == '0' < g[-1] for g in groups)}"]
        else:
            out.append(f"plus {line[0] == '+'} {'plain' if len(groups) == 1 else 'grouped'}")
    return tuple([f"{kind} {name}" for name in out])


@dataclass
class Lattice:
    """Candidates of a stretch over the places where one begins or ends. From each place to the
    next there is a segment of other text, too."""

    places: int
    spans: list[Span]
    #: By the place where they end: begin, kind, number of the candidate.
    ending: list[list[tuple[int, int, int]]]


def lattice(spans: list[Span]) -> Lattice:
    spans = sorted(set(spans), key=lambda s: (s[1], s[2], s[0]))
    at = {p: i for i, p in enumerate(sorted({p for s in spans for p in s[1:]}))}
    ending: list[list[tuple[int, int, int]]] = [[] for _ in at]
    for number, (kind, a, b) in enumerate(spans):
        ending[at[b]].append((at[a], KINDS.index(kind) + 1, number))
    return Lattice(len(at), spans, ending)


# The field

LABELS = len(KINDS) + 1
NONE = -math.inf


def _step(weights: dict[str, float], before: int, label: int) -> float:
    return 0.0 if before == label == 0 else weights.get(f"from {before} to {label}", 0.0)


def best_path(net: Lattice, scores: list[float], weights: dict[str, float]) -> list[int]:
    """Candidates of the best sequence of segments, from left to right."""
    best = [[NONE] * LABELS for _ in range(net.places)]
    come: list[list] = [[None] * LABELS for _ in range(net.places)]
    if not net.places:
        return []
    best[0][0] = 0.0
    for end in range(1, net.places):
        for begin, label, number in [(end - 1, 0, -1), *net.ending[end]]:
            own = scores[number] if number >= 0 else 0.0
            for before in range(LABELS):
                if (past := best[begin][before]) > NONE:
                    value = past + own + _step(weights, before, label)
                    if value > best[end][label]:
                        best[end][label], come[end][label] = value, (begin, before, number)
    at, label = net.places - 1, max(range(LABELS), key=lambda x: best[-1][x])
    out = []
    while come[at][label]:
        at, label, number = come[at][label]
        if number >= 0:
            out.append(number)
    return out[::-1]


def _add(values: list[float]) -> float:
    top = max(values, default=NONE)
    return NONE if top == NONE else top + math.log(sum(math.exp(v - top) for v in values))


def expectations(
    net: Lattice, scores: list[float], weights: dict[str, float]
) -> tuple[float, list[float], dict[tuple[int, int], float]]:
    """The log sum over all segmentations, the probability of each candidate, and the
    expected number of each step between labels: forward and backward over the places."""
    ahead = [[NONE] * LABELS for _ in range(net.places)]
    ahead[0][0] = 0.0
    arcs: list[tuple[int, int, int, int, float]] = []
    for end in range(1, net.places):
        sums: list[list[float]] = [[] for _ in range(LABELS)]
        for begin, label, number in [(end - 1, 0, -1), *net.ending[end]]:
            own = scores[number] if number >= 0 else 0.0
            arcs.append((begin, end, label, number, own))
            sums[label] += [
                past + own + _step(weights, before, label)
                for before, past in enumerate(ahead[begin]) if past > NONE
            ]
        ahead[end] = [_add(s) for s in sums]
    total = _add(ahead[-1])
    back = [[NONE] * LABELS for _ in range(net.places)]
    back[-1] = [0.0] * LABELS
    share, steps = [0.0] * len(net.spans), {}
    for begin, end, label, number, own in reversed(arcs):
        for before, past in enumerate(ahead[begin]):
            if past == NONE or back[end][label] == NONE:
                continue
            move = own + _step(weights, before, label) + back[end][label]
            back[begin][before] = _add([back[begin][before], move])
            p = math.exp(past + move - total)
            if number >= 0:
                share[number] += p
            if before or label:
                steps[before, label] = steps.get((before, label), 0.0) + p
    return total, share, steps


def score(text: str, span: Span, weights: dict[str, float]) -> float:
    return sum([weights.get(name, 0.0) for name in features(text, span)])


class Sure:
    """Places that base spans take, as borders of their union."""

    def __init__(self, spans: list[Span]):
        self.begins: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(spans, key=lambda s: s[1]):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.begins.append(a)
                self.ends.append(b)

    def takes(self, begin: int, end: int, wholly: bool = False) -> bool:
        """Whether they overlap these places, or hold them all."""
        at = bisect.bisect_left(self.begins, end) - 1
        if wholly:
            at = bisect.bisect_right(self.begins, begin) - 1
            return at >= 0 and self.ends[at] >= end
        return at >= 0 and self.ends[at] > begin


def stretches(text: str, sure: Sure) -> Iterator[list[Span]]:
    """Candidates of a text, but for those in stretches that base spans explain. Each list
    shares no place with the others, so it is decided by itself."""
    found: list[Span] = []
    for m in _STRETCH.finditer(text):
        if m.end() - m.start() >= 7 and not sure.takes(*m.span(), True):
            found += _numbers(text, *m.span())
    if _WRITTEN.search(text):
        for m in _AT.finditer(text):
            found += _addresses(text, m)
    found.sort(key=lambda s: s[1:])
    part: list[Span] = []
    last = -1
    for span in found:
        if part and span[1] > last:
            yield part
            part = []
        last = max(last, span[2]) if part else span[2]
        part.append(span)
    if part:
        yield part


def find(text: str, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """Base spans of a text, and those that the field adds. A base span is sure: what overlaps
    it is no candidate."""
    base = base_spans(text)
    sure = Sure(base)
    added = []
    for part in stretches(text, sure):
        if spans := [s for s in part if not sure.takes(*s[1:])]:
            net = lattice(spans)
            scores = [score(text, s, weights) for s in net.spans]
            added += [net.spans[i] for i in best_path(net, scores, weights)]
    return base, sorted(added, key=_order)


# Training


def _digits(choose: random.Random, n: int) -> str:
    return str(choose.randint(1, 9)) + "".join(str(choose.randint(0, 9)) for _ in range(n - 1))


def _checked(choose: random.Random, n: int, right: bool) -> str:
    """Digits of a card number whose check digit is right, or is not."""
    body = choose.choice("34456") + _digits(choose, n - 2)
    good = next(d for d in "0123456789" if luhn(body + d))
    return body + (good if right else str((int(good) + choose.randint(1, 9)) % 10))


def _grouped(choose: random.Random, digits: str) -> str:
    sign = choose.choice(["", "", " ", "-"])
    sizes = (4, 6, 5) if len(digits) == 15 else (4,) * 4
    ends = [sum(sizes[:i]) for i in range(len(sizes))] + [len(digits)]
    return sign.join(digits[a:b] for a, b in itertools.pairwise(ends))


def _pattern(choose: random.Random, patterns: list[str]) -> str:
    """One of the patterns, 9 for any digit but a leading zero."""
    return re.sub("9+", lambda m: _digits(choose, len(m.group())), choose.choice(patterns))


# How people write numbers that are personal, and some that aren't
PHONES = [
    "+9 (999) 999-9999", "+9 (999) 999-9999", "+9 999 999 9999", "+9-999-999-9999", "+99999999999",
    "+99 99 9999 9999", "+99 999 999999", "+99 99 99 99 99 99", "+999999999999", "+9.999.999.9999",
    "(999) 999-9999", "999-999-9999", "999.999.9999",
]
OTHERS = [
    "9999-09-09 09:09", "99.09.9999 99.99", "09-09-9999", "9999 9999 9999", "9,999,999.99", "9.99.9",
    "9.9.9.9.9.9", "999-9-99-999999-9", "99999999999999999999999", "9999999999999999999999999",
    "9 9 9 9 9 9 9 9 9 9 9 9", "99 99 99 99 99 99 99 99 99", "9999999999", "99999999999",
    "9999999999999", "999999999999", "9999-9999", "999 999 999", "9999 - 9999", "999.999.999.999.999",
    "0.99999999999", "9999999999.99", "-99999999999999", "9/99999999999",
]


def _value(choose: random.Random) -> tuple[str, str | None]:
    """A made-up entity with its kind, or something else without."""
    kind = choose.choice(["phone", "phone", "card", "card", "ip", "email", None, None])
    name = "".join(choose.choice("abcdefghijklmnoprstuvz") for _ in range(choose.randint(2, 8)))
    if kind == "phone":
        return _pattern(choose, PHONES), kind
    if kind == "card":
        return _grouped(choose, _checked(choose, choose.choice([15, 16, 16, 16]), True)), kind
    if kind == "ip":
        return ".".join(str(choose.randint(0, 255)) for _ in range(4)), kind
    if kind == "email":
        at = choose.choice(["@", " @ ", " at ", " (at) ", "[at]", " [at] "])
        dot = " dot " if at == " at " else "." if at == "@" else choose.choice([".", " dot ", " [dot] "])
        host = choose.choice(["mail", "post", name[::-1], f"mail{choose.randint(0, 9)}.example"])
        end = choose.choice(["com", "org", "net", "de", "es", "fr"])
        return f"{name}{choose.choice(['', '.', '_'])}{choose.randint(0, 99)}{at}{host}{dot}{end}", kind
    match choose.randint(0, 3):
        case 0:
            return _grouped(choose, _checked(choose, choose.choice([14, 15, 16, 17]), False)), None
        case 1:
            parts = [str(choose.randint(0, 255)) for _ in range(4)]
            parts[choose.randrange(4)] = str(choose.randint(256, 99_999))
            return ".".join(parts), None
        case 2:
            parts = "".join(choose.choice("0123456789abcdef") for _ in range(20))
            return f"{choose.choice('abcdef')}{parts}{_digits(choose, choose.randint(10, 19))}{name}", None
        case _:
            return _pattern(choose, OTHERS), None


Example = tuple[str, list[Span]]


def made_up(words: list[str], n: int, seed: int) -> list[Example]:
    """Examples with known spans: one to three values, side by side or not, in words."""
    choose = random.Random(seed)
    words = words or ["the", "of", "and", "is"]
    out = []
    for _ in range(n):
        text = " ".join(choose.choice(words) for _ in range(choose.randint(0, 5)))
        spans: list[Span] = []
        for i in range(choose.choice([1, 1, 2, 2, 3])):
            value, kind = _value(choose)
            if i:
                text += choose.choice([" ", " ", " ", ", ", " / ", "; ", " " + choose.choice(words) + " "])
            elif text:
                text += choose.choice([" ", " ", " ", ". ", ": ", "="])
            if kind and choose.random() < 0.3:
                text += choose.choice(CLUES[kind].split()) + choose.choice([" ", ": "])
            elif kind and choose.random() < 0.1:
                text += "("
            if kind:
                spans.append((kind, len(text), len(text) + len(value)))
            text += value
        text += choose.choice([" ", " ", ". ", ", ", "### ", "!! ", "$$$ ", "\n"])
        text += " ".join(choose.choice(words) for _ in range(choose.randint(0, 5)))
        out.append((text, spans))
    return out


def explained(texts: list[str]) -> list[Example]:
    """Stretches of real texts with what the patterns find there: those that they explain
    wholly, and single numbers that they leave alone."""
    out = []
    for text in texts:
        base = base_spans(text)
        sure = Sure(base)
        for part in stretches(text, Sure([])):
            begin, end = part[0][1], max(s[2] for s in part)
            mine = [s for s in base if begin <= s[1] and s[2] <= end]
            if text[begin:end].isdecimal() or len(mine) == 1 and mine[0][1:] == (begin, end):
                if len(mine) == sure.takes(begin, end):
                    a = max(0, begin - AROUND)
                    out.append((text[a : end + AROUND], [(k, x - a, y - a) for k, x, y in mine]))
    return out


def fit(examples: list[Example], rounds: int = 8, rate: float = 0.3, decay: float = 1e-4) -> dict[str, float]:
    """Weights by name, by steps along the gradient of the log likelihood of each example, each
    weight with a rate of its own that falls with what it has moved; seeded, so equal
    examples give equal weights."""
    choose = random.Random(1)
    nets = []
    for text, gold in examples:
        # Parts that a right span lies in wholly or not at all
        for part in stretches(text, Sure([])):
            begin, end = part[0][1], max(s[2] for s in part)
            right = [s for s in gold if s[1] < end and s[2] > begin]
            net = lattice([*part, *right])
            names = [features(text, s) for s in net.spans]
            nets.append((net, names, {net.spans.index(s) for s in right}))
    weights: dict[str, float] = {}
    moved: dict[str, float] = {}
    for _ in range(rounds):
        choose.shuffle(nets)
        for net, names, right in nets:
            scores = [sum([weights.get(f, 0.0) for f in own]) for own in names]
            _, share, steps = expectations(net, scores, weights)
            slope: dict[str, float] = {}
            for i, own in enumerate(names):
                if off := (i in right) - share[i]:
                    for f in own:
                        slope[f] = slope.get(f, 0.0) + off
            for (a, b), n in steps.items():
                slope[f"from {a} to {b}"] = slope.get(f"from {a} to {b}", 0.0) - n
            for a, b in _steps(net, right):
                if a or b:
                    slope[f"from {a} to {b}"] = slope.get(f"from {a} to {b}", 0.0) + 1
            for f, g in slope.items():
                g -= decay * weights.get(f, 0.0)
                moved[f] = moved.get(f, 1e-3) + g * g
                weights[f] = weights.get(f, 0.0) + rate * g / math.sqrt(moved[f])
    return weights


def _steps(net: Lattice, right: set[int]) -> Iterator[tuple[int, int]]:
    """Steps between labels of the right segmentation."""
    ends = {}
    at = {p: i for i, p in enumerate(sorted({p for s in net.spans for p in s[1:]}))}
    for i in right:
        kind, a, b = net.spans[i]
        ends[at[a]] = (at[b], KINDS.index(kind) + 1)
    place = before = 0
    while place < net.places - 1:
        place, label = ends.get(place, (place + 1, 0))
        yield before, label
        before = label


def train(
    docs: DataFrame, documents: int = DOCUMENTS, examples: int = EXAMPLES, window: int = 4000
) -> dict[str, float]:
    """Weights of the field for `docs`. The sample is bounded: a window of up to `window`
    characters, at a place that a hash chooses, of up to `documents` documents, the first by
    their hash; it lends its words and its numbers. Tasks hand on four times as many windows
    in all, however many tasks there are. The driver fits `examples` made-up examples and the
    explained ones of the sample. An empty table, or one without numbers, fits on made-up
    examples alone."""
    text = F.col("text")
    key = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), text), F.lit(1 << 40))
    share = min(1.0, 4 * documents / max(docs.count(), 1))
    begin = F.pmod(key, F.greatest(F.length(text) - window, F.lit(0)) + 1).cast("int") + 1
    rows = (
        docs.where((F.length(text) > 0) & (key < int(share * (1 << 40))))
        .select(key.alias("key"), F.substring(text, begin, F.lit(window)).alias("part"))
        .orderBy("key", "part")
        .limit(documents)
        .collect()
    )
    parts = [r.part for r in rows]
    words = sorted({w for part in parts for w in re.findall(r"[^\W\d_]+", part)})
    choose = random.Random(2)
    words = choose.sample(words, min(len(words), 2000))
    real = explained(parts)
    choose.shuffle(real)
    return fit(made_up(words, examples, 3) + real[: examples // 4])


# Documents

SPANS = "array<struct<kind:string,begin:bigint,end:bigint,base:boolean>>"


def spans(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """doc_id and spans of every row of `docs`: kind, begin and end (code points, end excluded) and
    whether the base patterns found it, by begin and then kind in the order of KINDS.

    Null and empty texts have no spans; null and repeated doc_ids stay as they are, further
    columns are left out, an empty table gives no rows. Whole texts are searched; time is
    linear in them, and there is no shuffle, so no key can be hot.
    """

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text in texts_of(batch):
                base, added = find(text, weights)
                both = sorted(
                    [(s, True) for s in base] + [(s, False) for s in added], key=lambda x: _order(x[0])
                )
                out.append([{"kind": k, "begin": a, "end": b, "base": is_base} for (k, a, b), is_base in both])
            kind = pa.list_(
                pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
            )
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

        return each

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_chunks(rows, "text", start, f"doc_id long, spans {SPANS}")


def count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s.kind == kind)).cast("long")


def line(found: Column) -> Column:
    """Spans as one text, kind:begin:end joined by commas."""
    parts = F.transform(
        found, lambda s: F.concat_ws(":", s.kind, s.begin.cast("string"), s.end.cast("string"))
    )
    return F.array_join(parts, ",")


def mask(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """`docs` with each stretch of personal data in `text` replaced by the kind of its first span,
    as `[EMAIL]`. Null texts stay null; all other columns stay as they are."""

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text in batch.column("text").to_pylist():
                if text is not None:
                    base, added = find(text, weights)
                    parts, at = [], 0
                    for kind, a, b in sorted([*base, *added], key=_order):
                        if a >= at:
                            parts += [text[at:a], f"[{kind.upper()}]"]
                        at = max(at, b)
                    text = "".join(parts) + text[at:]
                out.append(text)
            at = batch.schema.names.index("text")
            return batch.set_column(at, "text", pa.array(out, batch.column("text").type))

        return each

    return map_chunks(docs, "text", start, docs.schema)
