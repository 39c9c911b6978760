"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, each with its chain
of ancestors. Ancestor-tag and text features weigh each block; weights between neighbours
tie the labels of a page together. The field is fitted on labelled pages and decoded by
Viterbi.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_chunks

#: Comments, elements whose content is no text, declarations, tags. A raw element without an
#: end goes on to the body or the end of the page, as in a browser; no other one does. In a tag
#: a quote counts only behind an equals sign, and only with its fellow; any other is a
#: character like the rest. No part is tried a second time, so time is linear in the page.
def _markup(inner: str) -> re.Pattern:
    return re.compile(
        r"<!--.*?(?:-->|\Z)"
        rf"|<(?P<raw>script|style|title)\b(?!\s*+/>){inner}>.*?"
        r"(?:</(?P=raw)\s*+>|(?=<body[\s>])|\Z)"
        r"|<[!?][^>]*+(?:>|\Z)"
        rf"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<attrs>{inner})>"
        r"|(?P<open><(?=/?[a-z]))",
        re.IGNORECASE | re.DOTALL,
    )


MARKUP = _markup(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+""")
#: For what follows a tag that quotes keep open to the end of the page: there quotes don't count,
#: and a tag ends before the next one.
UNQUOTED = _markup("[^<>]*+")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
PARTS = re.compile(r"[a-z]+")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark"
    " picture q ruby rp rt s samp small source span strike strong sub sup time tt u var wbr".split()
)
#: Formulas stand in the line, with all that is in them.
INLINE |= frozenset(
    "math annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo"
    " mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup"
    " mtable mtd mtext mtr munder munderover semantics".split()
)
#: Elements that may stand in a paragraph and don't end it.
EMBEDDED = frozenset("svg iframe object canvas noscript template".split())
#: Elements that '/>' leaves empty, as what is in svg.
CLOSED = frozenset("svg script style title".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: What a start tag of the same kind closes.
CLOSES = {t: {t} for t in ("li", "option", "tr")} | {
    t: g for g in ({"td", "th"}, {"dt", "dd"}) for t in g
} | {"body": {"head"}}
#: Words in class, id and role that tell what a part of a page is for.
KINDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pager pagination skip",
    "head": "header masthead banner logo topbar brand",
    "foot": "footer foot copyright legal imprint bottom colophon contentinfo",
    "side": "sidebar aside side widget rail related recommended trending popular complementary",
    "ad": "ad ads advert adverts advertisement promo promotion sponsor sponsored outbrain teaser",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay subscribe newsletter"
    " paywall disclaimer warning",
    "form": "form login signup search register contact",
    "talk": "comment comments reply replies discussion disqus respond feedback",
    "share": "share sharing social follow",
    "main": "article main content post entry story articlebody bodytext",
}
KIND = {w: k for k, words in KINDS.items() for w in words.split()}
TAGS = {
    "nav": "menu", "menu": "menu", "header": "head", "footer": "foot", "aside": "side",
    "form": "form", "button": "form", "select": "form", "textarea": "form", "fieldset": "form",
    "dialog": "notice", "article": "main", "main": "main",
}
#: Longest page that may be in the training sample, in characters.
SAMPLE_CHARS = 50_000


class Path:
    """An element below others, with what they all are for: a chain that elements share, so that
    a page of any depth takes memory in proportion to its tags."""

    __slots__ = ("above", "tag", "kinds", "seen", "main", "other")

    def __init__(self, above: Path | None, tag: str, kinds: tuple[str, ...] = ()):
        self.above, self.tag, self.kinds = above, tag, kinds
        own = {TAGS[tag], *kinds} if tag in TAGS else set(kinds)
        before = above.seen if above else frozenset()
        self.seen = before if own <= before else before | own
        self.main = bool(above and above.main) or tag in ("article", "main")
        self.other = bool(self.seen - {"main"})

    def __iter__(self) -> Iterator[tuple[str, tuple[str, ...]]]:
        chain, at = [], self
        while at:
            chain.append((at.tag, at.kinds))
            at = at.above
        return reversed(chain)


def path_of(elements: Iterable[tuple[str, tuple[str, ...]]]) -> Path | None:
    out = None
    for tag, kinds in elements:
        out = Path(out, tag, kinds)
    return out


@dataclass
class Block:
    """Text of a leaf block, its ancestors, characters inside links."""

    path: Path | None
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def blocks(page: str) -> list[Block]:
    """Leaf blocks with text, in page order. Character references are decoded and white
    space becomes one space; br counts as white space; unclosed tags end with the parent.
    Only scripts, styles and titles are no text; what stands in svg, object, canvas, iframe,
    noscript, template or head is a block with that ancestor, and formulas are in the line."""
    out: list[Block] = []
    here: Path | None = None
    opened: Counter[str] = Counter()
    now: Block | None = None
    links = 0

    def add(raw: str) -> None:
        nonlocal now
        if now is None:
            if not raw.strip():
                return
            now = Block(here)
        now.parts.append(raw)
        if links:
            now.linked += len(raw)

    def close() -> None:
        nonlocal now
        if now is not None:
            now.text = " ".join(html.unescape("".join(now.parts)).split())
            if now.text:
                out.append(now)
            now = None

    def up() -> None:
        nonlocal here
        opened[here.tag] -= 1
        here = here.above

    for text, m in _tokens(page):
        if text:
            add(text)
        if m is None or m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if m["end"] else 1
            continue
        if tag == "br":
            add(" ")
            continue
        close()
        links = 0
        if m["end"]:
            if opened[tag] > 0:
                while here.tag != tag:
                    up()
                up()
            continue
        if tag in VOID:
            continue
        if m["attrs"].endswith("/") and (tag in CLOSED or opened["svg"] > 0):
            continue
        if here and here.tag == "p" and tag not in EMBEDDED:
            up()
        if here and here.tag in CLOSES.get(tag, ()):
            up()
        kinds = ()
        if m["attrs"]:
            named = " ".join("".join(x) for x in NAMED.findall(m["attrs"])).lower()
            kinds = tuple({KIND[w] for w in PARTS.findall(named) if w in KIND})
        here = Path(here, tag, kinds)
        opened[tag] += 1
    close()
    return out


def _tokens(page: str) -> Iterator[tuple[str, re.Match | None]]:
    """Text and the markup behind it, to the end of the page."""
    at, pattern = 0, MARKUP
    while True:
        for m in pattern.finditer(page, at):
            if m["open"]:
                if pattern is MARKUP:
                    # Its quotes hold all that follows
                    pattern = UNQUOTED
                    yield page[at : m.start()], None
                    at = m.start()
                    break
                continue
            yield page[at : m.start()], m
            at = m.end()
        else:
            yield page[at:], None
            return


def features(found: list[Block]) -> list[list[str]]:
    """Names of the features of each block of a page."""
    out = []
    for i, b in enumerate(found):
        kinds = b.path.seen if b.path else frozenset()
        last = b.path.tag if b.path else ""
        words = b.text.count(" ") + 1
        link = b.linked / max(1, len(b.text))
        names = ["bias", f"tag:{last}", f"words:{min(6, words.bit_length())}"]
        names += [f"in:{k}" for k in sorted(kinds)]
        if kinds - {"main"}:
            names.append("in:aside")
        names.append("link:most" if link > 0.5 else "link:some" if link > 0 else "link:none")
        if b.text[-1] in ".!?…:»”\"'":
            names.append("text:ends")
        if "©" in b.text or "(c)" in b.text:
            names.append("text:copyright")
        if i == 0:
            names.append("place:first")
        if i == len(found) - 1:
            names.append("place:last")
        out.append(names)
    return out


@dataclass(frozen=True)
class Field:
    """Weights of features for the label 1 (main text) against 0, and of label pairs."""

    weights: dict[str, float]
    pairs: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, names: list[list[str]]) -> list[int]:
        """The likeliest labels by Viterbi; of equal ways the one with 0."""
        if not names:
            return []
        get = self.weights.get
        (p00, p01), (p10, p11) = self.pairs
        s0, s1 = 0.0, 0.0
        back = []
        for i, block in enumerate(names):
            w = sum([get(f, 0.0) for f in block])
            if i:
                a, b = s0 + p00, s1 + p10
                c, d = s0 + p01, s1 + p11
                back.append((int(b > a), int(d > c)))
                s0, s1 = max(a, b), max(c, d) + w
            else:
                s1 = w
        label = int(s1 > s0)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def fit(examples: list[tuple[list[list[str]], list[int]]], steps: int = 200, penalty: float = 1e-3) -> Field:
    """Maximum likelihood with an L2 penalty, by forward-backward over all pages at once."""
    names = sorted({f for page, _ in examples for block in page for f in block})
    place = {f: i for i, f in enumerate(names)}
    longest = max(len(y) for _, y in examples)
    n = len(examples)
    x = np.zeros((n, longest, len(names)), np.float32)
    y = np.zeros((n, longest), int)
    there = np.zeros((n, longest), bool)
    for r, (page, labels) in enumerate(examples):
        for t, block in enumerate(page):
            x[r, t, [place[f] for f in block]] = 1
        y[r, : len(labels)] = labels
        there[r, : len(labels)] = True
    both = there[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
    w, pairs = np.zeros(len(names)), np.zeros((2, 2))
    square_w, square_p = np.full(len(names), 1e-8), np.full((2, 2), 1e-8)
    for _ in range(steps):
        score = np.zeros((n, longest, 2))
        score[..., 1] = x @ w
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            way = np.logaddexp.reduce(forward[:, t - 1, :, None] + pairs, axis=1) + score[:, t]
            forward[:, t] = np.where(there[:, t, None], way, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            way = np.logaddexp.reduce(
                pairs + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2
            )
            backward[:, t] = np.where(there[:, t + 1, None], way, backward[:, t])
        whole = np.logaddexp.reduce(forward[:, -1], axis=1)
        one = np.exp(forward[..., 1] + backward[..., 1] - whole[:, None]) * there
        slope = np.einsum("rt,rtf->f", (y * there - one).astype(np.float32), x) / n - penalty * w
        two = np.exp(
            forward[:, :-1, :, None] + pairs + (score + backward)[:, 1:, None, :]
            - whole[:, None, None, None]
        )
        slope_p = (seen - (two * both[..., None, None]).sum((0, 1))) / n - penalty * pairs
        square_w += slope**2
        square_p += slope_p**2
        w = w + 0.5 * slope / np.sqrt(square_w)
        pairs = pairs + 0.5 * slope_p / np.sqrt(square_p)
    return Field(
        {f: float(v) for f, v in zip(names, w, strict=True)},
        tuple(tuple(map(float, row)) for row in pairs),
    )


#: Other ways to mark the parts of a page, for training pages of other layouts.
MAIN_WAYS = [
    [("article", ())], [("main", ())], [("div", ("main",))], [("section", ("main",))], [("div", ())], [],
    [("main", ()), ("article", ())], [("div", ("main",)), ("div", ("main",))],
]
SIDE_WAYS = [
    [("nav", ())], [("div", ("menu",))], [("header", ())], [("div", ("head",))], [("footer", ())],
    [("div", ("foot",))], [("aside", ())], [("div", ("side",))], [("div", ("ad",))],
    [("section", ("ad",))], [("div", ("notice",))], [("form", ())], [("div", ("form",))],
    [("section", ("talk",))], [("div", ("talk",))], [("ul", ("talk",)), ("li", ())],
    [("div", ("share",))], [("dialog", ())],
]


def labelled(found: list[Block]) -> list[int] | None:
    """Labels of a page whose own markup names its article: blocks inside it and inside no
    part for another purpose. None where no article is named."""
    paths = [b.path for b in found]
    if not any(p and p.main for p in paths):
        return None
    return [int(bool(p) and p.main and not p.other) for p in paths]


def varied(found: list[Block], labels: list[int], choose: random.Random) -> tuple[list[Block], list[int]]:
    """The page in another layout: its article and its other parts marked in other ways,
    some of the other parts moved into or behind the article."""
    way = choose.choice(MAIN_WAYS)
    side: dict[tuple, list] = {}
    rows = []
    for b, label in zip(found, labels, strict=True):
        chain = tuple(b.path or ())
        own = chain[-1:] if chain and chain[-1][0] not in TAGS and not chain[-1][1] else ()
        if label:
            path = [("html", ()), ("body", ()), *way, *own]
        else:
            path = [("html", ()), ("body", ()), *side.setdefault(chain, choose.choice(SIDE_WAYS)), *own]
        rows.append((Block(path_of(path), linked=b.linked, text=b.text), label))
    main = [r for r in rows if r[1]]
    rest = [r for r in rows if not r[1]]
    for b, _ in choose.sample(rest, min(len(rest), 2)):
        inside = [("html", ()), ("body", ()), *way, *choose.choice(SIDE_WAYS), ("p", ())]
        rows.insert(choose.randrange(len(rows) + 1), (Block(path_of(inside), linked=b.linked, text=b.text), 0))
    # What others write reads like the article: there only the markup tells
    if main and choose.random() < 0.7:
        inside = [("html", ()), ("body", ()), *choose.choice([way, []]), *choose.choice(SIDE_WAYS), ("p", ())]
        for b, _ in choose.sample(main, min(len(main), 2)):
            rows.append((Block(path_of(inside), linked=0, text=b.text), 0))
    return [b for b, _ in rows], [label for _, label in rows]


#: Two labelled pages, for tables that have none: main blocks carry the word MAIN.
EXAMPLES = (
    "<body><nav><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul></nav><article><h1>MAIN A title"
    "</h1><p>MAIN Some words that make a sentence, and some more.</p><p>MAIN Another one, longer than the"
    " first by a few words.</p></article><aside><p>Read this too.</p></aside><footer>&copy; 2020 All rights"
    " reserved.</footer></body>",
    "<body><div class=ad>Buy now.</div><main><p>MAIN One more text that stands alone here.</p></main><form>"
    "<p>Your name</p></form><footer><p>&copy; The owners</p></footer></body>",
)


def train(pages: DataFrame, rows: int = 200, stretch: int = 60) -> Field:
    """Fit on a bounded sample: at most `rows` pages of up to SAMPLE_CHARS characters, chosen
    by a digest of the page_id, whose markup names an article, each as it is and in two
    other layouts; and two written examples. All blocks of a page are trained on, in stretches of
    up to `stretch` blocks, each a chain by itself."""
    whole = pages.where("html is not null and page_id is not null").where(
        F.char_length("html") <= SAMPLE_CHARS
    )
    keys = whole.select("page_id", F.xxhash64("html").alias("digest"))
    order = [F.xxhash64("page_id"), "page_id", "digest"]
    # Chosen by keys alone, as each task hands on its first `rows`; equal pages count once
    chosen = keys.distinct().orderBy(*order).limit(rows)
    sample = (
        whole.select("page_id", F.xxhash64("html").alias("digest"), "html")
        .join(F.broadcast(chosen), ["page_id", "digest"])
        .dropDuplicates(["page_id", "digest"])
        .orderBy(*order)
    )
    examples = []
    choose = random.Random(7)
    texts = [r.html for r in sample.collect()]
    for i, text in enumerate([*texts, *EXAMPLES]):
        found = blocks(text)
        if i < len(texts):
            labels = labelled(found)
        else:
            labels = [int("MAIN" in b.text) for b in found]
        if labels is None:
            continue
        for ways in range(3):
            page, marks = (found, labels) if not ways else varied(found, labels, choose)
            names = features(page)
            for at in range(0, len(names), stretch):
                examples.append((names[at : at + stretch], marks[at : at + stretch]))
    return fit(examples)


def main_text(page: str | None, chain: Field) -> str:
    found = blocks(page or "")
    labels = chain.decode(features(found))
    return "\n\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def extract(pages: DataFrame, chain: Field) -> DataFrame:
    """page_id, url, text, n_chars, one row for each of `pages`. Null pages count as empty;
    a page without main text has an empty one. Repeated rows and null ids stay as they are, an
    empty table gives no rows, further columns are left out. Time and memory are linear in a
    page, however its tags are broken or nested."""

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [main_text(x, chain) for x in batch.column("html").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

        return each

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return map_chunks(rows, "html", start, "page_id long, url string, text string, n_chars long")
