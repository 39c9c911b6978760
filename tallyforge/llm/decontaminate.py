"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds all runs of words of a block of benchmark items. The words of a document
stream through it; the longest match that ends at each word is kept. Where it reaches the
window, the words under it are hit; the state tells which items hold them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import kept_table, map_chunks, texts_of

WINDOW = 10
#: Words of the benchmark in one automaton; a larger benchmark is taken in several blocks.
BLOCK_WORDS = 200_000
#: A-Z lower-cased, ASCII other than letters and digits as white space.
LOWER = bytes(
    b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower()
)
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


def words(text: str) -> list[bytes]:
    """The words of a text; every byte over 127 is part of a character that counts."""
    return text.encode().translate(LOWER).split()


class Automaton:
    """All word runs of some items, and for those of `window` words (or of a whole item
    that has fewer) the numbers of the items that hold them."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        runs = []
        for item, tokens in items:
            ids = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in tokens]
            runs.append((item, ids))
            last = 0
            for token in ids:
                last = self._extend(last, token)
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        #: The state of the last `window` words of any longer match.
        self.base = [-1] * len(self.length)
        for s in order[1:]:
            up = self.link[s]
            if self.length[s] >= window:
                self.base[s] = s if self.length[up] < window else self.base[up]
        self.holders: dict[int, set[int | None]] = {}
        whole: dict[int, list[tuple[int, int | None]]] = {}
        self.least = window
        for item, ids in runs:
            state = 0
            for i, token in enumerate(ids):
                state = self.next[state][token]
                if i + 1 >= window:
                    self.holders.setdefault(self.base[state], set()).add(item)
            if 0 < len(ids) < window:
                whole.setdefault(state, []).append((len(ids), item))
                self.least = min(self.least, len(ids))
        #: Whole short items that end where a match ends: their length and number.
        self.short: dict[int, list[tuple[int, int | None]]] = {}
        if whole:
            for s in order[1:]:
                if found := self.short.get(self.link[s], []) + whole.get(s, []):
                    self.short[s] = found

    def _extend(self, last: int, token: int) -> int:
        """Add one word behind the state `last`, which may know it from another item."""
        nxt, link, length = self.next, self.link, self.length
        if token in nxt[last]:
            q = nxt[last][token]
            return q if length[q] == length[last] + 1 else self._clone(last, token, q)
        new = len(length)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and token not in nxt[p]:
            nxt[p][token] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][token]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, token, q)
        return new

    def _clone(self, p: int, token: int, q: int) -> int:
        copy = len(self.length)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        return copy

    def matches(self, tokens: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """Begin and end of the hit words, matching length and state, where one ends.

        Only runs of words that the items know, long enough for the shortest window, are
        walked: a word that no item has ends every match.
        """
        get = self.vocabulary.get
        ids = [get(t, -1) for t in tokens]
        gaps = np.flatnonzero(np.array([*ids, -1], np.int64) < 0)
        runs = np.diff(np.r_[-1, gaps]) - 1
        for k in np.flatnonzero(runs >= self.least).tolist():
            stop = int(gaps[k])
            state = size = 0
            for i in range(stop - int(runs[k]), stop):
                token = ids[i]
                while state and token not in self.next[state]:
                    state = self.link[state]
                    size = self.length[state]
                if token in self.next[state]:
                    state = self.next[state][token]
                    size += 1
                if size >= self.window:
                    yield i + 1 - self.window, i + 1, size, state
                elif self.short and state in self.short:
                    fit = [n for n, _ in self.short[state] if n <= size]
                    if fit:
                        yield i + 1 - max(fit), i + 1, size, state

    def found(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[int | None]]:
        """Merged spans of hit words, and the items they come from."""
        spans: list[tuple[int, int]] = []
        items: set[int | None] = set()
        for begin, end, size, state in self.matches(tokens):
            if size >= self.window:
                items |= self.holders[self.base[state]]
            items.update(item for n, item in self.short.get(state, ()) if n <= size)
            spans.append((begin, end))
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def automata(benchmark: DataFrame, window: int, block_words: int) -> Iterator[Automaton]:
    """One automaton after the other over blocks of items; an item of more words than a
    block is cut into parts that overlap by a window less one word. Items come one
    partition at a time, so the driver holds a block and not the benchmark. Items without an
    id hit words like any other; they share the number None."""
    block: list[tuple[int | None, list[bytes]]] = []
    size = 0
    rows = benchmark.where("text is not null")
    for row in rows.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        tokens = words(row.text)
        for at in range(0, max(1, len(tokens) - window + 1), block_words):
            part = tokens[at : at + block_words + window - 1]
            if size and size + len(part) > block_words:
                yield Automaton(block, window)
                block, size = [], 0
            block.append((row.item_id, part))
            size += len(part)
    yield Automaton(block, window)


def mark(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> tuple[DataFrame, str]:
    """All rows and columns of `docs` and a further one, whose name is returned too: a
    struct of n_words, spans (begin, end in words, end excluded) and items (a null behind the
    others stands for all items without an id).

    Each block of the benchmark is broadcast in its turn (its size is bounded) and passes
    over all documents; between blocks the rows are written out. Null texts have no words;
    an empty benchmark hits nothing.
    """
    name = "found"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    kind = "struct<n_words: long, spans: array<struct<begin: int, end: int>>, items: array<long>>"
    blocks = automata(benchmark, window, block_words)
    out = docs.withColumn(name, F.lit(None).cast(kind))
    here = None
    for automaton in blocks:
        if here is not None:
            out = kept_table(out, "marked")
        here = docs.sparkSession.sparkContext.broadcast(automaton)
        out = map_chunks(out, "text", _marker(here, name, out.schema[name].dataType), out.schema)
    return out, name


def _marker(broadcast, name: str, kind):
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)

    def start():
        automaton = broadcast.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            old = batch.column(name).to_pylist()
            new = []
            for text, before in zip(texts_of(batch), old, strict=True):
                tokens = words(text)
                spans, items = automaton.found(tokens)
                if before:
                    spans = merged(spans + [(s["begin"], s["end"]) for s in before["spans"]])
                    items |= set(before["items"])
                new.append(
                    {
                        "n_words": len(tokens),
                        "spans": [{"begin": b, "end": e} for b, e in spans],
                        "items": sorted(items, key=lambda i: (i is None, i or 0)),
                    }
                )
            return batch.set_column(
                batch.schema.get_field_index(name), name, pa.array(new, arrow)
            )

        return each

    return start


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, spans, items, one row for each of `docs`."""
    rows, name = mark(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, window)
    return rows.select("doc_id", f"{name}.*")


def clean(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = 0.8
) -> DataFrame:
    """`docs` with the hit spans cut out of the text (and n_chars, if there, counted anew);
    documents of which over the share `coverage` of the words is hit are dropped. Rows that
    hold nothing of the benchmark stay as they are."""
    rows, name = mark(docs, benchmark, window)
    schema = docs.schema

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = batch.column(name).to_pylist()
            cut = [sum(s["end"] - s["begin"] for s in f["spans"]) for f in found]
            keep = [c <= coverage * f["n_words"] for c, f in zip(cut, found, strict=True)]
            if any(cut):
                texts = batch.column("text").to_pylist()
                for i, f in enumerate(found):
                    if cut[i] and keep[i]:
                        texts[i] = without(texts[i], [(s["begin"], s["end"]) for s in f["spans"]])
                at = batch.schema.get_field_index("text")
                batch = batch.set_column(at, "text", pa.array(texts, batch.column("text").type))
                if (at := batch.schema.get_field_index("n_chars")) >= 0:
                    old = batch.column("n_chars")
                    counts = [
                        len(t) if c else n
                        for t, c, n in zip(texts, cut, old.to_pylist(), strict=True)
                    ]
                    batch = batch.set_column(at, "n_chars", pa.array(counts, old.type))
            return batch.select(schema.names).filter(pa.array(keep, pa.bool_()))

        return each

    return map_chunks(rows, "text", start, schema)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for begin, end in spans:
        out.append(text[at : places[begin][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])
