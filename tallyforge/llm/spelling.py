"""Words that differ by one letter, found with k-d trees over letter counts, and grouped under
their most frequent spelling.

One inserted, deleted or replaced letter moves a word's vector of letter counts by two at most
(L1): a replaced one takes one from a count and adds one to another, an inserted one adds one.
So near words lie in a small box around each other. For each pair of lengths, n with n and n
with n + 1, the longer words are cut by a k-d tree; the words of the pair go to the leaves
whose box they can reach, and each leaf is searched by itself with a finer tree. What
lies near enough by its counts is then compared letter by letter.

The coarse trees come from a bounded sample of the words; they only deal the words out, so
the sample has no part in what is found. Leaves that come out larger than planned, as where
thousands of words are made of the same letters, are cut into blocks, each point block meeting
each block of searching words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import kept_table

#: Letters a-z have a count of their own; all others share six. Counts stop at four. Both
#: bring vectors closer together, never farther apart.
DIMS, FOLDED, MOST = 32, 6, 4
#: Words of a leaf of the coarse trees, searching words of a block, points of the finest box.
LEAF, SEARCHING, BOX = 10_000, 100_000, 64
#: Words that the coarse trees are made from, all lengths together.
SAMPLE = 200_000
#: Cells of a matrix of comparisons.
CELLS = 1 << 20

SAME, SHORTER, POINT = 0, 1, 2


# Words of the documents


def words(docs: DataFrame, slips: int | None = None) -> DataFrame:
    """Runs of letters `[A-Za-z\\u00C0-\\u00FF]` of whole texts, one row each, A-Z lower-cased, as
    `word`. Null texts have none. With `slips`, a run loses a letter where that number divides
    the crc32 of `doc_id:run` (a null id is empty): test words whose right form is known."""
    upper, lower = map("".join, ([chr(c + i) for i in range(26)] for c in (65, 97)))
    runs = F.regexp_extract_all(
        F.translate("text", upper, lower), F.lit("([a-z\\u00C0-\\u00FF]+)"), F.lit(1)
    )
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(runs).alias("word"))
    if slips is None:
        return found.select("word")
    h = F.crc32(F.concat(F.coalesce("doc_id", F.lit("")), F.lit(":"), F.col("word")))
    at = (h % F.length("word")).cast("int")
    word = F.col("word")
    less = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return found.select(F.when(h % slips == 0, less).otherwise(word).alias("word"))


def vocabulary(found: DataFrame, least_letters: int = 5, least_count: int = 3) -> DataFrame:
    """word and n of the words of at least so many letters and places. Counts are added up
    before the shuffle, so a frequent word is one row a task."""
    long = found.where(F.length("word") >= least_letters)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


# Vectors and trees


def codes(same_length: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    n = len(same_length[0])
    raw = "".join(same_length).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).reshape(-1, n)


def vectors(letters: np.ndarray) -> np.ndarray:
    """Letter counts of words given by their code points."""
    rows, n = letters.shape
    out = np.zeros((rows, DIMS), np.int8)
    step = max(1, CELLS // max(n, DIMS))
    for a in range(0, rows, step):
        part = letters[a : a + step]
        plain = (part >= 97) & (part < 123)
        dim = np.where(plain, part - 97, 26 + part % FOLDED).astype(np.int64)
        cell = dim + DIMS * np.arange(len(part))[:, None]
        counts = np.bincount(cell.ravel(), minlength=len(part) * DIMS)
        out[a : a + step] = np.minimum(counts, MOST).reshape(-1, DIMS)
    return out


def marks(vector: np.ndarray) -> np.ndarray:
    """Counts in unary as 128 bits: differing bits are the L1 distance."""
    ones = ((1 << vector.astype(np.uint64)) - 1).astype(np.uint64).reshape(len(vector), 2, 16)
    return np.bitwise_or.reduce(ones << (MOST * np.arange(16, dtype=np.uint64)), axis=2)


@dataclass
class Node:
    """A box of counts, and how it is cut: `left` holds the counts of `dim` up to `cut`."""

    low: np.ndarray
    high: np.ndarray
    points: np.ndarray | None = None
    leaf: int = 0
    dim: int = 0
    cut: int = 0
    parts: list["Node"] = field(default_factory=list)


def _best_cut(vector: np.ndarray) -> tuple[int, int] | None:
    """Dimension and count that cut the points most evenly; None if they are all alike."""
    best, found = 0, None
    n = len(vector)
    for cut in range(MOST):
        left = np.count_nonzero(vector <= cut, axis=0)
        less = np.minimum(left, n - left)
        dim = int(less.argmax())
        if less[dim] > best:
            best, found = int(less[dim]), (dim, cut)
    return found


def grow(vector: np.ndarray, most: float, tight: bool) -> Node:
    """A k-d tree whose leaves have up to `most` points, or points that are all alike. Boxes
    are those of the points (`tight`), or those of the cuts, which hold whatever comes."""

    def node(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> Node:
        own = vector[at]
        if tight:
            low, high = own.min(axis=0), own.max(axis=0)
        out = Node(low, high)
        found = _best_cut(own) if len(at) > most else None
        if found is None:
            out.points = at
            return out
        out.dim, out.cut = found
        left = own[:, out.dim] <= out.cut
        for side, mine in enumerate((left, ~left)):
            a, b = low.copy(), high.copy()
            if side:
                a[out.dim] = out.cut + 1
            else:
                b[out.dim] = out.cut
            out.parts.append(node(at[mine], a, b))
        return out

    if not len(vector):
        edge = np.zeros(DIMS, np.int8)
        return Node(edge, edge + np.int8(MOST), np.zeros(0, np.int64))
    edge = np.zeros(DIMS, np.int8)
    return node(np.arange(len(vector)), edge, edge + np.int8(MOST))


def reach(root: Node, vector: np.ndarray, more: int, less: int) -> Iterator[tuple[Node, np.ndarray]]:
    """Leaves, and which of the vectors can come into each by adding up to `more` letters and
    taking away up to `less`."""
    stack = [(root, np.arange(len(vector)))]
    while stack:
        node, at = stack.pop()
        own = vector[at]
        up = np.maximum(node.low - own, 0).sum(axis=1)
        down = np.maximum(own - node.high, 0).sum(axis=1)
        at = at[(up <= more) & (down <= less)]
        if not len(at):
            continue
        if node.parts:
            stack += [(part, at) for part in node.parts]
        else:
            yield node, at


def number(root: Node) -> int:
    """Number the leaves of a tree; how many there are."""
    n, stack = 0, [root]
    while stack:
        node = stack.pop()
        stack += node.parts
        if not node.parts:
            node.leaf, n = n, n + 1
            node.points = None
    return n


# One leaf


def near_pairs(
    short: np.ndarray, points: np.ndarray, tree: Node, vector: np.ndarray, bits: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of `short`, row of `points`) one edit apart. Both are code points; `short` has
    words as long as the points or shorter by one letter; `vector` and `bits` are the points'."""
    shorter = points.shape[1] - short.shape[1]
    own = vectors(short)
    own_bits = marks(own)
    for box, at in reach(tree, own, 1, 0 if shorter else 1):
        step = max(1, CELLS // len(box.points))
        there = bits[box.points]
        for a in range(0, len(at), step):
            mine = at[a : a + step]
            far = np.bitwise_count(own_bits[mine][:, None, :] ^ there[None, :, :]).sum(axis=2, dtype=np.uint8)
            q, p = np.nonzero(far <= (1 if shorter else 2))
            q, p = mine[q], box.points[p]
            wide = max(1, CELLS // points.shape[1])
            for b in range(0, len(q), wide):
                one, other = q[b : b + wide], p[b : b + wide]
                near = _one_edit(short[one], points[other], shorter)
                yield one[near], other[near]


def _one_edit(short: np.ndarray, long: np.ndarray, shorter: int) -> np.ndarray:
    if not shorter:
        return np.count_nonzero(short != long, axis=1) == 1
    n = short.shape[1]
    front = np.minimum.accumulate(short == long[:, :n], axis=1).sum(axis=1)
    back = np.minimum.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= n


class _Best:
    """Per word the number of near words and the best of them, of largest n, then smallest."""

    def __init__(self, size: int):
        self.count = np.zeros(size, np.int64)
        self.place = np.full(size, np.iinfo(np.int64).max)

    def add(self, at: np.ndarray, places: np.ndarray) -> None:
        np.add.at(self.count, at, 1)
        np.minimum.at(self.place, at, places)


def _ranked(names: list[str], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each word by n, then by its letters; and the words in that order."""
    order = np.array(sorted(range(len(names)), key=lambda i: (-n[i], names[i])), np.int64)
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    return place, order


FOUND = "word string, n long, n_near long, form_n long, form string"


def _search(block: pa.Table) -> pa.Table:
    """What the words of one block have near them in it."""
    role = block.column("role").to_numpy()
    names = [block.filter(pa.array(role == r)).column("word").to_pylist() for r in range(3)]
    n = [block.filter(pa.array(role == r)).column("n").to_numpy() for r in range(3)]
    out: dict[str, list] = {"word": [], "n_near": [], "form_n": [], "form": []}

    def give(r: int, best: _Best, order: np.ndarray, of: int) -> None:
        for i in np.flatnonzero(best.count).tolist():
            form = int(order[best.place[i]])
            out["word"].append(names[r][i])
            out["n_near"].append(int(best.count[i]))
            out["form_n"].append(int(n[of][form]))
            out["form"].append(names[of][form])

    if names[POINT]:
        points = codes(names[POINT])
        vector = vectors(points)
        tree, bits = grow(vector, BOX, True), marks(vector)
        place, order = _ranked(names[POINT], n[POINT])
        for r in (SAME, SHORTER):
            if not names[r]:
                continue
            mine, theirs = _Best(len(names[r])), _Best(len(names[POINT]))
            own_place, own_order = _ranked(names[r], n[r])
            for q, p in near_pairs(codes(names[r]), points, tree, vector, bits):
                mine.add(q, place[p])
                if r == SHORTER:
                    theirs.add(p, own_place[q])
            give(r, mine, order, POINT)
            if r == SHORTER:
                give(POINT, theirs, own_order, r)
    return pa.table(
        [
            pa.array(out["word"], pa.string()),
            pa.nulls(len(out["word"]), pa.int64()),
            pa.array(out["n_near"], pa.int64()),
            pa.array(out["form_n"], pa.int64()),
            pa.array(out["form"], pa.string()),
        ],
        ["word", "n", "n_near", "form_n", "form"],
    )


# All words


def _trees(counted: DataFrame, leaf: int, sample: int) -> dict[int, Node]:
    """A coarse tree for each length that words have, from a sample of at most about `sample`
    words chosen by their hash. The driver gets one row a length and the sample."""
    sizes = dict(counted.groupBy("size").agg(F.count("*")).collect())
    total = sum(sizes.values())
    large = [size for size, n in sizes.items() if n > leaf]
    share = min(1.0, sample / max(total, 1))
    chosen = counted.where(F.col("size").isin(large)) if large else counted.limit(0)
    chosen = chosen.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)))
    by_size: dict[int, list[str]] = {}
    for size, word in chosen.select("size", "word").collect():
        by_size.setdefault(size, []).append(word)
    out = {}
    for size, n in sizes.items():
        names = sorted(by_size.get(size, []))
        vector = vectors(codes(names)) if names else np.zeros((0, DIMS), np.int8)
        # As many of the sample as stand for a leaf of all words
        out[size] = grow(vector, leaf * len(names) / n if names else 1, False)
        number(out[size])
    return out


def _dealt(counted: DataFrame, leaf: int, sample: int) -> DataFrame:
    """size and leaf (where), role, word, n: each word as a point of its own leaf and as a
    searching word of all leaves that it may have near words in."""
    trees = counted.sparkSession.sparkContext.broadcast(_trees(counted, leaf, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("word").to_pylist()
            sizes = np.array([len(w) for w in names])
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                vector = vectors(codes([names[i] for i in rows]))
                for role, to, more, less in (
                    (POINT, size, 0, 0), (SAME, size, 1, 1), (SHORTER, size + 1, 1, 0)
                ):
                    if (tree := trees.value.get(to)) is None:
                        continue
                    for node, at in reach(tree, vector, more, less):
                        own = batch.take(pa.array(rows[at]))
                        alike = [np.full(len(at), x) for x in (to, node.leaf, role)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                *(pa.array(x, pa.int32()) for x in alike),
                                own.column("word"),
                                own.column("n"),
                            ],
                            ["size", "leaf", "role", "word", "n"],
                        )

    return counted.select("word", "n").mapInArrow(
        run, "size int, leaf int, role int, word string, n long"
    )


def _blocks(dealt: DataFrame, leaf: int, searching: int) -> DataFrame:
    """Rows with the block that they are searched in: a leaf, or where it has too many points or
    searching words, one part of the points with one part of the others."""
    point = F.col("role") == POINT
    parts = dealt.groupBy("size", "leaf").agg(
        F.ceil(F.count_if(point) / (2 * leaf)).alias("p"),
        F.ceil(F.count_if(~point) / searching).alias("q"),
    )
    # One row a leaf; there are no more of them than words in the sample, and lengths
    rows = dealt.join(F.broadcast(parts), ["size", "leaf"])
    h = F.xxhash64("word")
    numbers: Column = F.when(
        point, F.transform(F.sequence(F.lit(1), "q"), lambda q: F.struct(F.pmod(h, "p").alias("p"), q.alias("q")))
    ).otherwise(
        F.transform(F.sequence(F.lit(1), "p"), lambda p: F.struct((p - 1).alias("p"), (F.pmod(h, "q") + 1).alias("q")))
    )
    numbers = F.when((F.col("p") > 0) & (F.col("q") > 0), numbers)
    return rows.withColumn("block", F.explode(numbers)).select(
        "size", "leaf", F.col("block.p").alias("p"), F.col("block.q").alias("q"), "role", "word", "n"
    )


def near_words(
    counted: DataFrame, leaf: int = LEAF, searching: int = SEARCHING, sample: int = SAMPLE
) -> DataFrame:
    """word, n, n_near (words one edit apart), form (the one of largest n, the smallest of
    equal ones; null if none) and form_n of every row of `counted` (word, n)."""
    counted = kept_table(counted.select("word", "n", F.length("word").alias("size")), "words")
    dealt = kept_table(_dealt(counted, leaf, sample), "dealt")
    found = (
        _blocks(dealt, leaf, searching)
        .groupBy("size", "leaf", "p", "q")
        .applyInArrow(_search, FOUND)
    )
    nothing = [F.lit(None).cast(kind).alias(c) for c, kind in (("form_n", "long"), ("form", "string"))]
    alone = counted.select("word", "n", F.lit(0).cast("long").alias("n_near"), *nothing)
    # The smallest of (-n, word) is the best; a struct of nulls stands for none
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form")))
    return (
        alone.unionByName(found)
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the way from word to form ends. Each round doubles the steps, from
    written tables, until none moves; n at least doubles with a step, so the rounds are few."""
    at = kept_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("to"))
        at = kept_table(
            at.select("word", "root").join(on, "root", "left").select(
                "word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")
            ),
            "roots",
        )
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def variants(
    counted: DataFrame,
    times: int = 2,
    leaf: int = LEAF,
    searching: int = SEARCHING,
    sample: int = SAMPLE,
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of `counted` (word, n; each word once).

    Near words differ by exactly one inserted, deleted or replaced code point. form is the near
    word of largest n (ties: the smallest by code points) if its n is at least `times` the
    word's, else null, as form_n then is; root follows the forms to the last one, the word
    itself without any. Null words go, an empty table gives no rows, further columns are left out.
    Long words cost memory in proportion; no list of all pairs is ever made: each block hands
    on a count and the best near word of each of its words. Files go to the shared folder.
    """
    counted = counted.where(F.col("word").isNotNull() & (F.length("word") > 0))
    near = near_words(counted, leaf, searching, sample)
    right = F.col("form_n") >= times * F.col("n")
    found = kept_table(
        near.select(
            "word", "n", "n_near",
            F.when(right, F.col("form")).alias("form"),
            F.when(right, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
