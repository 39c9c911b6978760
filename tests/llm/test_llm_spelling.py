"""Spelling variants, against plain comparison of all words and cases made by hand."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyforge.llm import spelling
from tallyforge.llm.queries import QUERIES


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_variants(n_of, times=2):
    """The rows of `variants` from all pairs that share a word less one letter."""
    less = {}
    for w in n_of:
        for key in {(i, w[:i] + w[i + 1 :]) for i in range(len(w))}:
            less.setdefault(key, set()).add(w)
    near = {w: set() for w in n_of}
    for group in less.values():
        for w in group:
            near[w] |= group - {w}
    for w in n_of:
        for i in range(len(w)):
            if (shorter := w[:i] + w[i + 1 :]) in n_of:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-n_of[x], x))
            if n_of[best] >= times * n_of[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {
        w: (n, len(near[w]), form.get(w), n_of[form[w]] if w in form else None, root(w))
        for w, n in n_of.items()
    }


def found_variants(df):
    rows = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    found = {r.word: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def invented(seed, n):
    choose = random.Random(seed)
    letters = "abcdeéß"
    out = {}
    for _ in range(n):
        word = "".join(choose.choice(letters) for _ in range(choose.randint(3, 8)))
        out[word] = choose.randint(1, 60)
    return out


def table(spark, n_of):
    return spark.createDataFrame(list(n_of.items()), "word string, n long").repartition(3)


@pytest.mark.parametrize("sizes", [(10_000, 100_000, 200_000), (20, 30, 150), (5, 7, 0)])
def test_variants_match_plain_python(spark, sizes):
    n_of = invented(1, 600)
    got = spelling.variants(table(spark, n_of), 2, *sizes)
    assert found_variants(got) == plain_variants(n_of)


def test_words_made_of_the_same_letters(spark):
    # No cut between counts parts these words
    choose = random.Random(2)
    n_of = {"".join(choose.sample("aabbccdd", 8)): choose.randint(3, 9) for _ in range(400)}
    n_of |= {w[:-1]: 3 for w in list(n_of)[:50]}
    got = spelling.variants(table(spark, n_of), 2, 10, 15, 100)
    assert found_variants(got) == plain_variants(n_of)


def test_forms_lead_to_one_root(spark):
    n_of = {"aaaaa" + "b" * i: 2**i for i in range(12)} | {"aaaaaz": 1}
    got = found_variants(spelling.variants(table(spark, n_of)))
    assert got == plain_variants(n_of)
    assert got["aaaaa"][-1] == "aaaaa" + "b" * 11


def test_odd_words(spark):
    long = "x" * 50_000
    n_of = {
        long: 3, long + "x": 9, "y" + long: 4, "equal": 6, "equak": 3, "equam": 6, "\U0001f600abcd": 5,
        "\U0001f601abcd": 11, "z": 1, "zz": 2,
    }
    rows = [*n_of.items(), (None, 5), ("", 7)]
    df = spark.createDataFrame([(w, n, "f") for w, n in rows], "word string, n long, form string")
    assert found_variants(spelling.variants(df)) == plain_variants(n_of)
    assert spelling.variants(df.limit(0)).collect() == []


def test_vectors_move_by_two_at_most():
    choose = random.Random(3)
    for _ in range(2000):
        word = [choose.choice("aabcé中") for _ in range(choose.randint(2, 12))]
        other, at = list(word), choose.randrange(len(word))
        kind = choose.choice(("replace", "delete"))
        if kind == "replace":
            other[at] = choose.choice("xyzß")
        else:
            del other[at]
        a, b = (spelling.vectors(spelling.codes(["".join(w)])) for w in (word, other))
        assert np.abs(a - b).sum() <= (2 if kind == "replace" else 1)
        bits = np.bitwise_count(spelling.marks(a) ^ spelling.marks(b)).sum()
        assert bits == np.abs(a - b).sum()


def test_tree_reaches_every_near_point():
    letters = np.random.default_rng(4).integers(97, 103, (500, 6), dtype=np.uint32)
    vector = spelling.vectors(letters)
    for tight in (True, False):
        tree = spelling.grow(vector, 10, tight)
        met = {(q, p) for node, at in spelling.reach(tree, vector, 1, 1) for q in at for p in node.points}
        up = np.maximum(vector[None] - vector[:, None], 0).sum(axis=2)
        near = np.argwhere((up <= 1) & (up.T <= 1))
        assert {tuple(x) for x in near.tolist()} <= met
        assert len(met) < 500 * 500


def plain_words(rows, slips=97):
    counts = Counter()
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(lower)
            h = zlib.crc32(f"{'' if name is None else name}:{word}".encode())
            if slips and h % slips == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return counts


def test_words_of_documents(docs):
    rows = [(i, " ".join(f"{chr(65 + i % 26)}word{'é' * (i % 3)}×{i}ÀB" for _ in range(5))) for i in range(300)]
    rows += [(1, None), (2, ""), (None, "No ID é"), (None, "No ID é"), (3, "long " * 100_000), (4, "a" * 200_000)]
    for slips in (97, 3, None):
        got = spelling.words(docs(rows), slips).groupBy("word").count().collect()
        assert {tuple(r) for r in got} == set(plain_words(rows, slips).items())


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    n_of = {w: n for w, n in plain_words(rows).items() if len(w) >= 5 and n >= 3}
    assert found_variants(QUERIES["op13_spelling"](spark, folder)) == plain_variants(n_of)
