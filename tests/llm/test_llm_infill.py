"""Fill-in-the-middle, against the layout said in plain Python and by exact round trips."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallyforge.llm import infill
from tallyforge.llm.queries import QUERIES

ODD = [
    (1, None),
    (2, ""),
    (3, "<P> in the text"),
    (4, "ends in <S>"),
    (5, "a<M"),
    (5, "a<M"),
    (None, "no id here"),
    (None, "no id here"),
    (6, "S> P> M> <\U0001f600 é中 \x00"),
    (7, "word " * 200_000),
    (8, "é" * 100_000),
    (9, "a" * 300_000),
]


def plain(doc_id, text, seed=1):
    """The contract's row for a text, and its output."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, len(units), "plain", None, None, text)
    if h[3] % 100 < 20:
        out, form = f"<S>{suffix}<P>{prefix}<M>{middle}", "spm"
    else:
        out, form = f"<P>{prefix}<S>{suffix}<M>{middle}", "psm"
    return (doc_id, len(units), form, len(prefix), len(middle), out)


def by_row(rows):
    return sorted(map(tuple, rows), key=repr)


def test_swaps_are_undone_by_swapping_back():
    choose = random.Random(5)
    for _ in range(300):
        n = choose.randint(0, 30)
        a, b, c = sorted(choose.randint(0, n) for _ in range(3))
        line = np.arange(n)
        infill.swap(line, a, b, c)
        assert line.tolist() == [*range(a), *range(b, c), *range(a, b), *range(c, n)]
        infill.swap(line, a, a + c - b, c)
        assert line.tolist() == list(range(n))


def test_arrange_and_rebuild():
    choose = random.Random(6)
    for _ in range(3000):
        text = "".join(choose.choice("ab <>PSMé中\U0001f600\n") for _ in range(choose.randint(0, 12)))
        if any(m in text for m in ("<P>", "<S>", "<M>")):
            continue
        cuts = sorted(choose.randint(0, len(text)) for _ in range(2))
        places = [len(text[:c].encode()) for c in cuts]
        p, m, s = text[: cuts[0]], text[cuts[0] : cuts[1]], text[cuts[1] :]
        for form, want in (("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}")):
            out = bytes(infill.arrange(text.encode(), *places, form))
            assert out == want.encode()
            assert infill.rebuild(out, form) == text.encode()


def test_transform_matches_plain_python(docs):
    choose = random.Random(7)
    letters = "abcdefgh   .,<>PSM\n0é中\U0001f600"
    pairs = ODD + [
        (i, "".join(choose.choice(letters) for _ in range(choose.randint(0, 200))))
        for i in range(100, 400)
    ]
    formed = infill.transform(docs(pairs, 3)).cache()
    assert by_row(formed.collect()) == by_row(plain(*p) for p in pairs)
    back = infill.restore(formed).select("doc_id", "restored")
    assert by_row(back.collect()) == by_row((i, t or "") for i, t in pairs)
    formed.unpersist()


def test_shares_of_the_forms(docs):
    texts = docs([(i, "some words here") for i in range(2000)])
    n = dict(infill.transform(texts).groupBy("form").count().collect())
    assert 150 < n["plain"] < 250 and 280 < n["spm"] < 440
    n = dict(infill.transform(texts, seed=7, plain=0, spm=100).groupBy("form").count().collect())
    assert n == {"spm": 2000}


def test_empty_table_and_clashing_columns(spark, docs):
    none = docs([(1, "x")]).limit(0)
    assert infill.restore(infill.transform(none)).collect() == []
    clash = spark.createDataFrame(
        [(1, "one two three", "f", "o", 5)],
        "doc_id int, text string, form string, output string, N long",
    )
    row = infill.restore(infill.transform(clash)).first()
    assert tuple(row)[:6] == plain(1, "one two three") and row.restored == "one two three"


@pytest.mark.parametrize("name", ["op11_infill"])
def test_query(spark, name):
    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = [(*(row := plain(*t))[:5], digest(row[5]), digest(t.text or "")) for t in texts]
    assert by_row(QUERIES[name](spark, folder).collect()) == by_row(want)
