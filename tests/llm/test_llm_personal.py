"""Personal data: the base patterns against plain regular expressions, the field against sums over
all segmentations, made-up and made-by-hand cases."""

import hashlib
import itertools
import math
import random
import re
import time

import pytest

from tallyforge.llm import personal
from tallyforge.llm.queries import QUERIES


@pytest.fixture(scope="module")
def weights():
    return personal.fit(personal.made_up(["thorn", "ouest", "el", "niña"], 1500, 3))


def plain_base(text):
    """The contract's patterns as they are written."""

    def luhn(digits):
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return sum(d - 9 * (d > 9) for d in twice) % 10 == 0

    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((*m.span(), 0))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append((*m.span(), 1))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), 2))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((*m.span(), 3))
    found.sort(key=lambda s: (s[0], s[2]))
    return [(personal.KINDS[k], a, b) for a, b, k in found]


def test_base_matches_the_patterns():
    choose = random.Random(1)
    pieces = ["+1 (743) 555-3824", "4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "255.0.256.1", "a.b@c.d",
              "x@y", "@", "a@b.c@d.e", "a@b.c%x@y.z", "@@", "é", "٣", "+", "(", ")", "-", " ", " ", ".", "0", "00", "12", "x", "\n"]
    for _ in range(20_000):
        text = "".join(choose.choice(pieces) for _ in range(choose.randint(0, 8)))
        assert personal.base_spans(text) == plain_base(text), text
    for _ in range(300):
        text = "".join(choose.choice("0123456789.@a+ -") for _ in range(300))
        assert personal.base_spans(text) == plain_base(text), text


def segmentations(net, at=0):
    """All ways through a lattice, as lists of candidates (-1: other text)."""
    if at == net.places - 1:
        yield []
        return
    steps = [(at + 1, -1)] + [
        (end, number) for end in range(net.places) for begin, _, number in net.ending[end] if begin == at
    ]
    for end, number in steps:
        for rest in segmentations(net, end):
            yield [number, *rest]


def test_field_against_all_segmentations():
    choose = random.Random(2)
    for _ in range(200):
        spans = [
            (choose.choice(personal.KINDS), a, choose.randint(a + 1, 7))
            for a in (choose.randint(0, 6) for _ in range(choose.randint(1, 6)))
        ]
        net = personal.lattice(spans)
        scores = [choose.gauss(0, 2) for _ in net.spans]
        weights = {f"from {a} to {b}": choose.gauss(0, 1) for a in range(5) for b in range(5)}

        def value(way, net=net, scores=scores, weights=weights):
            labels = [personal.KINDS.index(net.spans[i][0]) + 1 if i >= 0 else 0 for i in way]
            steps = sum(
                weights[f"from {a} to {b}"] for a, b in itertools.pairwise([0, *labels]) if a or b
            )
            return sum(scores[i] for i in way if i >= 0) + steps

        ways = list(segmentations(net))
        best = max(ways, key=value)
        assert personal.best_path(net, scores, weights) == [i for i in best if i >= 0]
        total, share, _ = personal.expectations(net, scores, weights)
        assert math.isclose(total, math.log(sum(math.exp(value(w)) for w in ways)), abs_tol=1e-9)
        for i in range(len(net.spans)):
            mine = sum(math.exp(value(w) - total) for w in ways if i in w)
            assert math.isclose(share[i], mine, abs_tol=1e-9)


def test_held_out_examples(weights):
    right = wrong = missed = base_alone = 0
    for text, gold in personal.made_up(["drin", "fuera", "oust"], 1000, 99):
        base, added = personal.find(text, weights)
        found = {*base, *added}
        right += len(found & set(gold))
        wrong += len(found - set(gold))
        missed += len(set(gold) - found)
        base_alone += len(set(base) & set(gold))
    assert right / (right + wrong) > 0.96 and right / (right + missed) > 0.98
    assert base_alone / (right + missed) < 0.75


@pytest.mark.parametrize(
    "text, want",
    [
        ("x +1 (269) 555-3296 4524132264652876 and", ["phone:2:19", "card:20:36"]),
        ("4465758382889437 4465758382889437", ["card:0:16", "card:17:33"]),
        ("4451718024887799 27.65.93.188 Arr", ["card:0:16", "ip:17:29"]),
        ("call (743) 555-3824 now", ["phone:5:19"]),
        ("mary.doe [at] mail [dot] example [dot] com it", ["email:0:42"]),
        ('token = "1eb9c654e721b4f812088970e66a6345cee33dd6"', []),
        ("Version 2.0 of 2021-03-04 12:30, 1,234,567.00, page 12", []),
        ("6 7 8 9 10 11 12 13 14 15 16 17 18 19 20", []),
        ("we met at noon dot", []),
    ],
)
def test_cases(weights, text, want):
    base, added = personal.find(text, weights)
    got = sorted([*base, *added], key=lambda s: (s[1], personal.KINDS.index(s[0])))
    assert [":".join(map(str, s)) for s in got] == want


def test_added_spans_leave_base_spans_alone(weights):
    choose = random.Random(4)
    examples = personal.made_up([], 300, 5)
    for _ in range(300):
        text = choose.choice([" ", "", "\n"]).join(choose.choice(examples)[0] for _ in range(3))
        base, added = personal.find(text, weights)
        assert base == plain_base(text)
        both = [*base, *added]
        for i, (_, a, b) in enumerate(added):
            assert all(b <= x or y <= a for _, x, y in both[: len(base) + i])


@pytest.mark.parametrize(
    "text",
    ["1" * 500_000, "12 " * 30_000, "+" * 500_000, "(" * 500_000, "a" * 500_000, "a@" * 200_000, "1." * 200_000,
     "@ " * 200_000, " at a dot" * 20_000, "+1" * 100_000, "4111111111111111 " * 20_000, "a.b-c" * 100_000 + "@"],
)
def test_very_long_texts_take_linear_time(weights, text):
    def seconds(part):
        start = time.process_time()
        personal.find(part, weights)
        return time.process_time() - start

    assert seconds(text) < 8 * max(seconds(text[: len(text) // 3]), 0.1)


ROWS = [
    (1, None), (2, ""), (3, "a@b.c"), (3, "a@b.c"), (None, "+1 (743) 555-3824 4111111111111111"), (None, None),
    (4, "é" * 3 + "\U0001f600 x@y.org 1.2.3.4 " + "w " * 100_000 + "4111111111111111"),
]


def test_spans_and_mask(docs, weights):
    table = docs(ROWS)
    got = personal.spans(table, weights).collect()
    want = []
    for name, text in ROWS:
        base, added = personal.find(text or "", weights)
        both = sorted([(*s, True) for s in base] + [(*s, False) for s in added], key=lambda s: s[1])
        want.append((name, both))
    assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in got), key=repr) == sorted(want, key=repr)
    masked = {(r.doc_id, r.text) for r in personal.mask(table, weights).collect()}
    assert (3, "[EMAIL]") in masked and (None, "[PHONE] [CARD]") in masked and (1, None) in masked
    assert personal.mask(table, weights).columns == table.columns
    assert personal.spans(table.limit(0), weights).collect() == []


def test_training(docs):
    texts = [(i, f"word{i} +1 (743) 555-{1000 + i} and 4111111111111111 {'long ' * 2000}") for i in range(60)]
    one = personal.train(docs(texts, 2), 20, 300)
    assert one == personal.train(docs(texts[::-1], 5), 20, 300)
    empty = personal.train(docs([(1, None), (2, "")]), 20, 300)
    assert personal.find("x 4465758382889437 4465758382889437", empty)[1]


def test_clashing_columns(spark, weights):
    df = spark.createDataFrame([(1, "a@b.c", "s")], "doc_id int, text string, spans string")
    assert [tuple(s) for s in personal.spans(df, weights).first().spans] == [("email", 0, 5, True)]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in QUERIES["op12_personal"](spark, folder).collect()}
    assert len(rows) == len(docs)
    for name, text in docs:
        base, row = plain_base(text or ""), rows[name]
        line = ",".join(":".join(map(str, s)) for s in base)
        assert row.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(s[0] == kind for s in base) for kind in personal.KINDS
        ]
        assert {":".join(map(str, s)) for s in base} <= set(row.spans.split(","))
