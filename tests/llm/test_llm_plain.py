"""Fingerprints, scores and fits against plain versions; very long texts."""

import functools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tallyforge.llm import chat, decontaminate, lattice, simhash, spotsigs, toxicity
from tallyforge.llm.queries import tokenizer

# SpotSigs


def plain_signatures(text):
    tokens = re.findall(rb"[0-9a-z\x80-\xff]+", text.lower().encode())
    hashes = [xxhash.xxh64_intdigest(t) for t in tokens]
    codes = [
        h & ~3 | (t in spotsigs.ANCHORS) | (t in spotsigs.ANCHORS or (h >> 32) % 16 == 0) << 1
        for t, h in zip(tokens, hashes, strict=True)
    ]
    content = [i for i, c in enumerate(codes) if not c & 1]
    mix, most = 0x9E3779B97F4A7C15, 2**64 - 1
    out = set()
    for i, code in enumerate(codes):
        chain = [codes[j] for j in content if j > i][: spotsigs.CHAIN]
        if code & 2 and len(chain) == spotsigs.CHAIN:
            h = code
            for c in chain:
                h = ((h ^ h >> 29) * mix + c) & most
            out.add(((h ^ h >> 32) * mix & most) >> 32)
    return out or {xxhash.xxh64_intdigest(b" ".join(tokens) or text.encode()) >> 32}


def test_fingerprints_and_neighbours_match_plain_python(docs):
    choose = random.Random(1)
    words = ["the", "of", "und", "la", "en", "A1", "Straße", "x", *(f"w{i}" for i in range(40))]
    pairs = [
        (i, choose.choice([" ", "-", " . "]).join(choose.choice(words) for _ in range(choose.randint(0, 60))))
        for i in range(60)
    ] + [(60, None), (61, ""), (62, "...")]
    got = {r.doc_id: r for r in spotsigs.compare_edited(docs(pairs, 3)).collect()}
    text = {i: t or "" for i, t in pairs}
    for i in text:
        own, after = plain_signatures(text[i]), text[i - 1 if i else 62]
        assert got[i].fingerprint == "".join(f"{s:08x}" for s in sorted(own))
        half = len(text[i]) // 2
        edited = plain_signatures(text[i][: len(text[i]) - half] + after[:half])
        following = plain_signatures(after)
        assert got[i].near_edited == pytest.approx(len(own & edited) / len(own | edited))
        assert got[i].near_next == pytest.approx(len(own & following) / len(own | following))


# Lattice


def plain_marginal(word, weights):
    """Sum over all segmentations, by recursion over the rest of the word."""

    @functools.cache
    def rest(at):
        if at == len(line):
            return 1.0
        ways = [
            math.exp(weights[line[at:end]]) * rest(end)
            for end in range(at + 1, len(line) + 1)
            if line[at:end] in weights
        ]
        if line[at] not in weights:
            ways.append(math.exp(weights[None]) ** len(line[at].encode()) * rest(at + 1))
        return sum(ways)

    line = lattice.SPACE + word
    return rest(0)


@pytest.mark.parametrize("known", [5, 10**6])
def test_score_matches_the_formula(spark, docs, monkeypatch, known):
    choose = random.Random(2)
    words = ["the", "of", "thing", "中x", "é", "Strange", "q" * 12]
    pairs = [(i, " ".join(choose.choice(words) for _ in range(choose.randint(0, 9)))) for i in range(60)]
    pairs += [(60, None), (None, "no id the"), (61, "unseen wörd\tthe")]
    learned = []
    real = lattice.learn
    monkeypatch.setattr(lattice, "learn", lambda *a: learned.append(real(*a)) or learned[-1])
    got = lattice.score(docs(pairs, 3), tokenizer(), known).collect()
    train = [t or "" for i, t in pairs if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in t.encode().lower().decode().split())
    # All documents are in one language; the pooled one has none
    names = sorted({"en", ""})
    ends = {k: float(len(train) if k == "en" else 0) for k in names}
    by = {"en": counts, "": Counter()}
    once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
    discount = once / (once + 2 * twice) if once and twice else 0.5
    pieces, _ = lattice.vocabulary(tokenizer())
    weights = [dict(zip([*pieces, None], row.tolist(), strict=True)) for row in learned[0]]
    first = dict(zip([*pieces, None], lattice.first_weights(tokenizer()).tolist(), strict=True))
    want = {}
    for i, t in pairs:
        tokens = (t or "").encode().lower().decode().split()
        total = 0.0
        for k, name in enumerate(names):
            n = sum(by[name].values()) + ends[name] + 1
            kinds = len(by[name]) * discount + 0.5
            lp = math.log10((ends[name] + 0.01) / (sum(ends.values()) + 0.01 * len(names)))
            lp += math.log10((ends[name] + 0.5) / n)
            for w in tokens:
                kept = max(by[name][w] - discount, 0)
                lp += math.log10((kept + kinds * plain_marginal(w, weights[k])) / n)
            total += 10**lp
        want[i, t] = (math.log10(total), sum(math.log10(plain_marginal(w, first)) for w in tokens))
    text = dict(pairs)
    for r in got:
        score, own = want[r.doc_id, text[r.doc_id]]
        assert r.score == pytest.approx(score, rel=1e-6)
        assert r.vocabulary_score == pytest.approx(own, rel=1e-6, abs=1e-9)


def test_long_words_equal_short_steps(monkeypatch):
    choose = random.Random(3)
    pieces, _ = lattice.vocabulary(tokenizer())
    weights = np.stack([lattice.first_weights(tokenizer())] * 2)
    weights[1] *= 1.1
    words = ["".join(choose.choice("abdeé中\U0001f600th") for _ in range(n)) for n in (3, 60, 200, 400)]
    counts = np.array([[1.0, 0], [2, 1], [1, 1], [0, 3]])
    short = lattice.Lattice(pieces, weights)
    monkeypatch.setattr(lattice, "LONG", 10)
    monkeypatch.setattr(lattice, "STRETCH", 64)
    long = lattice.Lattice(pieces, weights)
    one = long.log_probability(words), long.expected(words, counts)
    monkeypatch.setattr(lattice, "LONG", 1000)
    assert np.allclose(one[0], short.log_probability(words))
    assert np.allclose(one[1], short.expected(words, counts))


def test_a_text_without_spaces_takes_seconds(docs):
    # An untimed pass starts the workers
    lattice.score(docs([(1, "a b")]), tokenizer()).collect()
    start = time.time()
    got = lattice.score(docs([(1, "abcde" * 200_000), (2, "中" * 30_000), (3, "a b")]), tokenizer()).collect()
    assert time.time() - start < 240
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


# Toxicity


def loss(x, grade, w, cuts, grades):
    edges = [-np.inf, *cuts, np.inf]
    score = x @ w
    high = 1 / (1 + np.exp(-(np.take(edges, grade + 1) - score)))
    low = 1 / (1 + np.exp(-(np.take(edges, grade) - score)))
    return -np.mean(np.log(high - low))


@pytest.mark.parametrize("grades", [3, 5])
def test_the_fit_is_a_minimum(grades):
    random_ = np.random.default_rng(4)
    x = random_.normal(size=(500, 6)).astype(np.float32)
    grade = np.clip((x @ [2, -1, 0.5, 0, 0, 0] + random_.logistic(size=500) + grades / 2).astype(int), 0, grades - 1)
    w, cuts = toxicity._regress(x, grade, 1e-3, 3000, grades)
    assert len(cuts) == grades - 1 and list(cuts) == sorted(cuts)

    def value(w, cuts):
        return loss(x, grade, w, cuts, grades) + 1e-3 * np.abs(w).sum()

    best = value(w, cuts)
    for i in range(6):
        for step in (-0.02, 0.02):
            other = w.copy()
            other[i] += step
            assert value(other, cuts) > best
    for i in range(grades - 1):
        for step in (-0.02, 0.02):
            other = list(cuts)
            other[i] += step
            assert value(w, other) > best


def labelled(spark, n, grade):
    bad = ["vile", "awful", "nasty"]
    rows = [(i, "plain words here and there " * 3 + " ".join(bad[: grade(i)] * 2)) for i in range(n)]
    labels = spark.createDataFrame([(i, grade(i)) for i in range(n)], "doc_id long, toxic int")
    return spark.createDataFrame(rows, "doc_id long, text string"), labels


def test_grades_of_the_labels_are_kept(spark):
    docs, labels = labelled(spark, 200, lambda i: i % 4)
    model = toxicity.fit(docs, labels, penalty=1e-5)
    assert len(model.thresholds) == 3
    got = {r.doc_id: r for r in toxicity.severity(docs, model).collect()}
    assert sum(got[i].grade == i % 4 for i in got) > 190
    assert got[1].severity < got[2].severity < got[3].severity


def test_chosen_features_match_plain_ratios(spark):
    docs, labels = labelled(spark, 100, lambda i: int(i % 3 == 0))
    model = toxicity.fit(docs, labels, features=4, penalty=0.0)
    n1, n0 = 34, 66

    def ratio(bad, good):
        out = 0.0
        for x, n in ((bad, n1), (good, n0)):
            share = (bad + good) / 100
            out += x * math.log(x / (n * share)) if x else 0
            out += (n - x) * math.log((n - x) / (n * (1 - share))) if n - x else 0
        return out

    seen = Counter()
    for r in docs.collect():
        words = set(re.findall(r"[^\W\d_]+", r.text.lower()))
        seen.update({f for w in words for f in toxicity._names(w)})
    found = {f: ratio(*((n, 0) if f.startswith("vil") else (n1, n0))) for f, n in seen.items() if n >= 3 and n < 100}
    want = sorted(found, key=lambda f: (-found[f], f))[:4]
    assert set(model.weights) <= {*want, *(f for f, n in seen.items() if n == 100)} and "vile" in model.weights


# Very long texts


def test_long_texts(spark, docs):
    line = " ".join(f"w{i % 5000}" for i in range(150_000))
    table = docs([(1, line), (2, line + " more"), (3, "x" * 500_000), (4, "a " * 250_000)])
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(table).collect()}
    assert found[1] == found[2] == 1 and found[3] == 3
    assert {r.doc_id: r.n_chars for r in spotsigs.compare_edited(table).collect()}[1] == len(line)
    bench = spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(100, 130)))], "item_id long, text string")
    hits = {r.doc_id: len(r.spans) for r in decontaminate.contamination(table, bench).collect()}
    assert hits == {1: 30, 2: 30, 3: 0, 4: 0}


def test_long_turns(spark):
    odd = "<|im_end|>" * 20_000
    rows = [(1, 0, "user", "x" * 500_000), (1, 1, "assistant", odd), (1, 2, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_conversations(df)).first()
    assert [t.text for t in back.turns] == ["x" * 500_000, odd, ""] and back.learned == [odd]
