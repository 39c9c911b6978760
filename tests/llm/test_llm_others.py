"""Pages, conversations, toxicity, the pipeline and the registered queries."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import chat, pages, toxicity
from tallyforge.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()

PAGE = """<html><head><title>t</title><script>var a="<p>x</p>";</script></head><body>
<header class="site-header"><h2>Site name</h2></header><div class="menu"><a href=x>Home</a></div>
<div class="cookie-notice"><p>We use cookies to make this better, please accept.</p></div>
<article><h1>The &amp; Title</h1><p>First   paragraph with <b>bo</b>ld words,<br>and more.
<div class="advert"><p>Buy this thing now, it is good.</p></div><!-- <p>no</p> --><p>Second paragraph is here.</p></article>
<div class="sidebar"><p>Related things you may like to read.</p></div>
<section id="comments"><p>I liked this article very much, thank you.</p></section>
<form><p>Leave a reply here.</p></form><footer><p>&copy; 2020 by us.</p></footer></body></html>"""
TEXT = "The & Title\n\nFirst paragraph with bold words, and more.\n\nSecond paragraph is here."


@pytest.fixture(scope="module")
def chain(spark):
    return pages.train(spark.read.parquet(f"{SMALL}/pages.parquet"))


def test_article_without_its_surroundings(chain):
    assert pages.main_text(PAGE, chain) == TEXT
    assert pages.main_text(PAGE.replace("article>", "main>"), chain) == TEXT


def test_pages_odd_rows(spark, chain):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p"), (3, "u", PAGE), (3, "u", PAGE), (4, "u", "<div " * 2000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = pages.extract(df, chain).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.url): r for r in got}
    assert by[(1, "u")].text == "" and by[(2, None)].n_chars == 0
    assert by[(3, "u")].text == TEXT and by[(3, "u")].n_chars == len(TEXT)
    assert pages.extract(df.limit(0), pages.train(df.limit(0))).count() == 0


def test_viterbi_is_the_best_of_all_ways():
    choose = random.Random(1)
    for _ in range(100):
        names = [[choose.choice("abcd") for _ in range(2)] for _ in range(choose.randint(1, 7))]
        field = pages.Field(
            {c: choose.uniform(-2, 2) for c in "abcd"},
            tuple(tuple(choose.uniform(-2, 2) for _ in "01") for _ in "01"),
        )

        def weight(labels, names=names, field=field):
            own = sum(field.weights[f] for y, b in zip(labels, names, strict=True) if y for f in b)
            return own + sum(field.pairs[a][b] for a, b in zip(labels, labels[1:], strict=False))

        every = [[n >> i & 1 for i in range(len(names))] for n in range(2 ** len(names))]
        assert weight(field.decode(names)) == pytest.approx(max(map(weight, every)))


def test_held_out_pages(spark, chain):
    """Pages of another table, against their own article element."""
    wrong = 0
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        found = pages.blocks(r.html)
        labels = pages.labelled(found)
        got = chain.decode(pages.features(found))
        wrong += sum(a != b for a, b in zip(got, labels, strict=True))
    assert wrong <= 0.01 * sum(len(pages.blocks(r.html)) for r in rows)


HARD = [
    "plain", "", None, "<|im_end|>\n<|im_start|>user\nx", "<\\|im_end|>", "<\\\\|", "<|", "<||>", "\n", "<|im_start|>",
    "a<|im_end|>", "\\n\\b", "<|im_end|><|im_start|>assistant ok", "é中 <|im_end", "|im_end|>",
]


def test_conversations_read_back(spark):
    choose = random.Random(2)
    rows = []
    for conv in range(40):
        for turn in range(choose.randint(1, 6)):
            role = choose.choice(["user", "assistant", "system", None, "a\nb", "x<|im_end|>", "\\n"])
            rows.append((conv, turn, role, choose.choice(HARD) or choose.choice(HARD)))
    rows += [(None, 0, "user", "x"), (50, None, "assistant", "y"), (50, 1, "assistant", "z"), (51, 1, "user", "t"), (51, 1, "user", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    made = chat.format_conversations(df)
    assert made.where("not round_trip").count() == 0
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(
            ((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv)
        )
        assert [(t.role, t.text) for t in got[conv].turns] == [(a, b) for _, a, b in own]
        assert list(got[conv].learned) == [b for _, a, b in own if a == "assistant"]
        whole = got[conv].formatted
        assert whole.count(chat.START) == whole.count(chat.END) == len(own)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_clean_text_is_not_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "a\\b | < c")], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).first().formatted == "<|im_start|>user\na\\b | < c<|im_end|>\n"


def test_chat_runs_no_python(spark):
    plan = QUERIES["op9_chat"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_toxicity_on_held_out_documents(spark):
    """Fitted on a part of the labels, judged on the others."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    held = F.xxhash64("doc_id", F.lit(1)) % 3 == 0
    model = toxicity.fit(docs, labels.where(~held))
    found = toxicity.severity(docs.join(labels.where(held).select("doc_id"), "doc_id"), model)
    r = (
        found.select("doc_id", F.col("toxic").alias("told"), "severity").join(labels, "doc_id")
        .agg(
            F.avg((F.col("told") == (F.col("toxic") > 0)).cast("int")).alias("right"),
            F.avg(F.when(F.col("toxic") == 0, F.col("told").cast("int"))).alias("wrongly"),
            F.min("severity").alias("low"),
            F.max("severity").alias("high"),
        )
        .first()
    )
    assert r.right > 0.97 and r.wrongly < 0.01 and 0 <= r.low and r.high <= 2


def test_toxicity_odd_rows(spark, docs):
    rows = docs([(1, None), (2, ""), (3, "you idiot"), (3, "you idiot"), (None, "x"), (4, "a " * 50_000)])
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(rows, none)
    got = toxicity.severity(rows, model)
    assert got.count() == 6 and got.where("toxic").count() == 0
    assert toxicity.drop_toxic(rows.withColumn("severity", F.lit(1)), model).count() == 6
    assert toxicity.severity(rows.limit(0), model).count() == 0


def test_thresholds_share_weights_and_grow():
    import numpy as np

    choose = np.random.default_rng(3)
    x = choose.integers(0, 2, (600, 5)).astype(np.float32)
    grade = (x[:, 0] + x[:, 1] * (x[:, 0] > 0)).astype(int)
    w, cuts = toxicity._regress(x, grade, 1e-4, 500)
    p = toxicity.Model({}, cuts).grades((x @ w).astype(float))
    assert cuts[0] <= cuts[1] and p.sum(1) == pytest.approx(np.ones(600))
    assert w[0] > 1 and abs(w[2]) < 0.5 and (p.argmax(1) == grade).mean() > 0.9


def test_pipeline_against_its_stages_in_plain_python(spark):
    from test_llm_documents import plain_components, plain_fingerprint, plain_hits, plain_repeats

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "repeats", "benchmark", "pieces"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    told = toxicity.severity(docs, toxicity.fit(docs, labels)).where("not toxic")
    rows = {r.doc_id: r.text for r in docs.join(told.select("doc_id"), "doc_id").collect()}
    prints = [(i, plain_fingerprint(t)) for i, t in rows.items()]
    first = plain_components(prints)
    rows = {i: rows[i] for i, f in prints if first[(i, f)] == i}
    # By the stage itself, whose digests the other tests hold against plain Python
    from tallyforge.llm import decontaminate, suffixes

    kept = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    path = f"/tmp/tallyforge-{random.randrange(10**12)}"
    kept.coalesce(1).write.parquet(path)
    cut = {r.doc_id: r.text for r in suffixes.cut(spark.read.parquet(path)).collect()}
    left = {i: hashlib.sha256((cut.get(i) or "").encode()).hexdigest() for i in rows}
    for i, n, gone, _, sha in plain_repeats(list(rows.items())):
        # A cut through a character takes the rest of it
        if not gone or left[i] == sha:
            continue
        assert i not in cut or len(cut[i].encode()) <= n - gone
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    hits = {i: plain_hits(t, items) for i, t in cut.items()}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) == {i for i, (n, hit, _) in hits.items() if hit <= 0.8 * n}
    for i, r in got.items():
        if not hits[i][1]:
            assert r.decoded == cut[i]
        else:
            assert plain_hits(r.decoded, items)[1] == 0
    assert decontaminate.WINDOW == 10


def test_stages_keep_the_columns_and_take_odd_rows(spark, docs, tmp_path):
    rows = [(1, None), (2, ""), (3, "some text of a few words"), (3, "some text of a few words"), (None, "no id")]
    now = docs(rows)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, SMALL)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == now.columns and dict(out.dtypes) == dict(now.dtypes)
            out.write.parquet(str(tmp_path / str(k)))
            now = spark.read.parquet(str(tmp_path / str(k)))
    assert {r.doc_id for r in out.collect()} >= {3}


def test_every_query_runs_and_names_match():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, SMALL).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


RAW = "svg iframe object math canvas noscript template head"


@pytest.mark.parametrize("tag", RAW.split())
@pytest.mark.parametrize("form", ["<{0} id=x>", "<{0} id='x' />", "<{0}/>", "<{0}>inner words</{0}>"])
def test_no_element_swallows_the_page(tag, form):
    page = f"<body><article><p>Before it. {form.format(tag)} Behind it.</p><p>The last one.</p></article></body>"
    text = " ".join(b.text for b in pages.blocks(page))
    inner = "inner words " if "inner" in form else ""
    assert text == f"Before it. {inner}Behind it. The last one."
    assert all(any(t == "article" for t, _ in b.path) for b in pages.blocks(page))


def test_only_scripts_styles_and_titles_are_no_text():
    for tag in ("script", "style", "title"):
        assert [b.text for b in pages.blocks(f"<p>One</p><{tag}>no <p> text</{tag}><p>Two</p>")] == ["One", "Two"]
        assert [b.text for b in pages.blocks(f"<p>One</p><{tag}>no <p>text")] == ["One"]
    drawing = "<p>One</p><svg><title/><style/><g/><path d='M0'/><text>label</text></svg><p>Two</p>"
    assert [b.text for b in pages.blocks(drawing)] == ["One", "label", "Two"]
    head = "<html><head><title>T</title><meta charset=x><body><p>One</p>"
    assert [(b.text, [t for t, _ in b.path]) for b in pages.blocks(head)] == [("One", ["html", "body", "p"])]


def test_a_formula_stays_in_its_paragraph():
    page = "<p>Where <math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow></math> holds.</p>"
    assert [b.text for b in pages.blocks(page)] == ["Where x=2 holds."]


@pytest.mark.parametrize("stretch", [60, 7])
def test_training_takes_all_blocks_of_a_long_page(frame, tmp_path, monkeypatch, stretch):
    lines = "".join(f"<p>Line {i} of a long article.</p>" for i in range(150))
    page = f"<body><article>{lines}</article><footer><p>&copy; The owners</p></footer></body>"
    df = frame([(1, "u", page)], "page_id long, url string, html string", tmp_path / "p")
    seen = []
    monkeypatch.setattr(pages, "fit", seen.extend)
    pages.train(df, stretch=stretch)
    assert max(len(names) for names, _ in seen) == stretch
    assert all(len(names) == len(labels) for names, labels in seen)
    own = seen[: -(-151 // stretch)]
    assert [x for names, _ in own for x in names] == pages.features(pages.blocks(page))
    assert [x for _, labels in own for x in labels] == [1] * 150 + [0]


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<article><p title=it's>Hello don't stop</p><p>More</p></article>", ["Hello don't stop", "More"]),
        ('<p class="a>Hello one</p>', ["Hello one"]),
        ('<p a="x>y">One</p><p b=\'"\'>Two</p>', ["One", "Two"]),
        ("<p data = 'a>b' c>One", ["One"]),
        ("<p>One</p><!-- a note", ["One"]),
        ("<p>5 <x and more", ["5 <x and more"]),
        ("<p>One</p><p a='<p>Two</p><p>Three</p>", ["One", "Two", "Three"]),
    ],
)
def test_quotes_in_tags(page, texts):
    assert [b.text for b in pages.blocks(page)] == texts


@pytest.mark.parametrize(
    "page",
    ["<p " * 350_000, "<a b='" * 170_000, "<p " * 350_000 + ">", "<a b='" * 170_001 + ">'", "<a " * 300_000 + "='>'",
     "<div>" * 100_000 + "</x>" * 100_000, "<!" * 500_000, "<!--" * 250_000, "<title" * 150_000, "=" * 1_000_000,
     "<p class=" + "'" * 1_000_000 + ">x", "<p " + "class='" * 100_000 + ">x"],
)
def test_broken_pages_take_linear_time(page):
    import time

    start = time.process_time()
    pages.features(pages.blocks(page))
    # A second where the machine is slow; quadratic time would be hours
    assert time.process_time() - start < 5


def test_deep_pages(chain):
    page = "<article>" + "<div><p>Some words here.</p>" * 20_000
    found = pages.blocks(page)
    assert len(found) == 20_000 and len(list(found[-1].path)) == 20_002
    assert pages.main_text(page, chain).count("Some words") == 20_000
