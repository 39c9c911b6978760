import pytest
from helpers import final_plan, lines, ordered, rows
from pyspark.sql import functions as F

from tallyforge.operators import text as ops
from tallyforge.sources.lines import read_stopwords
from tallyforge.sources.reviews import parse_reviews

REVIEWS = [
    "id;review;aspect;category;sentiment",
    "1;Phòng sạch, rất sạch;CLEANLINESS;ROOMS;positive",
    "2;phòng bẩn;CLEANLINESS;ROOMS;negative",
    "\t3;giá ổn;PRICES;HOTEL; Positive ",
    "4;thiếu cột;PRICES;HOTEL",
    "5;thừa cột;GENERAL;HOTEL;positive;x",
    "6;không khía cạnh;;HOTEL;positive",
    "7;bình thường;GENERAL;HOTEL;neutral",
    "8;không loại;GENERAL; ;negative",
    "",
]


@pytest.fixture(scope="module")
def reviews(spark):
    return parse_reviews(lines(spark, *REVIEWS)).cache()


def test_parse(reviews):
    assert rows(reviews.select("id", "sentiment")) == [
        ("1", "positive"), ("2", "negative"), ("3", "positive"), ("5", "positive;x"),
        ("6", "positive"), ("7", "neutral"), ("8", "negative"),
    ]


def test_counts(reviews):
    assert rows(ops.count_by(reviews, "category")) == [("HOTEL", 4), ("ROOMS", 2)]
    assert rows(ops.count_by(reviews, "aspect")) == [
        ("CLEANLINESS", 2), ("GENERAL", 3), ("PRICES", 1),
    ]
    assert rows(ops.aspect_sentiment(reviews)) == [
        ("CLEANLINESS", "negative", 1), ("CLEANLINESS", "positive", 1),
        ("GENERAL", "negative", 1), ("PRICES", "positive", 1),
    ]


def test_extremes_take_the_smaller_name_on_a_tie(reviews):
    assert rows(ops.aspect_extremes(reviews)) == [
        ("negative", "CLEANLINESS", 1), ("positive", "CLEANLINESS", 1),
    ]
    assert rows(ops.aspect_extremes(reviews.limit(0))) == []


def test_clean_drops_texts_of_stopwords_only(spark):
    df = lines(spark, "là của", "Phòng là tốt tốt", " ", "CỦA phòng")
    cleaned = ops.clean_text(df, "value", ["là", "của"]).select("cleaned")
    assert rows(cleaned) == [("phòng tốt tốt",), ("phòng",)]


def test_word_threshold_is_strict(spark):
    df = lines(spark, "aa " * 500, "bb " * 501)
    assert rows(ops.word_frequency(df, "value")) == [("bb", 501)]


@pytest.mark.parametrize("as_table", [False, True])
def test_stopwords_from_list_or_table(spark, as_table):
    df = lines(spark, "aa bb aa cc", "cc aa b 1 22")
    stop = ["aa", "zz"]
    if as_table:
        stop = spark.createDataFrame([(w,) for w in stop + ["aa"]], "word string")
    assert rows(ops.word_frequency(df, "value", stop, 0)) == [("22", 1), ("bb", 1), ("cc", 2)]


def test_top_words_break_ties_by_word(spark):
    df = spark.createDataFrame(
        [("A", "ff ee dd cc bb aa"), ("B", "xx yy yy"), ("B", "yy xx zz")], "c string, t string"
    )
    top = ops.top_words(df, ["c"], "t")
    assert rows(top) == [
        ("A", "aa", 1, 1), ("A", "bb", 1, 2), ("A", "cc", 1, 3), ("A", "dd", 1, 4),
        ("A", "ee", 1, 5), ("B", "xx", 2, 2), ("B", "yy", 3, 1), ("B", "zz", 1, 3),
    ]
    assert rows(ops.top_words_line(top, ["c"])) == [
        ("A", "aa=1, bb=1, cc=1, dd=1, ee=1"), ("B", "yy=3, xx=2, zz=1"),
    ]


def test_top_words_against_counting(spark):
    texts = [(str(i % 3), " ".join(f"w{(i * j) % 17}x" for j in range(1, 30))) for i in range(60)]
    df = spark.createDataFrame(texts, "c string, t string")
    expected = []
    for c in "012":
        counts = {}
        for label, t in texts:
            for w in t.split() if label == c else ():
                counts[w] = counts.get(w, 0) + 1
        best = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:4]
        expected += [(c, w, n, rank) for rank, (w, n) in enumerate(best, 1)]
    top = ops.top_words(df, ["c"], "t", (), 4).orderBy("c", "rank")
    assert ordered(top) == expected


def test_read_stopwords(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text(" Là \n\ncủa\nlà\nchúng tôi\n", encoding="utf-8")
    assert rows(read_stopwords(spark, str(path))) == [("chúng tôi",), ("của",), ("là",)]


def test_clean_text_with_a_table_of_any_length(spark):
    stop = spark.range(200_000).select(F.concat(F.lit("w"), "id").alias("word"))
    df = spark.createDataFrame(
        [(1, "W1 keep  w2 w200000 keep\tw1"), (1, "W1 keep  w2 w200000 keep\tw1"), (2, "w5 w6"), (3, ""),
         (4, None), (None, "\x01a w7 \x01")],
        "row int, t string",
    )
    found = ops.clean_text(df, "t", stop.union(stop.limit(5)))
    assert found.columns == ["row", "t", "cleaned"]
    assert rows(found.select("row", "cleaned")) == [
        (1, "keep w200000 keep"), (1, "keep w200000 keep"), (None, "a"),
    ]


@pytest.mark.parametrize("words", [[], ["aa"], ["aa", "cc", "zz"]])
def test_clean_text_from_list_or_table(spark, words):
    df = lines(spark, "aa bb aa cc", "CC aa", " aa ", "bb  bb")
    as_table = spark.createDataFrame([(w,) for w in words], "word string")
    listed = rows(ops.clean_text(df, "value", words))
    assert rows(ops.clean_text(df, "value", as_table)) == listed and listed


def test_class_totals_sum_to_the_rows(reviews):
    total = ops.count_by(reviews, "category").agg(F.sum("n")).first()[0]
    assert total == reviews.filter(F.length("category") > 0).count()


def test_words_of_a_row_are_looked_up_in_a_set(spark):
    texts = spark.createDataFrame([("The a\tB  the",), ("the",), (None,), ("  b ",)], "t string")
    stop = spark.createDataFrame([("the",), ("x",)], "word string")
    cleaned = ops.clean_text(texts, "t", stop)
    assert rows(cleaned.select("cleaned")) == [("a b",), ("b",)]
    # A search through the array for each word takes the square of a text's length
    assert "array_contains" not in final_plan(cleaned)
