import datetime as dt
import unicodedata

import pytest
from helpers import ordered, rows
from pyspark.sql import functions as F

from tallyforge.functions import labels, numeric, text, timing
from tallyforge.functions.stopwords import VIETNAMESE


def one(spark, value, kind, build):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(build(F.col("v"))).first()[0]


def test_trim_strips_all_controls(spark):
    assert one(spark, "\t a \x00b\x1f \n", "string", text.trim_controls) == "a \x00b"


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Phòng, sạch! 5* là", ["phòng", "sạch"]),
        ("a bb\tcc\n", ["bb", "cc"]),
        ("", []),
        ("!?", []),
        ("x \U00020000 y", ["\U00020000"]),
        (unicodedata.normalize("NFD", "phòng"), ["pho", "ng"]),
    ],
)
def test_words(spark, value, expected):
    found = spark.createDataFrame([(value,)], "v string").select(
        F.explode(text.words(F.col("v"))).alias("w")
    )
    kept = found.filter(text.is_countable(F.col("w"))).filter(~F.col("w").isin("là"))
    assert [w for (w,) in ordered(kept)] == expected


def test_without_stopwords_keeps_order_and_repeats(spark):
    cleaned = one(
        spark, " Rất TỐT  tốt, là\tTốt ", "string",
        lambda c: text.without_stopwords(c, VIETNAMESE),
    )
    assert cleaned == "tốt tốt, tốt"


def test_stopword_list():
    assert len(VIETNAMESE) == len(set(VIETNAMESE)) == 120
    assert sum(" " in word for word in VIETNAMESE) == 11


@pytest.mark.parametrize("length, limit, keep, out", [(37, 37, 35, 37), (38, 37, 35, 38),
                                                      (32, 32, 30, 32), (33, 32, 30, 33)])
def test_shorten(spark, length, limit, keep, out):
    short = one(spark, "x" * length, "string", lambda c: text.shorten(c, limit, keep))
    assert len(short) == out
    assert short.endswith("...") == (length > limit)


@pytest.mark.parametrize(
    "value, expected",
    [("A||B ", ["A", "", "B"]), ("A|B||", ["A", "B"]), ("", [""]), ("||", []), ("One", ["One"])],
)
def test_split_labels(spark, value, expected):
    assert one(spark, value, "string", text.split_labels) == expected


@pytest.mark.parametrize(
    "age, name",
    [(17, "<18"), (18, "18-35"), (35, "18-35"), (36, "36-50"), (50, "36-50"), (51, "51+")],
)
def test_band(spark, age, name):
    assert one(spark, age, "int", labels.band) == name


def test_gender(spark):
    assert [one(spark, g, "string", labels.gender_name) for g in ("M", "F", "X", None)] == [
        "Nam", "Nữ", "Nữ", "Nữ",
    ]


@pytest.mark.parametrize(
    "value, expected",
    [("5", 5), ("4.5", 4), ("abc", None), (None, None), ("", None), ("1e30", None)],
)
def test_lenient_int(spark, value, expected):
    assert one(spark, value, "string", numeric.lenient_int) == expected


@pytest.mark.parametrize("zone, year", [("UTC", 2020), ("America/New_York", 2019),
                                        ("Asia/Ho_Chi_Minh", 2020)])
@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_epoch_year_ignores_the_session_zone(spark, conf, zone, year, session_zone):
    conf(spark__sql__session__timeZone=session_zone)
    assert one(spark, 1577836800, "long", lambda c: timing.epoch_year(c, zone)) == year


def test_bucket(spark):
    at = dt.datetime(2024, 5, 6, 7, 8, 9)
    starts = [
        one(spark, at, "timestamp", lambda c, i=i: timing.bucket(i, c)) for i in timing.INTERVALS
    ]
    assert starts == [at.replace(second=0), at.replace(minute=0, second=0),
                      at.replace(hour=0, minute=0, second=0)]


@pytest.mark.parametrize("interval", ["1 minute", "week", "", "foo"])
def test_bucket_refuses_other_units(interval):
    with pytest.raises(ValueError):
        timing.bucket(interval, None)


def test_average_of_decimals_is_exact(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(15,2)) AS v FROM VALUES (0.1), (0.2), (0.3) AS t(v)")
    assert rows(df.select(numeric.average(df, "v"))) == [(0.6 / 3,)]
    assert rows(df.limit(0).select(numeric.average(df, "v"))) == [(None,)]
