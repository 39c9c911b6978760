import pytest
from helpers import lines, ordered, rows
from pyspark.errors import PySparkException

from tallyforge import schemas
from tallyforge.operators import ratings as ops
from tallyforge.sinks import reports
from tallyforge.sources.ratings import parse_fields, parse_items

LONG = "A" * 38
RATINGS = [
    "1,a,5.0,1577836800", "2,a,4.0,1577836800", "3,a,3.0,1577836801", "1,a,5.0,1577836800",
    "2,a,4.5,1609459200", "1,b,2.0,1609459200", "2,b,1.0,1609459200", "9,b,5.0,1609459200",
    "1,b,4.0,1609459200", "3,c,4.0,1609459200", "1,unknown,1.0,1609459200", "no comma",
]
ITEMS = ["a,The Good, the Bad (1966),Western|War", "b,Title (2000)", f"c,{LONG},War| Drama |"]
USERS = ["1,M,17,1,x", "2,F,36,2,x", "3,X,51,1,x", "4,M,20,3,x"]
OCCUPATIONS = ["1,Cook", "2,Clerk", "3,Nobody"]


@pytest.fixture(scope="module")
def data(spark):
    return {
        "ratings": parse_fields(lines(spark, *RATINGS), schemas.RATINGS).cache(),
        "items": parse_items(lines(spark, *ITEMS)).cache(),
        "users": parse_fields(lines(spark, *USERS), schemas.USERS).cache(),
        "names": parse_fields(lines(spark, *OCCUPATIONS), schemas.OCCUPATIONS).cache(),
    }


def test_items(spark):
    found = parse_items(lines(spark, *ITEMS, "9,Title (2000),", "nothing"))
    assert rows(found) == [
        ("9", "Title (2000)", "Unknown"),
        ("a", "The Good, the Bad (1966)", "Western|War"),
        ("b", "Title (2000)", "Unknown"),
        ("c", LONG, "War| Drama |"),
    ]


def test_bad_number_fails_the_job(spark):
    bad = parse_fields(lines(spark, "1,a,abc,1"), schemas.RATINGS)
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        bad.collect()


def test_short_line_fails_only_where_the_field_is_used(spark):
    short = parse_fields(lines(spark, "1,a"), schemas.RATINGS)
    assert rows(short.select("user_id", "item_id")) == [("1", "a")]
    with pytest.raises(PySparkException, match="INVALID_ARRAY_INDEX"):
        short.select("rating").collect()


def test_item_average_counts_repeats_and_keeps_the_threshold(data):
    stats = ops.with_title(ops.item_average(data["ratings"]), data["items"])
    assert rows(stats) == [("a", 4.3, 5, "The Good, the Bad (1966)")]
    stats = ops.item_average(data["ratings"], 4)
    assert rows(stats) == [("a", 4.3, 5), ("b", 3.0, 4)]


def test_top_item_ties_go_by_title(spark):
    stats = spark.createDataFrame(
        [("1", 4.0, 5, "B"), ("2", 4.0, 5, "A"), ("3", 3.0, 9, "0")],
        "item_id string, avg_rating double, n_ratings long, title string",
    )
    assert [r[0] for r in ordered(ops.top_item(stats))] == ["2"]


def test_labels(data):
    averages = ops.label_average(data["ratings"], data["items"])
    assert ordered(ops.by_average(averages, "label")) == [
        ("Western", 4.3, 5), ("War", 25.5 / 6, 6), ("Drama", 4.0, 1), ("Unknown", 3.0, 4),
    ]


def test_attributes_drop_unknown_users(data):
    users = ops.with_band(data["users"], "age", "age_band")
    by_gender = ops.attribute_average(data["ratings"], users, "gender")
    assert ("b", "M", 3.0, 2) in rows(by_gender)
    assert ("a", "X", 3.0, 1) in rows(by_gender)
    by_age = ops.attribute_average(data["ratings"], users, "age_band")
    assert rows(by_age.filter("item_id = 'a'")) == [
        ("a", "36-50", 4.25, 2), ("a", "51+", 3.0, 1), ("a", "<18", 5.0, 2),
    ]
    assert sum(r[3] for r in rows(by_age)) == 10


def test_dimension_average_drops_unused_names(data):
    found = ops.dimension_average(
        data["ratings"], data["users"], data["names"], "occupation_id", "occupation"
    )
    assert ordered(ops.by_average(found, "occupation")) == [
        ("1", "Cook", 24.0 / 7, 7), ("2", "Clerk", 9.5 / 3, 3),
    ]


def test_years_keep_unknown_users_and_items(data):
    assert ordered(ops.by_year(ops.year_average(data["ratings"]))) == [
        (2020, 4.25, 4), (2021, 21.5 / 7, 7),
    ]
    years = ops.by_year(ops.year_average(data["ratings"], "America/New_York"))
    assert [r[0] for r in ordered(years)] == [2019, 2020]


def test_union_keeps_repeats(data):
    both = ops.all_ratings(data["ratings"], data["ratings"], data["ratings"])
    assert both.count() == 3 * data["ratings"].count()


def test_reports(spark, data):
    users = ops.with_band(data["users"], "age", "age_band")
    titled = ops.with_title(
        ops.attribute_average(data["ratings"], users, "gender"), data["items"]
    )
    assert rows(reports.gender_report(titled.filter("gender = 'X'"))) == [
        (f"{'a':<10} | {'The Good, the Bad (1966)':<40} | {'Nữ':<10} | 3.00",),
        (f"{'c':<10} | {'A' * 35 + '...':<40} | {'Nữ':<10} | 4.00",),
    ]
    titled = ops.with_title(
        ops.attribute_average(data["ratings"], users, "age_band"), data["items"]
    )
    assert rows(reports.age_report(titled.filter("item_id = 'c'"))) == [
        (f"{'c':<10} | {'A' * 30 + '...':<35} | {'51+':<12} | 4.00",),
    ]
    years = ops.by_year(ops.year_average(data["ratings"]))
    assert ordered(reports.year_report(years))[0] == (f"{'2020':<10} | {'4.25':<15} | 4",)
    stats = ops.with_title(ops.item_average(data["ratings"]), data["items"])
    assert rows(reports.item_report(stats)) == [
        ("MovieID: a | Title: The Good, the Bad (1966) | Average Rating: 4.3 | Total Ratings: 5",),
    ]
