"""Average ratings by item, label, user attribute and year.

Ratings are aggregated before a name or label table is joined, so that only
aggregates meet the label tables. Join sides carry no broadcast hint: Spark
broadcasts them when it knows them to be small and splits skewed sides otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.labels import band
from tallyforge.functions.numeric import average, ratio
from tallyforge.functions.text import split_labels
from tallyforge.functions.timing import epoch_year

# Fixed value: items need this many ratings
MIN_RATINGS = 5


def all_ratings(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union of rating tables; repeated ratings are kept."""
    for other in others:
        first = first.unionByName(other)
    return first


def _totals() -> tuple[Column, Column]:
    return F.sum("rating").alias("_total"), F.count("rating").alias("_n")


def _average_of_totals() -> tuple[Column, Column]:
    n = F.sum("_n")
    return ratio(F.sum("_total"), n).alias("avg_rating"), n.alias("n_ratings")


def item_average(ratings: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    """Average and count per item with at least `min_ratings` ratings."""
    stats = ratings.groupBy("item_id").agg(
        average(ratings, "rating").alias("avg_rating"), F.count("rating").alias("n_ratings")
    )
    return stats.filter(F.col("n_ratings") >= min_ratings)


def with_title(stats: DataFrame, items: DataFrame) -> DataFrame:
    """Add the item's title; unknown items are dropped."""
    return stats.join(items.select("item_id", "title"), "item_id")


def top_item(titled: DataFrame) -> DataFrame:
    """The item with the highest average, on a tie the smaller title."""
    return titled.orderBy(F.desc("avg_rating"), "title", "item_id").limit(1)


def label_average(ratings: DataFrame, items: DataFrame, separator: str = "|") -> DataFrame:
    """Average per label of the rated items; an item counts for each of its labels."""
    per_item = ratings.groupBy("item_id").agg(*_totals())
    labelled = per_item.join(items.select("item_id", "labels"), "item_id").select(
        F.explode(split_labels(F.col("labels"), separator)).alias("label"), "_total", "_n"
    )
    return labelled.groupBy("label").agg(*_average_of_totals())


def attribute_average(ratings: DataFrame, users: DataFrame, attribute: str) -> DataFrame:
    """Average per item and user attribute; ratings of unknown users are dropped."""
    known = ratings.select("user_id", "item_id", "rating").join(
        users.select("user_id", attribute), "user_id"
    )
    return known.groupBy("item_id", attribute).agg(
        average(known, "rating").alias("avg_rating"), F.count("rating").alias("n_ratings")
    )


def with_band(users: DataFrame, value: str, out: str, *edges: int) -> DataFrame:
    """Add the band of a user's number; without edges those of the ages."""
    column = F.col(value)
    return users.withColumn(out, band(column, edges) if edges else band(column))


def dimension_average(
    ratings: DataFrame, users: DataFrame, names: DataFrame, key: str, name: str
) -> DataFrame:
    """Average per user dimension, with the dimension's name. Ratings shrink to one
    row per user, then to one per dimension, before each join."""
    per_user = ratings.groupBy("user_id").agg(*_totals())
    per_key = (
        per_user.join(users.select("user_id", key), "user_id")
        .groupBy(key)
        .agg(F.sum("_total").alias("_total"), F.sum("_n").alias("_n"))
    )
    return per_key.join(names.select(key, name), key).select(
        key, name, ratio(F.col("_total"), F.col("_n")).alias("avg_rating"),
        F.col("_n").alias("n_ratings"),
    )


def year_average(ratings: DataFrame, zone: str = "UTC") -> DataFrame:
    """Average and count per calendar year in `zone`."""
    dated = ratings.select(epoch_year(F.col("epoch"), zone).alias("year"), "rating")
    return dated.groupBy("year").agg(
        average(dated, "rating").alias("avg_rating"), F.count("rating").alias("n_ratings")
    )


def by_average(averages: DataFrame, name: str) -> DataFrame:
    """Highest average first, equal ones by name."""
    return averages.orderBy(F.desc("avg_rating"), name)


def by_year(averages: DataFrame) -> DataFrame:
    return averages.orderBy("year")
