import re

import pytest
from helpers import final_plan, rows
from pyspark.sql import functions as F

from tallyforge.operators import ratings, sales


@pytest.fixture
def tiny_partitions(conf):
    """Let a few thousand rows look like a skewed table."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
    )


def hot(spark, n=20_000):
    """A third of the rows has key 7."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997)
    return spark.range(0, n, 1, 8).select(key.alias("k"), (F.col("id") % 50).alias("v"))


def test_product_sales_with_a_hot_order(spark, tiny_partitions):
    df = hot(spark)
    order = F.when(F.col("v") != 3, F.col("k"))
    items = df.select(order.alias("order_id"), F.col("v").alias("product_id"))
    reviews = df.filter("v < 5").select(F.col("k").alias("order_id"),
                                    (F.col("v") % 6).cast("string").alias("review_score"))
    valid = sales.valid_reviews(reviews)
    split = sales.product_sales(items, valid)
    assert "skew=true" in final_plan(split)
    plain = rows(split)
    pairs = items.join(valid, "order_id").groupBy("product_id").agg(F.count("*"), F.avg("score"))
    assert {r[0]: r[1:] for r in rows(pairs)} == {r[0]: (r[3], r[2]) for r in plain if r[3]}


def test_hot_user_is_split(spark, tiny_partitions):
    df = hot(spark)
    table = df.select(F.col("k").alias("user_id"), F.col("v").alias("item_id"),
                      F.col("v").cast("double").alias("rating"))
    users = spark.range(0, 997).select(F.col("id").alias("user_id"),
                                       (F.col("id") % 3).alias("gender"))
    averages = ratings.attribute_average(table, users, "gender")
    assert re.search(r"SortMergeJoin\(skew=true\)", final_plan(averages))
    assert averages.agg(F.sum("n_ratings")).first()[0] == 20_000


def test_hot_order_is_split(spark, tiny_partitions):
    df = hot(spark)
    orders = spark.range(0, 997).select(
        F.col("id").alias("order_id"), F.lit("2024-05-01 00:00:00").alias("handed_over_at"),
        F.expr("TIMESTAMP'2024-05-01'").alias("purchased_at"),
    )
    items = df.select(
        F.col("k").alias("order_id"), F.col("v").alias("product_id"),
        F.lit("2024-05-02 00:00:00").alias("ship_by"),
        F.lit(1.0).alias("price"), F.lit(1.0).alias("freight"),
    )
    lines = sales.delivery_difference(orders, items)
    assert "skew=true" in final_plan(lines)
    assert lines.count() == 20_000
    products = spark.range(50).select(F.col("id").alias("product_id"), F.lit("x").alias("category"))
    revenue = sales.revenue_by_category(orders, items, products)
    assert "skew=true" in final_plan(revenue)
    assert rows(revenue) == [("x", 40_000.0)]
