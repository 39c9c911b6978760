"""Orders, reviews, revenue, delivery, customers and sellers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.labels import level
from tallyforge.functions.numeric import average, lenient_int, ratio, total
from tallyforge.operators.keyed import rank_by
from tallyforge.operators.skew import for_skewed_join

# Valid scores, and the year of the revenue report
MIN_SCORE, MAX_SCORE = 1, 5
REVENUE_YEAR = 2024


def distinct_total(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row (metric, total) with the number of distinct values; NULL is a value."""
    value = F.col(column)
    null_seen = F.max(F.when(value.isNull(), 1).otherwise(0))
    total = F.count_distinct(value) + F.coalesce(null_seen, F.lit(0))
    return df.agg(total.alias("total")).select(F.lit(name).alias("metric"), "total")


def distinct_totals(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    return (
        distinct_total(orders, "order_id", "orders")
        .unionAll(distinct_total(customers, "customer_id", "customers"))
        .unionAll(distinct_total(items, "seller_id", "sellers"))
    )


def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders per country, most first. Orders shrink to a count per customer before
    the join, which a customer with very many orders cannot skew."""
    per_customer = orders.groupBy("customer_id").agg(F.count("order_id").alias("_n"))
    return (
        per_customer.join(customers.select("customer_id", "country"), "customer_id")
        .groupBy("country")
        .agg(F.sum("_n").alias("total_orders"))
        .orderBy(F.desc("total_orders"), "country")
    )


def orders_by_month(orders: DataFrame) -> DataFrame:
    """Orders per year (ascending) and month (descending)."""
    at = F.col("purchased_at")
    return (
        orders.groupBy(F.year(at).alias("order_year"), F.month(at).alias("order_month"))
        .agg(F.count("order_id").alias("total_orders"))
        .orderBy(F.asc("order_year"), F.desc("order_month"))
    )


def valid_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with an integer `score` of 1 to 5."""
    scored = reviews.withColumn("score", lenient_int(F.col("review_score").cast("string")))
    return scored.filter(F.col("score").between(MIN_SCORE, MAX_SCORE))


def score_average(valid: DataFrame) -> DataFrame:
    return valid.agg(F.avg("score").alias("avg_score"))


def score_histogram(valid: DataFrame) -> DataFrame:
    """Reviews per score, best first."""
    counts = valid.groupBy("score").agg(F.count("*").alias("count_reviews"))
    return counts.orderBy(F.desc("score"))


def purchased_in(orders: DataFrame, year: int) -> DataFrame:
    """Orders of a calendar year, as a range that reaches the file scan."""
    at = F.col("purchased_at")
    kind = orders.schema["purchased_at"].dataType
    start, end = (F.lit(dt.date(y, 1, 1)).cast(kind) for y in (year, year + 1))
    return orders.filter((at >= start) & (at < end))


def with_revenue(items: DataFrame, *keys: str) -> DataFrame:
    """The keys and `revenue`, price plus freight; NULL if either is."""
    return items.select(*keys, (F.col("price") + F.col("freight")).alias("revenue"))


def revenue_by_category(
    orders: DataFrame, items: DataFrame, products: DataFrame, year: int = REVENUE_YEAR
) -> DataFrame:
    """Price plus freight per product category for one year's orders, most first.
    Lines shrink to one row per product before the categories are joined."""
    lines = with_revenue(items, "order_id", "product_id")
    per_product = (
        lines.join(purchased_in(orders, year).select("order_id"), "order_id")
        .groupBy("product_id")
        .agg(total(lines, "revenue").alias("revenue"))
    )
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def product_sales(items: DataFrame, valid: DataFrame) -> DataFrame:
    """Items sold per product with the average score and number of (item, review)
    pairs; products without a valid review have NULL there. Best sold first.

    Reviews shrink to one row per order first. Each item then carries its order's
    score total and count, so the pairs are counted but never built. The reviews are
    written out for the join, so that Spark splits an order with very many items.
    """
    per_order = valid.groupBy("order_id").agg(
        F.sum("score").alias("_scores"), F.count("*").alias("_reviews")
    )
    sold = items.select("order_id", "product_id")
    pairs = F.sum(F.when(F.col("product_id").isNotNull(), F.col("_reviews")))
    scores = F.sum(F.when(F.col("product_id").isNotNull(), F.col("_scores")))
    return (
        sold.join(for_skewed_join(per_order), "order_id", "left")
        .groupBy("product_id")
        .agg(
            F.count("*").alias("total_sold"),
            ratio(scores, pairs).alias("avg_review_score"),
            pairs.alias("total_reviews"),
        )
        .orderBy(F.desc("total_sold"), "product_id")
    )


def delivery_difference(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Days from the latest date to ship to the hand-over, per order line: negative
    is early. Lines without either date, or with a text that is no date, are dropped."""
    actual = F.col("handed_over_at").try_cast("date").alias("actual_date")
    expected = F.col("ship_by").try_cast("date").alias("expected_date")
    handed_over = orders.select("order_id", actual).filter(F.col("actual_date").isNotNull())
    due = items.select("order_id", "product_id", expected)
    return (
        handed_over.join(due.filter(F.col("expected_date").isNotNull()), "order_id")
        .select(
            "order_id", "product_id", "actual_date", "expected_date",
            F.datediff("actual_date", "expected_date").alias("diff_days"),
        )
    )


def order_values(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their value, the sum of price and freight of their lines."""
    lines = with_revenue(items, "order_id")
    values = lines.groupBy("order_id").agg(total(lines, "revenue").alias("order_value"))
    return orders.select("customer_id", "order_id", "purchased_at").join(values, "order_id")


def customer_segments(
    valued_orders: DataFrame,
    order_levels: tuple[float, float] = (2, 5),
    value_levels: tuple[float, float] = (100, 500),
    frequency_levels: tuple[float, float] = (0.5, 1),
) -> DataFrame:
    """Customers by number of orders, mean order value and orders per 30 days of
    their active time (30 days at least). Each figure is low, mid or high by the two
    lower bounds given; the segment joins the three."""
    orders = valued_orders.groupBy("customer_id", "order_id").agg(
        F.sum("order_value").alias("order_value"), F.min("purchased_at").alias("purchased_at")
    )
    active_days = F.greatest(F.datediff(F.max("purchased_at"), F.min("purchased_at")), F.lit(30))
    figures = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("n_orders"),
        average(orders, "order_value").alias("avg_order_value"),
        (F.count("order_id") * F.lit(30.0) / active_days).alias("orders_per_30_days"),
    )
    return figures.select(
        "*",
        F.concat_ws(
            "-",
            level(F.col("n_orders"), *order_levels),
            level(F.col("avg_order_value"), *value_levels),
            level(F.col("orders_per_30_days"), *frequency_levels),
        ).alias("segment"),
    )


def seller_rank(items: DataFrame) -> DataFrame:
    """Sellers with revenue and distinct orders, ranked by each, highest first."""
    lines = with_revenue(items, "seller_id", "order_id")
    per_order = lines.groupBy("seller_id", "order_id").agg(
        total(lines, "revenue").alias("revenue")
    )
    sellers = per_order.groupBy("seller_id").agg(
        F.sum("revenue").alias("revenue"), F.count("order_id").alias("n_orders")
    )
    return rank_by(sellers, {"revenue_rank": "revenue", "orders_rank": "n_orders"})
