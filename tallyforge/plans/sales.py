"""Sales queries over orders, order lines, customers and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.numeric import from_units, units
from tallyforge.operators import sales as ops
from tallyforge.operators.keyed import first_per_key
from tallyforge.operators.keyed import insert_if_absent as insert_absent
from tallyforge.plans.tables import money, table

YEAR = 1998
AMOUNT_DIGITS = 4
LINE_KEY = ["l_orderkey", "l_linenumber"]


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("purchased_at"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("total"),
    )


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    return (
        table(spark, folder, "customer")
        .join(nations, "c_nationkey")
        .select(F.col("c_custkey").alias("customer_id"), "country")
    )


def _items(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines; the tax on the price stands for the freight. Both are whole numbers
    of 1 / 10,000, since the tax rate has two digits as well."""
    cents = units(F.col("l_extendedprice"), 2)
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipped_at"),
        (cents * 100).alias("price"),
        (cents * units(F.col("l_tax"), 2)).alias("freight"),
    )


def _reviews(spark: SparkSession, folder: str) -> DataFrame:
    """The first character of an order's priority is its score."""
    return _orders(spark, folder).select(
        "order_id", "status", F.substring("priority", 1, 1).alias("review_score")
    )


def distinct_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Customers are those of the customer table, with or without an order."""
    return ops.distinct_totals(
        _orders(spark, folder), _customers(spark, folder), _items(spark, folder)
    )


def orders_by_country(spark: SparkSession, folder: str) -> DataFrame:
    return ops.orders_by_country(_orders(spark, folder), _customers(spark, folder))


def orders_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return ops.orders_by_month(_orders(spark, folder))


def score_avg(spark: SparkSession, folder: str) -> DataFrame:
    return ops.score_average(ops.valid_reviews(_reviews(spark, folder)))


def score_hist(spark: SparkSession, folder: str) -> DataFrame:
    return ops.score_histogram(ops.valid_reviews(_reviews(spark, folder)))


def revenue_by_category(spark: SparkSession, folder: str) -> DataFrame:
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category")
    )
    revenue = ops.revenue_by_category(
        _orders(spark, folder), _items(spark, folder), products, YEAR
    )
    return revenue.withColumn("total_revenue", from_units(F.col("total_revenue"), AMOUNT_DIGITS))


def product_sales_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Only finished orders count as reviewed."""
    reviews = _reviews(spark, folder).filter(F.col("status") == "F")
    sales = ops.product_sales(_items(spark, folder), ops.valid_reviews(reviews))
    return sales.withColumn("total_reviews", F.col("total_reviews").cast("double"))


def delivery_diff(spark: SparkSession, folder: str) -> DataFrame:
    """The order's date stands for the hand-over, the line's for the date to ship."""
    orders = _orders(spark, folder).withColumnRenamed("purchased_at", "handed_over_at")
    items = _items(spark, folder).withColumnRenamed("shipped_at", "ship_by")
    lines = ops.delivery_difference(orders, items)
    dates = ("actual_date", "expected_date")
    return lines.withColumns({name: F.col(name).cast("string") for name in dates})


def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Open lines that no finished line has the key of, one per key."""
    lines = table(spark, folder, "lineitem")
    others = sorted(set(lines.columns) - set(LINE_KEY))
    incoming = first_per_key(
        lines.filter(F.col("l_linestatus") == "O"), LINE_KEY, [F.col(c) for c in others]
    )
    return insert_absent(incoming, lines.filter(F.col("l_linestatus") == "F"), LINE_KEY)


def first_wins(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    others = sorted(set(lines.columns) - set(LINE_KEY))
    return first_per_key(lines, LINE_KEY, [F.col(c) for c in others])


def customer_segments(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).withColumn("order_value", money("total"))
    return ops.customer_segments(orders, (8, 12), (200_000, 300_000), (0.1, 0.2))


def seller_rank(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ops.seller_rank(_items(spark, folder))
    return ranked.withColumn("revenue", from_units(F.col("revenue"), AMOUNT_DIGITS))


QUERIES = {
    "distinct_totals": distinct_totals,
    "orders_by_country": orders_by_country,
    "orders_by_month": orders_by_month,
    "score_avg": score_avg,
    "score_hist": score_hist,
    "revenue_by_category": revenue_by_category,
    "product_sales_reviews": product_sales_reviews,
    "delivery_diff": delivery_diff,
    "first_wins": first_wins,
    "insert_if_absent": insert_if_absent,
    "customer_segments": customer_segments,
    "seller_rank": seller_rank,
}

_SCORE = "CAST(trunc(TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)) AS INTEGER)"
_VALID = f"""
  SELECT o_orderkey, o_orderstatus, {_SCORE} AS score FROM orders
  WHERE {_SCORE} BETWEEN 1 AND 5"""
_PRICE = "CAST(l_extendedprice AS DECIMAL(15,2))"
_REVENUE = f"sum({_PRICE} + {_PRICE} * CAST(l_tax AS DECIMAL(4,2)))"
_LINE_ORDER = """l_discount, l_extendedprice, l_linestatus, l_partkey, l_quantity, l_returnflag,
  l_shipdate, l_suppkey, l_tax"""


def _first_lines(condition: str) -> str:
    return f"""
      SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (
          PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS place
        FROM lineitem WHERE {condition})
      WHERE place = 1"""


SQL = {
    "distinct_totals": """
      SELECT 'orders' AS metric, count(*) AS total FROM (SELECT DISTINCT o_orderkey FROM orders)
      UNION ALL SELECT 'customers', count(*) FROM (SELECT DISTINCT c_custkey FROM customer)
      UNION ALL SELECT 'sellers', count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem)""",
    "orders_by_country": """
      SELECT n_name AS country, count(*) AS total_orders
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      GROUP BY n_name ORDER BY total_orders DESC, country""",
    "orders_by_month": """
      SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
             CAST(month(o_orderdate) AS INTEGER) AS order_month, count(*) AS total_orders
      FROM orders GROUP BY 1, 2 ORDER BY 1, 2 DESC""",
    "score_avg": f"SELECT avg(score) AS avg_score FROM ({_VALID})",
    "score_hist": f"""
      SELECT score, count(*) AS count_reviews FROM ({_VALID}) GROUP BY score ORDER BY score DESC""",
    "revenue_by_category": f"""
      SELECT p_type AS category, CAST({_REVENUE} AS DOUBLE) AS total_revenue
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
      WHERE year(o_orderdate) = {YEAR} GROUP BY p_type ORDER BY 2 DESC, 1""",
    "product_sales_reviews": f"""
      SELECT s.product_id, total_sold, avg_review_score,
             CAST(total_reviews AS DOUBLE) AS total_reviews
      FROM (SELECT l_partkey AS product_id, count(*) AS total_sold
            FROM lineitem GROUP BY l_partkey) s
      LEFT JOIN (SELECT l_partkey AS product_id, avg(score) AS avg_review_score,
                        count(*) AS total_reviews
                 FROM lineitem JOIN ({_VALID}) ON l_orderkey = o_orderkey
                 WHERE o_orderstatus = 'F' GROUP BY l_partkey) r
        ON s.product_id = r.product_id
      ORDER BY total_sold DESC, s.product_id""",
    "delivery_diff": """
      SELECT l_orderkey AS order_id, l_partkey AS product_id,
             CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS actual_date,
             CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS expected_date,
             CAST(date_diff('day', CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS INTEGER)
               AS diff_days
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE o_orderdate IS NOT NULL AND l_shipdate IS NOT NULL""",
    "first_wins": _first_lines("true"),
    "insert_if_absent": f"""
      SELECT * FROM ({_first_lines("l_linestatus = 'O'")}) o WHERE NOT EXISTS (
        SELECT 1 FROM lineitem f WHERE f.l_linestatus = 'F'
          AND f.l_orderkey = o.l_orderkey AND f.l_linenumber = o.l_linenumber)""",
    "customer_segments": """
      SELECT *, CASE WHEN n_orders >= 12 THEN 'high' WHEN n_orders >= 8 THEN 'mid' ELSE 'low' END
        || '-' || CASE WHEN avg_order_value >= 300000 THEN 'high'
                       WHEN avg_order_value >= 200000 THEN 'mid' ELSE 'low' END
        || '-' || CASE WHEN orders_per_30_days >= 0.2 THEN 'high'
                       WHEN orders_per_30_days >= 0.1 THEN 'mid' ELSE 'low' END AS segment
      FROM (SELECT o_custkey AS customer_id, count(DISTINCT o_orderkey) AS n_orders,
              CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE)
                / count(DISTINCT o_orderkey) AS avg_order_value,
              count(DISTINCT o_orderkey) * 30.0::DOUBLE / greatest(date_diff('day',
                min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))), 30)
                AS orders_per_30_days
            FROM orders GROUP BY o_custkey)""",
    "seller_rank": f"""
      SELECT seller_id, CAST(revenue AS DOUBLE) AS revenue, n_orders,
             rank() OVER (ORDER BY revenue DESC) AS revenue_rank,
             rank() OVER (ORDER BY n_orders DESC) AS orders_rank
      FROM (SELECT l_suppkey AS seller_id, {_REVENUE} AS revenue,
                   count(DISTINCT l_orderkey) AS n_orders
            FROM lineitem GROUP BY l_suppkey)""",
}
