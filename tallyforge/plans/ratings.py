"""Rating queries: order lines rate parts with their quantity, orders rate nations
with their price."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import ratings as ops
from tallyforge.operators.keyed import numbered
from tallyforge.plans.tables import money, table
from tallyforge.sinks import reports

MIN_LINES = 30
BALANCE_EDGES = (0, 2500, 5000)


def _line_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """An order line is a rating of its part by its order."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("rating"),
    )


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.col("p_name").alias("labels"),
    )


def _orders_with_customer(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Orders as the users of line ratings, with columns of their customer. The two
    are joined first, so the order lines are shuffled for one join only."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), *columns
    )
    return (
        table(spark, folder, "orders")
        .select(F.col("o_orderkey").alias("user_id"), "o_custkey")
        .join(customers, "o_custkey")
    )


def _item_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = ops.item_average(_line_ratings(spark, folder), MIN_LINES)
    return ops.with_title(stats, _parts(spark, folder))


def item_avg(spark: SparkSession, folder: str) -> DataFrame:
    return _item_stats(spark, folder)


def top_item(spark: SparkSession, folder: str) -> DataFrame:
    return ops.top_item(_item_stats(spark, folder))


def item_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.item_report(_item_stats(spark, folder))


def multi_label_avg(spark: SparkSession, folder: str) -> DataFrame:
    averages = ops.label_average(
        _line_ratings(spark, folder), _parts(spark, folder), separator=" "
    )
    return ops.by_average(averages, "label")


def label_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.label_report(multi_label_avg(spark, folder))


def item_by_attr(spark: SparkSession, folder: str) -> DataFrame:
    users = _orders_with_customer(
        spark, folder, F.col("c_mktsegment").alias("segment")
    )
    averages = ops.attribute_average(_line_ratings(spark, folder), users, "segment")
    return ops.with_title(averages, _parts(spark, folder))


def item_by_band(spark: SparkSession, folder: str) -> DataFrame:
    users = ops.with_band(
        _orders_with_customer(spark, folder, "c_acctbal"),
        "c_acctbal", "balance_band", *BALANCE_EDGES,
    )
    averages = ops.attribute_average(_line_ratings(spark, folder), users, "balance_band")
    return ops.with_title(averages, _parts(spark, folder))


def _order_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("rating"),
        # The dates have no zone; they count as UTC
        F.timestamp_diff(
            "SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), "o_orderdate"
        ).alias("epoch"),
    )


def avg_by_dim(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nation_id")
    )
    names = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("nation")
    )
    averages = ops.dimension_average(
        _order_ratings(spark, folder), users, names, "nation_id", "nation"
    )
    return ops.by_average(averages, "nation")


def by_year(spark: SparkSession, folder: str) -> DataFrame:
    return ops.by_year(ops.year_average(_order_ratings(spark, folder)))


def union_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Balances of customers and of suppliers, put together per nation."""
    sources = [
        table(spark, folder, name).select(
            F.col(f"{letter}_nationkey").alias("item_id"),
            money(f"{letter}_acctbal").alias("rating"),
        )
        for name, letter in (("customer", "c"), ("supplier", "s"))
    ]
    return ops.item_average(ops.all_ratings(*sources))


def _people(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as people: the first letter of the customer's segment is the gender, the
    whole thousands of the balance, ten years each, give the age."""
    return _orders_with_customer(
        spark, folder,
        F.substring("c_mktsegment", 1, 1).alias("gender"),
        (F.floor(F.col("c_acctbal") / 1000) * 10).cast("int").alias("age"),
    )


def _long_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with a title that is often too long for a report."""
    title = F.concat_ws(" ", "p_name", "p_type", "p_brand", "p_name", "p_size")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"), title.alias("title")
    )


def gender_report(spark: SparkSession, folder: str) -> DataFrame:
    averages = ops.attribute_average(
        _line_ratings(spark, folder), _people(spark, folder), "gender"
    )
    titled = ops.with_title(averages, _long_titles(spark, folder))
    return reports.gender_report(titled)


def age_report(spark: SparkSession, folder: str) -> DataFrame:
    users = ops.with_band(_people(spark, folder), "age", "age_band")
    averages = ops.attribute_average(_line_ratings(spark, folder), users, "age_band")
    titled = ops.with_title(averages, _long_titles(spark, folder))
    return reports.age_report(titled)


def occupation_report(spark: SparkSession, folder: str) -> DataFrame:
    """Nations stand for occupations."""
    return reports.occupation_report(
        avg_by_dim(spark, folder).withColumnRenamed("nation", "occupation")
    )


def year_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.year_report(by_year(spark, folder))


def _numbered_lines(layout: reports.Layout, stats: DataFrame) -> DataFrame:
    """All lines of a report with their numbers from the top."""
    return numbered(layout.lines(stats), layout.by()).select("n", "value")


def item_report_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered_lines(reports.LAYOUTS["items"], _item_stats(spark, folder))


def label_report_lines(spark: SparkSession, folder: str) -> DataFrame:
    averages = ops.label_average(
        _line_ratings(spark, folder), _parts(spark, folder), separator=" "
    )
    return _numbered_lines(reports.LAYOUTS["labels"], averages)


def year_report_lines(spark: SparkSession, folder: str) -> DataFrame:
    averages = ops.year_average(_order_ratings(spark, folder))
    return _numbered_lines(reports.LAYOUTS["years"], averages)


QUERIES = {
    "item_report_lines": item_report_lines,
    "label_report_lines": label_report_lines,
    "year_report_lines": year_report_lines,
    "gender_report": gender_report,
    "age_report": age_report,
    "occupation_report": occupation_report,
    "year_report": year_report,
    "item_avg": item_avg,
    "top_item": top_item,
    "item_report": item_report,
    "multi_label_avg": multi_label_avg,
    "label_report": label_report,
    "item_by_attr": item_by_attr,
    "item_by_band": item_by_band,
    "avg_by_dim": avg_by_dim,
    "by_year": by_year,
    "union_ratings": union_ratings,
}

_ITEMS = """
  SELECT l_partkey AS item_id, avg(l_quantity) AS avg_rating, count(*) AS n_ratings, p_name AS title
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_partkey, p_name HAVING count(*) >= 30"""

_LABELS = """
  SELECT label, avg(l_quantity) AS avg_rating, count(*) AS n_ratings
  FROM lineitem JOIN (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS label FROM part)
    ON l_partkey = p_partkey
  GROUP BY label"""

_PRICE = "CAST(o_totalprice AS DECIMAL(15,2))"


def _by_attribute(expression: str, name: str) -> str:
    return f"""
      SELECT l_partkey AS item_id, {expression} AS {name}, avg(l_quantity) AS avg_rating,
             count(*) AS n_ratings, p_name AS title
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
      GROUP BY l_partkey, {expression}, p_name"""


def _pad(text: str, width: int) -> str:
    return f"rpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), ' ')"


def _two_digits(number: str) -> str:
    return f"printf('%.2f', round({number}::DECIMAL(38,10), 2))"


_AGE = "CAST(floor(c_acctbal / 1000) * 10 AS INTEGER)"
_AGE_BAND = f"""CASE WHEN {_AGE} < 18 THEN '<18' WHEN {_AGE} < 36 THEN '18-35'
  WHEN {_AGE} < 51 THEN '36-50' ELSE '51+' END"""
_TITLE = "p_name || ' ' || p_type || ' ' || p_brand || ' ' || p_name || ' ' || p_size"


def _person_report(key: str, attribute: str, limit: int, widths: tuple[int, int]) -> str:
    """Grouped by `key`, which `attribute` names. Longer titles than `limit` are cut to
    two characters less."""
    short = f"substr(title, 1, {limit - 2}) || '...'"
    title = f"CASE WHEN length(title) > {limit} THEN {short} ELSE title END"
    return f"""
      SELECT {_pad("item_id", 10)} || ' | ' || {_pad("title", widths[0])} || ' | '
        || {_pad("attribute", widths[1])} || ' | ' || {_two_digits("avg_rating")} AS value
      FROM (SELECT item_id, {title} AS title, attribute, avg_rating FROM (
        SELECT CAST(l_partkey AS VARCHAR) AS item_id, {_TITLE} AS title, {attribute} AS attribute,
               avg(l_quantity) AS avg_rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
        GROUP BY l_partkey, p_name, p_type, p_brand, p_size, {key}))"""


_ITEM_LINE = """'MovieID: ' || item_id || ' | Title: ' || title || ' | Average Rating: '
  || avg_rating || ' | Total Ratings: ' || n_ratings"""
_LABEL_LINE = f"{_pad('label', 20)} || ' | ' || {_two_digits('avg_rating')}"
_YEAR_LINE = f"{_pad('y', 10)} || ' | ' || {_pad(_two_digits('avg_rating'), 15)} || ' | ' || n"
_YEARS = f"""
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS y, count(*) AS n,
         CAST(sum({_PRICE}) AS DOUBLE) / count(*) AS avg_rating
  FROM orders GROUP BY 1"""


def _lines(head: tuple[str, ...], body: str, top: str = "") -> str:
    """Numbered lines: the head, the rows of `body` (place, value), closing lines (place, value)."""
    fixed = " UNION ALL ".join(f"SELECT 0 AS section, {i} AS place, '{x}' AS value" for i, x in enumerate(head))
    return f"""
      SELECT row_number() OVER (ORDER BY section, place) AS n, value FROM (
        {fixed} UNION ALL SELECT 1, place, value FROM ({body})
        {top and f"UNION ALL SELECT 2, place, value FROM ({top})"})"""


SQL = {
    "item_report_lines": _lines(
        reports.ITEM_HEAD,
        f"SELECT row_number() OVER (ORDER BY item_id) AS place, {_ITEM_LINE} AS value FROM ({_ITEMS})",
        f"""SELECT unnest([1, 2, 3, 4]) AS place, unnest(['', '========== TOP MOVIE ==========',
              'Phim có điểm cao nhất : ' || title, 'Điểm trung bình       : ' || avg_rating]) AS value
            FROM ({_ITEMS} ORDER BY avg_rating DESC, title, item_id LIMIT 1)""",
    ),
    "label_report_lines": _lines(
        reports.GENRE_HEAD,
        f"""SELECT row_number() OVER (ORDER BY avg_rating DESC, label) AS place, {_LABEL_LINE} AS value
            FROM ({_LABELS})""",
    ),
    "year_report_lines": _lines(
        reports.YEAR_HEAD,
        f"SELECT row_number() OVER (ORDER BY y) AS place, {_YEAR_LINE} AS value FROM ({_YEARS})",
    ),
    "gender_report": _person_report(
        "substr(c_mktsegment, 1, 1)",
        "CASE WHEN substr(c_mktsegment, 1, 1) = 'M' THEN 'Nam' ELSE 'Nữ' END", 37, (40, 10)
    ),
    "age_report": _person_report(_AGE_BAND, _AGE_BAND, 32, (35, 12)),
    "occupation_report": f"""
      SELECT {_pad("n_name", 25)} || ' | ' || {_pad(_two_digits("avg_rating"), 15)}
        || ' | ' || n AS value
      FROM (SELECT n_name, CAST(sum({_PRICE}) AS DOUBLE) / count(*) AS avg_rating, count(*) AS n
            FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)""",
    "year_report": f"SELECT {_YEAR_LINE} AS value FROM ({_YEARS})",
    "item_avg": _ITEMS,
    "top_item": f"{_ITEMS} ORDER BY avg_rating DESC, title, item_id LIMIT 1",
    "item_report": f"SELECT {_ITEM_LINE} AS value FROM ({_ITEMS})",
    "multi_label_avg": f"{_LABELS} ORDER BY avg_rating DESC, label",
    "label_report": f"SELECT {_LABEL_LINE} AS value FROM ({_LABELS})",
    "item_by_attr": _by_attribute("c_mktsegment", "segment"),
    "item_by_band": _by_attribute(
        """CASE WHEN c_acctbal < 0 THEN '<0' WHEN c_acctbal < 2500 THEN '0-2499'
           WHEN c_acctbal < 5000 THEN '2500-4999' ELSE '5000+' END""",
        "balance_band",
    ),
    "avg_by_dim": f"""
      SELECT n_nationkey AS nation_id, n_name AS nation,
             CAST(sum({_PRICE}) AS DOUBLE) / count(*) AS avg_rating, count(*) AS n_ratings
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      GROUP BY n_nationkey, n_name ORDER BY avg_rating DESC, nation""",
    "by_year": f"""
      SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
             CAST(sum({_PRICE}) AS DOUBLE) / count(*) AS avg_rating, count(*) AS n_ratings
      FROM orders GROUP BY year(o_orderdate) ORDER BY 1""",
    "union_ratings": """
      SELECT item_id, CAST(sum(rating) AS DOUBLE) / count(*) AS avg_rating, count(*) AS n_ratings
      FROM (SELECT c_nationkey AS item_id, CAST(c_acctbal AS DECIMAL(15,2)) AS rating FROM customer
            UNION ALL SELECT s_nationkey, CAST(s_acctbal AS DECIMAL(15,2)) FROM supplier)
      GROUP BY item_id HAVING count(*) >= 5""",
}
