"""The file sources and sinks: the supplied tables are written as such files and read back.

Files go to the shared folder, one folder for each run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.plans.tables import files_of, money, table
from tallyforge.session import new_run_folder
from tallyforge.sinks import files
from tallyforge.sources import ratings, reviews, sales


#: Rows of a file of reviews, which one task reads.
REVIEWS = 20_000


def _lines(df: DataFrame, value: Column) -> str:
    """Text files of one value a line; their folder."""
    path = new_run_folder(df.sparkSession, "lines")
    df.select(value.alias("value")).write.text(path)
    return path


def parse_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as review lines. Those in German are too short, those in Spanish headers;
    the sentiments of the rest hold a separator."""
    documents = table(spark, folder, "documents")
    comment = F.translate(F.coalesce("text", F.lit("")), ";", ",")
    line = F.concat(
        F.lit(" "), F.when(F.col("lang") == "es", "id").otherwise(F.col("doc_id").cast("string")),
        F.lit(";"), comment,
        F.when(F.col("lang") != "de", F.concat(F.lit("; "), "lang", F.lit(" ;"), "source", F.lit("; Good;Bad \t")))
        .otherwise(""),
    )
    return reviews.parse_reviews(documents.select(line.alias("value")))


def read_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as rating lines in two folders; those of returned items have no comma."""
    items = table(spark, folder, "lineitem")
    cells = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")]
    line = F.when(F.col("l_returnflag") == "R", cells[0]).otherwise(F.concat_ws(",", *cells))
    early = F.col("l_linenumber") < 4
    return ratings.read_ratings(
        spark, _lines(items.filter(early), line), _lines(items.filter(~early), line)
    )


def read_items(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as item lines: titles with a comma, small parts without labels."""
    parts = table(spark, folder, "part")
    title = F.concat("p_name", F.lit(", "), "p_brand")
    line = F.when(F.col("p_size") < 10, F.concat_ws(",", "p_partkey", "p_name")).otherwise(
        F.concat_ws(",", "p_partkey", title, "p_type")
    )
    return ratings.read_items(spark, _lines(parts, line))


def _order_item_cells() -> dict[str, Column]:
    return {
        "Order_ID": F.col("l_orderkey"), "Product_ID": F.col("l_partkey"),
        "Seller_ID": F.col("l_suppkey"), "Price": money("l_extendedprice"),
        "Freight_Value": money("l_quantity"), "Shipping_Limit_Date": F.col("l_shipdate"),
    }


def _by_product(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.sum("price").cast("double").alias("price"),
        F.sum("freight").cast("double").alias("freight"),
        F.countDistinct("order_id", "seller_id").alias("n_pairs"),
        F.max("ship_by").cast("timestamp_ntz").alias("last_ship_by"),
    )


def read_order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as sales files, with a column that no layout names; sums by product."""
    path = new_run_folder(spark, "order-items")
    columns = [value.alias(header) for header, value in reversed(_order_item_cells().items())]
    rows = table(spark, folder, "lineitem").select("l_linestatus", *columns)
    rows.write.option("sep", ";").option("header", True).csv(path)
    return _by_product(sales.read_order_items(spark, path))


def read_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """The same from one folder whose files have three headers: other orders of the columns, a
    column more, and a column less where it has no value."""
    path = new_run_folder(spark, "mixed-headers")
    cells = [value.alias(header) for header, value in _order_item_cells().items()]
    items = table(spark, folder, "lineitem")
    status = F.col("l_linenumber") % 3
    parts = [
        items.filter(status == 0).select(*cells),
        items.filter(status == 1).select("l_linestatus", *reversed(cells)),
        items.filter(status == 2).select(*cells[3:], *cells[:3]).drop("Freight_Value"),
    ]
    for rows in parts:
        rows.write.mode("append").option("sep", ";").option("header", True).csv(path)
    return _by_product(sales.read_order_items(spark, path))


def read_order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews in quoted cells that hold line breaks, separators and quotes."""
    path = new_run_folder(spark, "order-reviews")
    comment = F.concat(F.lit('say ";"\n'), F.coalesce("text", F.lit("")), F.lit("\n"))
    rows = table(spark, folder, "documents").select(
        F.col("doc_id").alias("Order_ID"), comment.alias("Review"), F.col("n_chars").alias("Review_Score")
    )
    writer = rows.repartition(4 * files_of(rows.count(), 4, REVIEWS)).write.option("sep", ";").option("header", True)
    writer.option("quoteAll", True).option("escape", '"').csv(path)
    return sales.read_order_reviews(spark, path)


def tsv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as tab-separated lines, which hold every character of the texts."""
    path = new_run_folder(spark, "tsv")
    files.write_tsv(table(spark, folder, "documents").select("doc_id", "text"), path, sort_by=["doc_id"])
    cells = F.split("value", "\t", 2)
    return spark.read.text(path).select(
        cells[0].cast("long").alias("doc_id"), F.sha2(cells[1], 256).alias("line_sha256")
    )


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as comma-separated files, names between spaces, quotes and commas."""
    path = new_run_folder(spark, "csv")
    name = F.concat(F.lit("  "), "p_name", F.lit(' "'), "p_brand", F.lit('", '))
    rows = table(spark, folder, "part").select("p_partkey", name.alias("name"), "p_size")
    files.write_csv(rows, path)
    return spark.read.option("header", True).option("escape", '"').schema(rows.schema).csv(path)


QUERIES = {
    "parse_reviews": parse_reviews,
    "read_ratings": read_ratings,
    "read_items": read_items,
    "read_order_items": read_order_items,
    "read_mixed_headers": read_mixed_headers,
    "read_order_reviews": read_order_reviews,
    "tsv_round_trip": tsv_round_trip,
    "csv_round_trip": csv_round_trip,
}


def _sums_by_product(freight: str) -> str:
    return f"""
      SELECT CAST(l_partkey AS VARCHAR) AS product_id,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS price,
             CAST(sum(CAST({freight} AS DECIMAL(15,2))) AS DOUBLE) AS freight,
             count(DISTINCT (l_orderkey, l_suppkey)) AS n_pairs,
             max(CAST(l_shipdate AS TIMESTAMP)) AS last_ship_by
      FROM lineitem GROUP BY 1"""


SQL = {
    "parse_reviews": """
      SELECT CAST(doc_id AS VARCHAR) AS id, replace(coalesce(text, ''), ';', ',') AS comment,
             lang AS aspect, source AS category, 'good;bad' AS sentiment
      FROM documents WHERE lang NOT IN ('de', 'es')""",
    "read_ratings": """
      SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id,
             CAST(l_quantity AS DOUBLE) AS rating, CAST(l_linenumber AS BIGINT) AS epoch
      FROM lineitem WHERE l_returnflag <> 'R'""",
    "read_items": f"""
      SELECT CAST(p_partkey AS VARCHAR) AS item_id,
             CASE WHEN p_size < 10 THEN p_name ELSE p_name || ', ' || p_brand END AS title,
             CASE WHEN p_size < 10 THEN '{ratings.NO_LABELS}' ELSE p_type END AS labels
      FROM part""",
    "read_order_items": _sums_by_product("l_quantity"),
    "read_mixed_headers": _sums_by_product("CASE WHEN l_linenumber % 3 <> 2 THEN l_quantity END"),
    "read_order_reviews": """
      SELECT CAST(doc_id AS VARCHAR) AS order_id, CAST(n_chars AS VARCHAR) AS review_score
      FROM documents""",
    "tsv_round_trip": r"""
      SELECT doc_id, sha256(replace(replace(replace(replace(coalesce(text, ''),
             '\', '\\'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r')) AS line_sha256
      FROM documents""",
    "csv_round_trip": """
      SELECT p_partkey, '  ' || p_name || ' "' || p_brand || '", ' AS name, p_size FROM part""",
}
