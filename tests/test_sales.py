import datetime as dt

import pytest
from helpers import ordered, rows
from pyspark.sql import functions as F

from tallyforge import schemas
from tallyforge.operators import sales as ops
from tallyforge.operators.keyed import first_per_key, insert_if_absent
from tallyforge.sources import sales as files

ORDERS = """Extra;Order_ID;Customer_Trx_ID;Order_Purchase_Timestamp;Order_Delivered_Carrier_Date
x;o1;c1;2024-01-01 00:00:00;2024-01-04 10:00:00
x;o2;c1;2023-12-31 23:59:59;2024-01-05 00:00:00
x;o3;c2;2024-12-31 23:59:59;2024-01-08 23:00:00
x;o4;c3;2025-01-01 00:00:00;
x;o5;;2024-06-01 00:00:00;broken
"""
CUSTOMERS = """Customer_Trx_ID;Customer_Country
c1;Spain
c2;Austria
c3;Spain
c9;Malta
"""
ITEMS = """Order_ID;Product_ID;Seller_ID;Price;Freight_Value;Shipping_Limit_Date
o1;p1;s1;10.5;1.5;2024-01-05 09:00:00
o1;p2;s2;20;;2024-01-05 09:00:00
o2;p1;s1;7;1;2024-01-05 23:59:00
o3;p3;s1;5;5;2024-01-06 00:00:00
o3;p3;s2;5;5;
o4;p4;;1;1;2024-01-06 00:00:00
"""
PRODUCTS = """Product_ID;Product_Category_Name
p1;Toys
p2;Toys
p3;#N/A
p4;Auto
"""
REVIEWS = '''Review_ID;Order_ID;Review_Score;Comment
r1;o1;5;"good
; ""really"" good"
r2;o1;4.5;fine
r3;o2;;none
r4;o2;9;too much
r5;o3;abc;no
r6;o3;1;bad
r7;;3;lost
'''


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sales")
    texts = {"orders": ORDERS, "customers": CUSTOMERS, "order_items": ITEMS,
             "products": PRODUCTS, "order_reviews": REVIEWS}
    found = {}
    for name, text in texts.items():
        path = folder / f"{name}.csv"
        path.write_text(text, encoding="utf-8")
        found[name] = getattr(files, f"read_{name}")(spark, str(path)).cache()
    return found


def test_sources(spark, tables, tmp_path):
    assert tables["orders"].columns == ["order_id", "customer_id", "purchased_at", "handed_over_at"]
    assert tables["order_reviews"].count() == 7
    assert tables["order_items"].filter("freight IS NULL").count() == 1
    path = tmp_path / "orders.csv"
    path.write_text(ORDERS.replace("broken", ""))
    inferred = files.read_table(spark, str(path), {}, infer=True)
    assert dict(inferred.dtypes)["Order_Purchase_Timestamp"] == "timestamp"


def test_distinct_totals_count_null_once(tables):
    totals = ops.distinct_totals(tables["orders"], tables["orders"], tables["order_items"])
    assert rows(totals) == [("customers", 4), ("orders", 5), ("sellers", 3)]
    none = ops.distinct_total(tables["orders"].limit(0), "order_id", "orders")
    assert rows(none) == [("orders", 0)]


def test_orders_by_country(tables):
    found = ops.orders_by_country(tables["orders"], tables["customers"])
    assert ordered(found) == [("Spain", 3), ("Austria", 1)]
    twice = tables["customers"].unionAll(tables["customers"])
    assert ordered(ops.orders_by_country(tables["orders"], twice)) == [("Spain", 6), ("Austria", 2)]


def test_orders_by_month(tables):
    assert ordered(ops.orders_by_month(tables["orders"])) == [
        (2023, 12, 1), (2024, 12, 1), (2024, 6, 1), (2024, 1, 1), (2025, 1, 1),
    ]


def test_scores(tables):
    valid = ops.valid_reviews(tables["order_reviews"])
    assert ordered(ops.score_histogram(valid)) == [(5, 1), (4, 1), (3, 1), (1, 1)]
    assert ordered(ops.score_average(valid)) == [(3.25,)]


def test_revenue(tables):
    found = ops.revenue_by_category(tables["orders"], tables["order_items"], tables["products"])
    # The line without freight adds nothing, and its year bounds are half open
    assert ordered(found) == [("#N/A", 20.0), ("Toys", 12.0)]


def test_product_sales(tables):
    valid = ops.valid_reviews(tables["order_reviews"])
    assert ordered(ops.product_sales(tables["order_items"], valid)) == [
        ("p1", 2, 4.5, 2), ("p3", 2, 1.0, 2), ("p2", 1, 4.5, 2), ("p4", 1, None, None),
    ]


def test_product_sales_count_all_pairs(spark):
    items = spark.createDataFrame(
        [("o", "p"), ("o", "p"), (None, "p"), ("o", None)], "order_id string, product_id string"
    )
    reviews = spark.createDataFrame(
        [("o", "5"), ("o", "2"), (None, "1")], "order_id string, review_score string"
    )
    assert rows(ops.product_sales(items, ops.valid_reviews(reviews))) == [
        ("p", 3, 3.5, 4), (None, 1, None, None),
    ]


def test_delivery(tables):
    found = ops.delivery_difference(tables["orders"], tables["order_items"])
    assert rows(found.select("order_id", "product_id", "diff_days")) == [
        ("o1", "p1", -1), ("o1", "p2", -1), ("o2", "p1", 0), ("o3", "p3", 2),
    ]


def test_delivery_from_texts(spark):
    orders = spark.createDataFrame(
        [("a", "2024-01-03 10:00:00"), ("b", "bad"), ("c", None)],
        "order_id string, handed_over_at string",
    )
    items = spark.createDataFrame(
        [("a", "p", "2024-01-01"), ("a", "q", "?"), ("b", "p", "2024-01-01")],
        "order_id string, product_id string, ship_by string",
    )
    found = ops.delivery_difference(orders, items)
    assert rows(found.select("product_id", "diff_days")) == [("p", 2)]


def test_segments(spark, tables):
    valued = ops.order_values(tables["orders"], tables["order_items"])
    found = ops.customer_segments(valued, (1, 2), (9, 10), (0.5, 2))
    assert rows(found.filter("customer_id IS NOT NULL")) == [
        ("c1", 2, 10.0, 2.0, "high-high-high"),
        ("c2", 1, 20.0, 1.0, "mid-high-mid"),
        ("c3", 1, 2.0, 1.0, "mid-low-mid"),
    ]


def test_seller_rank_against_counting(spark):
    lines = [(f"s{i % 23}", f"o{i % 41}", float(i * i % 7), 0.0) for i in range(200)]
    lines += [(f"t{i}", "o1", 3.0, 0.0) for i in range(30)] + [("n", "o1", None, 1.0)]
    items = spark.createDataFrame(
        lines, "seller_id string, order_id string, price double, freight double"
    )
    revenue, orders = {}, {}
    for seller, order, price, freight in lines:
        if price is not None:
            revenue[seller] = revenue.get(seller, 0.0) + price + freight
        orders.setdefault(seller, set()).add(order)
    expected = []
    for seller in orders:
        own, n = revenue.get(seller), len(orders[seller])
        place = 1 + sum(own is None or r > own for r in revenue.values())
        expected.append((seller, own, n, place, 1 + sum(len(o) > n for o in orders.values())))
    assert rows(ops.seller_rank(items)) == sorted(expected, key=repr)


def test_first_wins_and_insert_if_absent(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", at, 1), ("a", at + dt.timedelta(1), 2), ("b", at, 3), ("c", at, 4), ("c", at, 5)],
        "k string, at timestamp, v int",
    )
    first = first_per_key(df, ["k"], [F.col("at"), F.col("v")])
    assert rows(first.select("k", "v")) == [("a", 1), ("b", 3), ("c", 4)]
    target = spark.createDataFrame([("b",), ("b",), ("z",)], "k string")
    new = insert_if_absent(first, target, ["k"])
    assert rows(new.select("k", "v")) == [("a", 1), ("c", 4)]


LAYOUT = {"Order_ID": ("order_id", schemas.STRING), "Review_Score": ("score", schemas.STRING)}


def test_files_of_other_headers_are_read_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("Order_ID;Review_Score\n1;4\n")
    (folder / "b b%20.csv").write_text('Review_Score;"Order_ID";More\n5;2;x\n3;"3";y\n')
    (folder / "c.csv").write_text("Order_ID\r\n6\r\n")
    (folder / "d.csv").write_text("Order_ID;Review_Score\n7;1\n")
    (folder / "empty.csv").write_text("")
    found = files.read_table(spark, str(folder), LAYOUT)
    assert rows(found) == [("1", "4"), ("2", "5"), ("3", "3"), ("6", None), ("7", "1")]
    listed = files.headers(spark, [str(folder)])
    assert {h: len(f) for h, f in listed.items()} == {
        ("Order_ID", "Review_Score"): 2, ("Review_Score", "Order_ID", "More"): 1, ("Order_ID",): 1,
    }
    some = files.read_table(spark, [str(folder / "a.csv"), str(folder / "c.csv")], LAYOUT)
    assert rows(some) == [("1", "4"), ("6", None)]


def test_a_column_that_no_file_has_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Order_ID\n1\n")
    with pytest.raises(ValueError, match="Review_Score"):
        files.read_table(spark, str(tmp_path / "a.csv"), LAYOUT)


def test_headers_of_split_files(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="2000")
    (tmp_path / "in").mkdir()
    for i, header in enumerate(("Order_ID;Review_Score", "Review_Score;Order_ID")):
        lines = "\n".join(f"{k};{k}" for k in range(3000))
        (tmp_path / "in" / f"{i}.csv").write_text(f"{header}\n{lines}\n")
    assert len(files.headers(spark, [str(tmp_path / "in")])) == 2
    found = files.read_table(spark, str(tmp_path / "in"), LAYOUT)
    assert found.count() == 6000 and found.filter("order_id <> score").count() == 0


def test_sums_of_amounts_do_not_depend_on_the_partitions(spark, tmp_path):
    lines = "\n".join(f"o{i};p;s;{i % 97}.{i % 10}3;{i % 7}.07;" for i in range(3000))
    header = "Order_ID;Product_ID;Seller_ID;Price;Freight_Value;Shipping_Limit_Date\n"
    (tmp_path / "items.csv").write_text(header + lines)
    items = ops.with_revenue(files.read_order_items(spark, str(tmp_path / "items.csv")))
    sums = {items.repartition(n).agg({"revenue": "sum"}).first()[0] for n in (1, 3, 8, 17)}
    assert len(sums) == 1 and str(sums.pop()).rpartition(".")[2].isdigit()
