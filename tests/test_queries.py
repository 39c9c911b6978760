"""Every query over the supplied tables against its SQL twin, and what its plan must not hold.

The queries of the training-data operators, most of which no SQL can say, are tested beside
those operators.
"""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tallyforge import plans

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def table(columns, found):
    """Columns by name, rows in any order."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    values = sorted((tuple(plain(row[i]) for i in places) for row in found), key=repr)
    return [columns[i] for i in places], values


def test_every_query_has_sql():
    assert plans.QUERIES.keys() == plans.SQL.keys()


def test_every_query_is_registered():
    assert plans.QUERIES.items() <= entry.queries().items()
    assert plans.SQL.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_against_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, FOLDER)
    twin = duck.execute(plans.SQL[name])
    columns = [c[0] for c in twin.description]
    expected = table(columns, twin.fetchall())
    assert table(df.columns, [tuple(row) for row in df.collect()]) == expected
    assert expected[1], "nothing to compare"


@pytest.mark.parametrize("name", sorted(n for n in plans.QUERIES if not n.startswith("stream")))
def test_plan(spark, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    df = plans.QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan
    if name.startswith("top5") or name in ("first_wins", "insert_if_absent"):
        assert plan.count("WindowGroupLimit") == 2
    if name == "revenue_by_category":
        assert "GreaterThanOrEqual(o_orderdate" in plan
    if name == "aspect_sentiment":
        assert "text" not in plan
