"""First row, best rows and rank per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.session import materialise

#: Rows of a range that one task ranks.
RANGE_ROWS = 1_000_000


def best_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first `k` rows of each key in a total `order`, numbered from 1. The limit
    also works before the shuffle, so a hot key sends at most `k` rows per task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First-wins deduplication."""
    return best_per_key(df, keys, order, 1, "_place").drop("_place")


def insert_if_absent(incoming: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `incoming` whose key `target` does not hold. The target's keys are
    made distinct first, so that a hot key there is one row per task."""
    return incoming.join(target.select(*keys).distinct(), list(keys), "left_anti")


def total_before(
    df: DataFrame, order: Sequence[Column], weight: Column, out: str, rows: int, range_rows: int
) -> DataFrame:
    """Add the sum of `weight`, a whole number, over all rows that come before in a total `order`,
    without a one-task window: the rows are cut into ranges of about `range_rows`, as many as
    `rows`, an upper bound of theirs, asks for, and each range is summed on its own, on top of the
    ranges before it. One row a range goes through one task."""
    ranges = max(1, -(-rows // range_rows))
    # Written, so that a row is in the same range in both branches
    placed = materialise(
        df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    )
    earlier = (Window.unboundedPreceding, -1)
    above = F.sum("_sum").over(Window.orderBy("_range").rowsBetween(*earlier))
    sums = (
        placed.groupBy("_range")
        .agg(F.sum(weight).alias("_sum"))
        .select("_range", F.coalesce(above, F.lit(0)).alias("_above"))
    )
    inner = F.sum(weight).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(*earlier))
    return (
        placed.withColumn("_inner", F.coalesce(inner, F.lit(0)))
        .join(sums, "_range")
        .withColumn(out, F.col("_above") + F.col("_inner"))
        .drop("_range", "_above", "_inner")
    )


def numbered(
    df: DataFrame, order: Sequence[Column], out: str = "n", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Number the rows from 1 in a total `order`."""
    base = materialise(df)
    before = total_before(base, order, F.lit(1), out, base.count(), range_rows)
    return before.withColumn(out, F.col(out) + 1)


def rank_by(df: DataFrame, ranks: dict[str, str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add `rank() over (order by <column> desc nulls last)` for each entry of `ranks`
    (name -> column), without a one-task window. `df` is written once and then read by
    the branches."""
    base = materialise(df)
    rows = base.count()
    ranked = base
    for out, column in ranks.items():
        values = base.groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("_rows"))
        order = [F.col("_value").desc_nulls_last()]
        places = total_before(values, order, F.col("_rows"), "_before", rows, range_rows)
        places = places.select("_value", (F.col("_before") + 1).alias(out))
        ranked = ranked.join(places, F.col(column).eqNullSafe(F.col("_value"))).drop("_value")
    return ranked
