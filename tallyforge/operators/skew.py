"""Joins in which one key may hold a large part of the rows.

Spark splits a skewed join at run time if both sides come straight from a shuffle. A
side that was aggregated on the join key does not: it keeps the partitions of the
aggregate, and the other side's hot key stays with one task. Written out first, it is
shuffled for the join like any table, and the other side can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyforge.session import materialise


def for_skewed_join(side: DataFrame) -> DataFrame:
    """`side`, aggregated on the join key, ready to be joined to rows of any size. It is
    written at once: a job runs while the plan is built."""
    return materialise(side)
