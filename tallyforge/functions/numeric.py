"""Number parsing and averages."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lenient_int(text: Column) -> Column:
    """Integer part of a numeric text; anything else is NULL and never an error."""
    return text.try_cast("double").try_cast("int")


def ratio(total: Column, n: Column) -> Column:
    return total.cast("double") / n


def units(amount: Column, digits: int) -> Column:
    """An amount of so many decimal digits as a whole number of its smallest unit."""
    return F.rint(amount * 10**digits).cast("long")


def from_units(total: Column, digits: int) -> Column:
    """A total of such units as double, the one nearest to the exact amount."""
    return (total * F.lit(Decimal(1).scaleb(-digits))).cast("double")


def total(df: DataFrame, name: str) -> Column:
    """Sum of a column. Whole numbers are summed as decimals, which do not overflow;
    that is much cheaper than to turn each fraction into a decimal, and as exact."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.sum(F.col(name).cast("decimal(18,0)"))
    return F.sum(name)


def average(df: DataFrame, name: str) -> Column:
    """Mean of a column as double. Decimals are summed exactly first, so the
    result does not depend on the order in which partitions arrive."""
    if isinstance(df.schema[name].dataType, T.DecimalType):
        return F.try_divide(F.sum(name).cast("double"), F.count(name))
    return F.avg(name)
