"""Derived labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age bands start at these ages; the display names of genders.
AGE_EDGES = (18, 36, 51)
GENDER_M = "Nam"
GENDER_OTHER = "Nữ"


def gender_name(gender: Column) -> Column:
    """`M` gets its name, everything else (also NULL) the other one."""
    return F.when(gender == "M", F.lit(GENDER_M)).otherwise(F.lit(GENDER_OTHER))


def band(value: Column, edges: Sequence[int] = AGE_EDGES) -> Column:
    """Name of the half-open band a number falls into: `<18`, `18-35`, .., `51+`."""
    name = F.when(value < edges[0], F.lit(f"<{edges[0]}"))
    for low, high in zip(edges, edges[1:]):
        name = name.when(value < high, F.lit(f"{low}-{high - 1}"))
    return name.when(value >= edges[-1], F.lit(f"{edges[-1]}+"))


def level(value: Column, mid: float, high: float) -> Column:
    """`low`, `mid` or `high` by two inclusive lower bounds."""
    return (
        F.when(value >= high, F.lit("high"))
        .when(value >= mid, F.lit("mid"))
        .otherwise(F.lit("low"))
    )
