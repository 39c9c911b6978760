"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, *, sort_by: list[str] | None = None) -> None:
    r"""`key<TAB>value` files, sorted within each file if asked. A value stands there as it
    is, but for a tab, a line break or a backslash, which become `\t`, `\n`, `\r`, `\\`."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    cells = []
    for name in df.columns:
        cell = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
        for odd, written in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            cell = F.replace(cell, F.lit(odd), F.lit(written))
        cells.append(cell)
    df.select(F.concat_ws("\t", *cells).alias("value")).write.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.partitionBy(*partition_by).parquet(path)


def preview(df: DataFrame, rows: int = 20, truncate: bool = True) -> None:
    """Print the first rows."""
    df.show(rows, truncate=truncate)
