"""Access to the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(name: str) -> Column:
    """An amount of two decimals as such, so that sums are exact."""
    return F.col(name).cast("decimal(15,2)")


def files_of(n_rows: int, parts: int, file_rows: int) -> int:
    """How many files each of `parts` equal parts of a table becomes, of about `file_rows` rows at
    most, so that no task writes or reads more as the table grows."""
    return max(1, -(-n_rows // (parts * file_rows)))


#: Tables of fewer splits than this (about a gigabyte) are small.
SMALL_SPLITS = 8


def spread(df: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """A small table, straight from its files, that gives fewer splits than there are cores is
    dealt out to them, which pays for work like tokenising. Tables of SMALL_SPLITS splits
    and more stay as they are, however many cores there are. For a stream, `files` is the table
    that it reads."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = (df if files is None else files).rdd.getNumPartitions()
    return df.repartition(cores) if splits < min(cores, SMALL_SPLITS) else df
