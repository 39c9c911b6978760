"""Line-oriented text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.text import trim_controls


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw lines as one column `value`."""
    return spark.read.text(list(paths))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed lower-cased lines, as a column `word`. A file of any length: the words
    stay a table, which the operators join."""
    word = F.lower(trim_controls(F.col("value"))).alias("word")
    return read_lines(spark, path).select(word).filter(F.length("word") > 0).distinct()
