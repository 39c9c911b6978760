"""Labelled comments: `id;comment;aspect;category;sentiment` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge import schemas
from tallyforge.functions.text import trim_controls
from tallyforge.sources.lines import read_lines


def parse_reviews(lines: DataFrame) -> DataFrame:
    """Five columns from `value`. The header and lines of fewer fields are dropped;
    a fifth separator stays inside the sentiment. Labels are trimmed, the sentiment
    also lower-cased; the comment stays as written."""
    line = trim_controls(F.col("value"))
    part = F.col("parts")
    return (
        lines.select(line.alias("line"))
        .filter(~F.col("line").startswith("id;"))
        .select(F.split("line", ";", len(schemas.REVIEWS)).alias("parts"))
        .filter(F.size(part) == len(schemas.REVIEWS))
        .select(
            part[0].alias("id"),
            part[1].alias("comment"),
            trim_controls(part[2]).alias("aspect"),
            trim_controls(part[3]).alias("category"),
            F.lower(trim_controls(part[4])).alias("sentiment"),
        )
    )


def read_reviews(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_reviews(read_lines(spark, *paths))
