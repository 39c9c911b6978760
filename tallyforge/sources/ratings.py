"""Comma-separated rating, item, user and occupation lines without header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge import schemas
from tallyforge.sources.lines import read_lines

# Any character may stand in a title, odd line ends too: id, then the title up to the last comma, then the labels
ITEM_LINE = r"(?s)^([^,]*),(.*?)(?:,([^,]*))?$"
NO_LABELS = "Unknown"


def parse_fields(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Positional fields cast to `schema`; lines without a comma are dropped. A text that
    is no number, or a line that is too short for a field in use, fails the job."""
    parts = F.split("value", ",")
    return (
        lines.filter(F.col("value").contains(","))
        .select(parts.alias("parts"))
        .select(
            *(
                F.col("parts")[i].cast(field.dataType).alias(field.name)
                for i, field in enumerate(schema)
            )
        )
    )


def parse_items(lines: DataFrame) -> DataFrame:
    """Id, title (which may hold commas) and label text, `Unknown` if there is none."""
    labels = F.regexp_extract("value", ITEM_LINE, 3)
    return lines.filter(F.col("value").contains(",")).select(
        F.regexp_extract("value", ITEM_LINE, 1).alias("item_id"),
        F.regexp_extract("value", ITEM_LINE, 2).alias("title"),
        F.when(labels == "", F.lit(NO_LABELS)).otherwise(labels).alias("labels"),
    )


def read_ratings(spark: SparkSession, *paths: str) -> DataFrame:
    """All rating files as one table; repeated ratings are kept."""
    return parse_fields(read_lines(spark, *paths), schemas.RATINGS)


def read_items(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_items(read_lines(spark, *paths))


def read_users(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_fields(read_lines(spark, *paths), schemas.USERS)


def read_occupations(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_fields(read_lines(spark, *paths), schemas.OCCUPATIONS)
