"""Tumbling statistics over a stream of detection events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyforge import schemas
from tallyforge.operators.frames import person_statistics
from tallyforge.streaming import segments
from tallyforge.streaming.batches import keyed_state, run_batches


def minute_statistics(events: DataFrame, delay: str, width: str = "1 minute") -> DataFrame:
    """Per window and camera, as the batch query `by_minute` gives over the stored
    table. Events later than `delay` are left out unless the output mode is complete;
    the batch query stays the definition of truth."""
    window = F.window("captured_at", width)
    stats = events.withWatermark("captured_at", delay).groupBy(window, "camera_id")
    return stats.agg(*person_statistics()).select(
        F.col("window.start").alias("minute"),
        "camera_id",
        "avg_persons",
        "max_persons",
        "frame_count",
    )


def minutes_table(path: str) -> segments.Table:
    """Statistics in a folder for each day; of a minute and camera the newest row counts."""
    return segments.Table(
        path, schemas.STORED_MINUTES, by="day", sort=("minute",), keys=("minute", "camera_id", "day")
    )


def start_statistics(
    events: DataFrame,
    path: str,
    checkpoint: str,
    delay: str,
    width: str = "1 minute",
    merge: int = segments.FACTOR,
    **trigger: bool | str,
) -> StreamingQuery:
    """Keep a table of statistics up to date. Each batch writes only the windows that it changed,
    which replace their older rows; state holds the windows of the last `delay` alone, as the
    watermark drops the others. Events that come later than `delay` are left out."""
    table, spark = minutes_table(path), events.sparkSession

    def write(batch: DataFrame, writer: str, batch_id: int) -> None:
        changed = batch.withColumn("day", F.to_date("minute"))
        segments.append(table, changed.select(*table.schema.fieldNames()), writer, batch_id)
        if merge:
            segments.merge(spark, table, merge)
            segments.clean(spark, table)

    with keyed_state(spark):
        return run_batches(
            minute_statistics(events, delay, width), write, checkpoint, "update", **trigger
        )


def read_minutes(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """Statistics as they are now, of the days from `since` on if given."""
    chosen = None if since is None else (lambda day: day >= since.isoformat())
    return segments.read(spark, minutes_table(path), chosen).drop("day")
