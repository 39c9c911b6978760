"""Detection events and their boxes: filters, statistics, latest rows."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.timing import bucket

# The class of a person, the confidence threshold, page sizes
PERSON_CLASS = 0
MIN_CONFIDENCE = 0.5
LATEST_BUCKETS = 60
LATEST_EVENTS = 20


def for_camera(events: DataFrame, camera_id: str | None) -> DataFrame:
    """Events of one camera; none or an empty name means all."""
    return events.filter(F.col("camera_id") == camera_id) if camera_id else events


def persons_only(raw_boxes: Column, min_confidence: float = MIN_CONFIDENCE) -> Column:
    """Boxes of persons at or above the threshold, with whole coordinates and the
    confidence to four digits. A box beyond whole numbers is dropped."""
    sides = ("x1", "y1", "x2", "y2")
    kept = F.filter(
        raw_boxes,
        lambda b: (b["class_id"] == PERSON_CLASS)
        & (b["confidence"] >= min_confidence)
        & functools.reduce(lambda x, y: x & y, [b[s].try_cast("int").isNotNull() for s in sides]),
    )
    return F.transform(
        kept,
        lambda b: F.struct(
            *(b[side].try_cast("int").alias(side) for side in sides),
            F.round(b["confidence"], 4).alias("confidence"),
            F.lit("person").alias("label"),
        ),
    )


def _average_persons() -> Column:
    return F.round(F.avg("person_count"), 2)


def summary(events: DataFrame, camera_id: str | None = None) -> DataFrame:
    """Exactly one row, also for no events."""
    return for_camera(events, camera_id).agg(
        F.count("*").alias("total_frames"),
        F.coalesce(F.sum("person_count"), F.lit(0)).alias("total_persons_detected"),
        _average_persons().alias("avg_persons_per_frame"),
        F.max("person_count").alias("max_persons"),
        F.max("captured_at").alias("last_seen"),
    )


def person_statistics() -> list[Column]:
    return [
        _average_persons().alias("avg_persons"),
        F.max("person_count").alias("max_persons"),
        F.count("*").alias("frame_count"),
    ]


def timeseries(
    events: DataFrame,
    interval: str = "minute",
    limit: int = LATEST_BUCKETS,
    camera_id: str | None = None,
) -> DataFrame:
    """The latest `limit` minutes, hours or days that hold events; no gaps filled."""
    start = bucket(interval, F.col("captured_at")).alias("bucket")
    stats = for_camera(events, camera_id).groupBy(start).agg(*person_statistics())
    return stats.orderBy(F.desc("bucket")).limit(limit)


def by_minute(events: DataFrame) -> DataFrame:
    """Per minute and camera, latest minute first."""
    minute = bucket("minute", F.col("captured_at")).alias("minute")
    stats = events.groupBy(minute, "camera_id").agg(*person_statistics())
    return stats.orderBy(F.desc("minute"), "camera_id")


def recent(
    events: DataFrame, limit: int = LATEST_EVENTS, camera_id: str | None = None
) -> DataFrame:
    """The latest events, equal times by frame."""
    return (
        for_camera(events, camera_id)
        .select("frame_id", "camera_id", "captured_at", "person_count", "inference_time")
        .orderBy(F.desc("captured_at"), "frame_id")
        .limit(limit)
    )


def newest(
    parts: Iterable[DataFrame], result: Callable[[DataFrame], DataFrame], need: int
) -> DataFrame:
    """`result` of the first of `parts` that gives it `need` rows, else of the last. The parts
    hold the latest rows of a table, each more than the one before, up to all of them; what
    is wanted must not change as older rows join, once there are so many."""
    out = None
    for rows in parts:
        out = result(rows)
        if out.limit(need).count() >= need:
            break
    return out


def newest_timeseries(
    parts: Iterable[DataFrame],
    interval: str = "minute",
    limit: int = LATEST_BUCKETS,
    camera_id: str | None = None,
) -> DataFrame:
    """`timeseries` from the newest parts of a table. One bucket more than wanted must be there:
    the oldest of a part may go on in older rows."""
    more = newest(parts, lambda rows: timeseries(rows, interval, limit + 1, camera_id), limit + 1)
    return more.orderBy(F.desc("bucket")).limit(limit)


def newest_recent(
    parts: Iterable[DataFrame], limit: int = LATEST_EVENTS, camera_id: str | None = None
) -> DataFrame:
    """`recent` from the newest parts of a table."""
    return newest(parts, lambda rows: recent(rows, limit, camera_id), limit)


def frame_boxes(boxes: DataFrame, events: DataFrame, frame_id: str | None = None) -> DataFrame:
    """Boxes of stored events, of one frame if given. A frame is stored once, so this
    only tests whether it is."""
    if frame_id is not None:
        boxes = boxes.filter(F.col("frame_id") == frame_id)
    return boxes.join(events.select("frame_id"), "frame_id", "left_semi")
