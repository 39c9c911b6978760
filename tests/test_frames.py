import datetime as dt

import pytest
from helpers import ordered, rows
from pyspark.sql import functions as F

from tallyforge.operators import frames as ops

START = dt.datetime(2024, 3, 1, 10, 0, 5)


def event(i, camera, minutes, persons):
    return (f"f{i:02d}", camera, START + dt.timedelta(minutes=minutes), persons, 0.1)


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(
        [event(0, "a", 0, 1), event(1, "a", 0, 2), event(2, "b", 0, 5), event(3, "a", 61, 4),
         event(4, "b", 61, 0), event(5, "a", 61, 0), event(6, "a", 1500, 7)],
        "frame_id string, camera_id string, captured_at timestamp, person_count int,"
        " inference_time double",
    ).cache()


def test_summary(events):
    last = START + dt.timedelta(minutes=1500)
    assert rows(ops.summary(events)) == [(7, 19, 2.71, 7, last)]
    assert rows(ops.summary(events, "")) == rows(ops.summary(events))
    assert rows(ops.summary(events, "b")) == [(2, 5, 2.5, 5, START + dt.timedelta(minutes=61))]


def test_empty_table(events):
    none = events.limit(0)
    assert rows(ops.summary(none)) == [(0, 0, None, None, None)]
    assert rows(ops.timeseries(none)) == []


def test_average_rounds_half_up(spark):
    df = spark.range(200).select(
        F.when(F.col("id") == 0, 2).otherwise(1).cast("int").alias("person_count"),
        F.lit("a").alias("camera_id"), F.lit(START).alias("captured_at"),
    )
    assert ops.summary(df).first().avg_persons_per_frame == 1.01


def test_timeseries(events):
    hour = START.replace(minute=0, second=0)
    assert ordered(ops.timeseries(events, "hour")) == [
        (hour + dt.timedelta(days=1, hours=1), 7.0, 7, 1),
        (hour + dt.timedelta(hours=1), 1.33, 4, 3),
        (hour, 2.67, 5, 3),
    ]
    assert [r[3] for r in ordered(ops.timeseries(events, "day", camera_id="a"))] == [1, 4]
    assert len(ordered(ops.timeseries(events, "minute", limit=2))) == 2
    with pytest.raises(ValueError):
        ops.timeseries(events, "1 minute")


def test_by_minute(events):
    assert [r[1:] for r in ordered(ops.by_minute(events))] == [
        ("a", 7.0, 7, 1), ("a", 2.0, 4, 2), ("b", 0.0, 0, 1), ("a", 1.5, 2, 2), ("b", 5.0, 5, 1),
    ]


def test_recent(events):
    assert [r[0] for r in ordered(ops.recent(events, 3))] == ["f06", "f03", "f04"]
    assert [r[0] for r in ordered(ops.recent(events, 20, "b"))] == ["f04", "f02"]


def test_boxes_of_stored_frames(spark, events):
    boxes = spark.createDataFrame([("f00", 1), ("f00", 2), ("f01", 3), ("gone", 4)],
                                  "frame_id string, x1 int")
    assert rows(ops.frame_boxes(boxes, events)) == [("f00", 1), ("f00", 2), ("f01", 3)]
    assert rows(ops.frame_boxes(boxes, events, "f00")) == [("f00", 1), ("f00", 2)]
    assert rows(ops.frame_boxes(boxes, events, "gone")) == []


def test_persons_only(spark):
    raw = [(1.9, 2.1, -3.7, 4.0, c, k) for c, k in
           ((0.49, 0), (0.5, 0), (0.9, 1), (0.123456, 0), (0.987654, 0))]
    df = spark.createDataFrame(
        [(raw,)],
        "b array<struct<x1 double, y1 double, x2 double, y2 double, confidence double,"
        " class_id int>>",
    )
    boxes = df.select(F.inline(ops.persons_only(F.col("b"))))
    assert ordered(boxes) == [
        (1, 2, -3, 4, 0.5, "person"), (1, 2, -3, 4, 0.9877, "person"),
    ]
