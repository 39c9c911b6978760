"""Detection results from frames, by a pluggable detector."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyforge import schemas
from tallyforge.operators.frames import MIN_CONFIDENCE, persons_only
from tallyforge.sinks.messages import to_messages
from tallyforge.streaming.batches import run_batches, write_batch
from tallyforge.streaming.ingest import UNKNOWN_CAMERA, now

Detector = Callable[[bytes], list[dict]]
ListDetector = Callable[[list[bytes]], list[list[dict]]]

RAW = T.StructType(
    [
        *(f for f in schemas.DETECTION if f.name in ("frame_id", "timestamp", "camera_id")),
        T.StructField("processed_at", T.DoubleType()),
        T.StructField("inference_time", T.DoubleType()),
        T.StructField("raw_boxes", T.ArrayType(schemas.RAW_BOX)),
        T.StructField("reason", T.StringType()),
    ]
)
FAILED = ("frame_id", "timestamp", "camera_id", "reason")

# The detector of this Python worker, by the call of `check_pictures` that it is for
_loaded: dict[str, Detector] = {}


def check_pictures(
    frames: DataFrame,
    load_detector: Callable[[], Detector | ListDetector],
    min_confidence: float = MIN_CONFIDENCE,
    list_size: int | None = None,
) -> DataFrame:
    """One detection result per frame that has a picture, with a `reason` if the
    detector failed on it, else NULL.

    `load_detector` runs once per Python worker and returns a function from picture bytes
    to objects with x1, y1, x2, y2, confidence and class_id; with `list_size` a function from a
    list of up to so many pictures to a list of such results, for models that work on many at
    once. A list that fails is halved until the bad picture is alone, so the others keep
    their results. Only the calls run in Python; decoding, filtering and rounding stay in the
    JVM. Arrow batches are bounded by bytes (spark.sql.execution.arrow.maxBytesPerBatch),
    which suits large pictures.
    """
    pictures = frames.filter(F.length("frame_b64") > 0).select(
        F.coalesce("frame_id", F.lit("unknown")).alias("frame_id"),
        F.coalesce("timestamp", now()).alias("timestamp"),
        F.coalesce("camera_id", F.lit(UNKNOWN_CAMERA)).alias("camera_id"),
        # NULL where the text is no base64
        F.try_to_binary("frame_b64", F.lit("base64")).alias("picture"),
    )
    raw = pictures.mapInPandas(_calls(load_detector, uuid.uuid4().hex, list_size), RAW)
    boxes = persons_only(F.col("raw_boxes"), min_confidence)
    return (
        raw.withColumn("bounding_boxes", boxes)
        .withColumn("person_count", F.size("bounding_boxes"))
        .select(*schemas.DETECTION.fieldNames(), "reason")
    )


def detected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNull()).select(*schemas.DETECTION.fieldNames())


def failed(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNotNull()).select(*FAILED)


def detect(
    frames: DataFrame,
    load_detector: Callable[[], Detector | ListDetector],
    min_confidence: float = MIN_CONFIDENCE,
    list_size: int | None = None,
) -> DataFrame:
    """The results of `check_pictures` alone, without frames that the detector failed on."""
    return detected(check_pictures(frames, load_detector, min_confidence, list_size))


def _detector(key: str, load_detector: Callable[[], Detector]) -> Detector:
    if key not in _loaded:
        # One model in memory
        _loaded.clear()
        _loaded[key] = load_detector()
    return _loaded[key]


SIDES = ("x1", "y1", "x2", "y2", "confidence")


def _shaped(boxes: list[dict]) -> list[dict]:
    """The objects of one picture as numbers; an error if they are anything else, here and not
    where a whole batch of results is turned into columns."""
    out = []
    for box in boxes:
        row = {name: float(box[name]) for name in SIDES}
        row["class_id"] = int(box["class_id"])
        out.append(row)
    return out


def _said(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def results(
    detector: ListDetector, pictures: list[bytes]
) -> list[tuple[list[dict], str | None, float]]:
    """Objects, reason of a failure and seconds of each picture, from one call for all of them, or
    from calls for each half where that fails."""
    start = time.perf_counter()
    try:
        found = detector(pictures)
        if len(found) != len(pictures):
            raise ValueError(f"{len(found)} results for {len(pictures)} pictures")
    except Exception as error:
        if len(pictures) == 1:
            return [([], _said(error), time.perf_counter() - start)]
        half = len(pictures) // 2
        return results(detector, pictures[:half]) + results(detector, pictures[half:])
    seconds = (time.perf_counter() - start) / len(pictures)
    out = []
    for boxes in found:
        try:
            out.append((_shaped(boxes), None, seconds))
        except Exception as error:
            out.append(([], _said(error), seconds))
    return out


def _calls(load_detector: Callable[[], Detector | ListDetector], key: str, list_size: int | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = _detector(key, load_detector)
        many = detector if list_size else lambda pictures: [detector(p) for p in pictures]
        for batch in batches:
            pictures = [None if p is None else bytes(p) for p in batch["picture"]]
            there = [i for i, p in enumerate(pictures) if p is not None]
            rows = [([], "ValueError: the picture is no base64", 0.0)] * len(pictures)
            done = [time.time()] * len(pictures)
            step = list_size or 1
            for at in range(0, len(there), step):
                part = there[at : at + step]
                for i, row in zip(part, results(many, [pictures[i] for i in part]), strict=True):
                    rows[i], done[i] = row, time.time()
            yield batch.drop(columns="picture").assign(
                processed_at=done,
                inference_time=[round(seconds, 4) for _, _, seconds in rows],
                raw_boxes=[boxes for boxes, _, _ in rows],
                reason=[reason for _, reason, _ in rows],
            )

    return run


def start_detect(
    frames: DataFrame,
    load_detector: Callable[[], Detector | ListDetector],
    path: str,
    rejects_path: str,
    checkpoint: str,
    min_confidence: float = MIN_CONFIDENCE,
    list_size: int | None = None,
    **trigger: bool | str,
) -> StreamingQuery:
    """Frames in, from `parse_frames` or `stream_table`; detection messages out, to text
    files in a folder below `path` for each micro-batch (read them as `path/*`); frames that
    the detector failed on go to a table. A batch written again comes again; the store drops
    such repeats. For a topic, hand `to_messages(detect(..))` to `publish_kafka` instead."""

    def write(batch: DataFrame, writer: str, batch_id: int) -> None:
        messages = to_messages(detected(batch))
        messages.write.mode("overwrite").text(f"{path}/{writer}-{batch_id}")
        write_batch(failed(batch), rejects_path, writer, batch_id)

    checked = check_pictures(frames, load_detector, min_confidence, list_size)
    return run_batches(checked, write, checkpoint, **trigger)
