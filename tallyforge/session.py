"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "tallyforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, AQE and skew-join splitting; `conf` entries win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named or _own_folder()


@functools.cache
def _own_folder() -> str:
    """Only for sessions that name no shared folder, as in tests."""
    return tempfile.mkdtemp(prefix="tallyforge-")


def new_run_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one run's tables."""
    return f"{shared_folder(spark)}/tallyforge/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and go on from there, so that later
    branches neither recompute it nor depend on the executors that made it."""
    path = new_run_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
