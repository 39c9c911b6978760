"""Files of the session's file systems: names, small texts, removal. The only module that goes
through the JVM's file system classes, which a classic session has."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark itself would resolve it."""
    store, where = _place(spark, path)
    return store.makeQualified(where).toString()


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _place(spark, path)
    return store.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    store, where = _place(spark, path)
    if not store.exists(where):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(where))


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet."""
    store, where = _place(spark, path)
    out = store.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    store, where = _place(spark, path)
    size = store.getFileStatus(where).getLen()
    source = store.open(where)
    try:
        return bytes(source.readNBytes(size)).decode()
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all in it; nothing happens if it isn't there."""
    store, where = _place(spark, path)
    store.delete(where, True)
