"""What the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge import storage
from tallyforge.session import shared_folder

#: Bytes of text that a Python task turns into Python objects at once.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and go on from the files, so that what follows
    neither computes it again nor depends on the executors that made it."""
    path = f"{shared_folder(df.sparkSession)}/tallyforge-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, as Spark resolves it: what tasks that open files themselves
    must be told, as a path without a scheme means another place to them."""
    return storage.qualified(spark, folder)


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The store that a folder is on, for tasks, and its path there. A folder without a scheme is
    local."""
    scheme, _, path = folder.partition(":/")
    return fs.FileSystem.from_uri(f"{scheme}:///{path.lstrip('/')}" if scheme == "file" and path else folder)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` written once with a further column of row numbers (partition, then place), and
    its name. All passes that know rows by number read these files: the splits of `docs`
    itself depend on the cores that are there when a pass is planned."""
    name = "row"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return kept_table(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def chunks(
    batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `most` bytes of `column` each; a longer value stands alone."""
    texts = batch.column(column)
    start = size = 0
    for i in range(len(texts)):
        value = texts[i]
        n = value.as_buffer().size if value.is_valid else 0
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n + 16
    if start < len(texts):
        yield batch.slice(start)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(run: Run) -> Run:
    """The same work of a task, which at its end hands back the memory that it took: Python
    workers live on, and wait beside those of later stages."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            # Not every C library has it
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return work


def map_chunks(
    df: DataFrame,
    column: str,
    start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
    schema: str | T.StructType,
    size: int = CHUNK_BYTES,
) -> DataFrame:
    """`df` through a function of record batches; `start` makes the function, once a task.

    Batches are cut by the bytes of `column`, so that memory doesn't grow with the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = start()
        for batch in batches:
            for part in chunks(batch, column, size):
                if (out := each(part)) is not None:
                    yield out

    return df.mapInArrow(tidy(run), schema)


class WordStore(dict):
    """What a task has made of each word, made when first asked for; beyond so many bytes of
    words the store starts anew."""

    #: What an entry takes beside its word.
    ENTRY = 120

    def __init__(self, make: Callable, limit: int = 32 << 20):
        super().__init__()
        self.make, self.limit, self.size = make, limit, 0

    def __missing__(self, word):
        size = sys.getsizeof(word) + self.ENTRY
        self.size += size
        if self.size > self.limit:
            self.clear()
            self.size = size
        made = self[word] = self.make(word)
        return made


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]
