"""Semicolon-separated sales tables with a header."""

from __future__ import annotations

import csv
import functools
import urllib.parse
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge import schemas

Layout = Mapping[str, tuple[str, T.DataType]]


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    layout: Layout,
    *,
    multiline: bool = False,
    infer: bool = False,
) -> DataFrame:
    """The columns of `layout`, found by header name and cast to its types; a cell
    that does not fit is NULL. Files may have headers of their own: those of one header are read
    together by its names, then all are united. Where a header lacks a column, its rows are NULL
    there; a column that no file has is an error. With `infer` all columns come, those of
    `layout` under its names, with the types that Spark infers, at the price of another pass;
    then headers must agree."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("sep", ";").option("header", True).option("enforceSchema", False)
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    if infer:
        table = reader.option("inferSchema", True).csv(paths)
        return table.withColumnsRenamed({header: name for header, (name, _) in layout.items()})
    groups = headers(spark, paths)
    known = {name for header in groups for name in header}
    if missing := [name for name in layout if name not in known]:
        raise ValueError(f"no file has the columns {', '.join(missing)}")
    if len(groups) == 1:
        return _laid_out(reader.csv(paths), layout)
    parts = [
        _laid_out(reader.schema(_texts(header)).csv(files), layout)
        for header, files in sorted(groups.items())
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def _texts(header: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in header])


def _laid_out(table: DataFrame, layout: Layout) -> DataFrame:
    def cell(header: str) -> Column:
        return F.col(f"`{header}`") if header in table.columns else F.lit(None)

    return table.select(
        *(cell(header).try_cast(kind).alias(name) for header, (name, kind) in layout.items())
    )


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The headers of some CSV files, each with the names of its files. Tasks read the first line
    of each file and hand on one row for it; of a file that is split, only the part with
    the header is read on."""
    lines = spark.read.text(list(paths)).select(
        "value", "_metadata.file_path", "_metadata.file_block_start"
    )

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            files = batch.column("file_path").to_pylist()
            if batch.column("file_block_start")[0].as_py() and last is None:
                return
            at = [i for i, file in enumerate(files) if file != (files[i - 1] if i else last)]
            last = files[-1]
            found = batch.take(pa.array(at, pa.int64()))
            yield found.filter(pc.equal(found.column("file_block_start"), 0)).select(
                ["value", "file_path"]
            )

    out: dict[tuple[str, ...], list[str]] = {}
    for line, file in lines.mapInArrow(first, "value string, file_path string").collect():
        header = next(csv.reader([line.removeprefix("\ufeff")], delimiter=";"))
        # The names come as parts of a URI
        out.setdefault(tuple(header), []).append(urllib.parse.unquote(file))
    return out


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.ORDERS_CSV)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.CUSTOMERS_CSV)


def read_order_items(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.ORDER_ITEMS_CSV)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.PRODUCTS_CSV)


def read_order_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Reviews hold quoted line breaks, so one file is one task: keep them in many
    files, or convert them to parquet once."""
    return read_table(spark, path, schemas.ORDER_REVIEWS_CSV, multiline=True)
