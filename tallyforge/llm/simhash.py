"""SimHash near-duplicates: fingerprints linked at few differing bits, found by
pigeonring filtering.

The bits are cut into one segment more than differing bits are allowed, laid in a ring. Of two
linked fingerprints, some segment starts a chain in which the first l segments hold at
most l / segments of the allowed differences, for every l. So the first segment is equal
and the second differs in one bit at most: that is an equi-join. The longer chains and
then the whole distance are checked within the join, so that only links come out of it.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import kept_table, map_chunks, numbered, texts_of
from tallyforge.llm.components import components

BITS = 64
SEED = 42


def fingerprint(text: str, words: int = 3) -> int:
    """Fingerprint of one text as a signed long; see `fingerprints`."""
    import xxhash

    # bytes.lower and bytes.split know ASCII alone
    parts = text.encode().lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    n = max(1, len(parts) - words + 1)
    starts = np.r_[0, ends + 1][:n].tolist()
    stops = ends[min(words, len(parts)) - 1 :].tolist()
    shingles = [line[a:b] for a, b in zip(starts, stops, strict=True)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", n)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, BITS).sum(0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, row: str | None = None) -> DataFrame:
    """row (the column of that name, or else a number), doc_id and fp (long) of every row.

    A text is lower-cased in A-Z and cut at ASCII white space; its shingles are `words`
    words joined by a space, repeats included, or the whole sequence if it has fewer; a bit
    is set if over half of the shingles' XXH64 have it. Null and texts without words have 0.
    """

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = [fingerprint(t, words) for t in texts_of(batch)]
            return pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(fps, pa.int64())],
                ["row", "doc_id", "fp"],
            )

        return each

    rows = docs.select(
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        F.col("doc_id").cast("long"),
        "text",
    )
    return map_chunks(rows, "text", start, "row long, doc_id long, fp long")


def _bits(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def links(classes: DataFrame, distance: int = 3) -> DataFrame:
    """a, b: distinct fingerprints (column fp) that differ in 1 to `distance` bits; a pair
    may come once for each start of a chain, never in both orders."""
    if not distance:
        return classes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    m = distance + 1
    edges = [BITS * i // m for i in range(m + 1)]
    parts = [(edges[i], edges[i + 1] - edges[i]) for i in range(m)]
    index, probe = [], []
    for i, (low, width) in enumerate(parts):
        low2, width2 = parts[(i + 1) % m]
        head = _bits(F.col("fp"), low, width)
        key = lambda tail, head=head, width2=width2: F.shiftleft(head, width2).bitwiseOR(tail)
        tail = _bits(F.col("fp"), low2, width2)
        index.append(F.struct(F.lit(i).alias("start"), key(tail).alias("key")))
        # One of two tails that differ in one bit has that bit unset: it does the asking
        flips = [
            F.when(
                tail.bitwiseAND(F.lit(1 << j)) == 0,
                F.struct(
                    F.lit(i).alias("start"),
                    key(tail.bitwiseOR(F.lit(1 << j))).alias("key"),
                    F.lit(True).alias("flip"),
                ),
            )
            for j in range(width2)
        ]
        probe.append(
            F.struct(
                F.lit(i).alias("start"), key(tail).alias("key"), F.lit(False).alias("flip")
            )
        )
        probe += flips
    left = classes.select("fp", F.explode(F.array(*probe)).alias("p")).where("p is not null")
    left = left.select(F.col("fp").alias("a"), "p.*")
    right = classes.select("fp", F.explode(F.array(*index)).alias("p"))
    right = right.select(F.col("fp").alias("b"), "p.*")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    chain = F.lit(True)
    for i in range(m):
        for length in range(3, m):
            mask = sum(
                ((1 << w) - 1) << at for at, w in (parts[(i + k) % m] for k in range(length))
            )
            mask = mask - (1 << BITS) if mask >> (BITS - 1) else mask
            few = F.bit_count(apart.bitwiseAND(F.lit(mask))) <= length * distance // m
            chain = chain & ((F.col("l.start") != i) | few)
    both = left.alias("l").join(
        right.alias("r"),
        (F.col("l.start") == F.col("r.start"))
        & (F.col("l.key") == F.col("r.key"))
        & (F.col("flip") | (F.col("a") < F.col("b")))
        & chain
        & (F.bit_count(apart) <= distance),
    )
    return both.select("a", "b")


def _grouped(
    docs: DataFrame, words: int, distance: int, row: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """row, doc_id, fp of every row; and fp, first (smallest doc_id), n_same, root of every
    fingerprint. Equal fingerprints are one class, so copies never meet in pairs."""
    fps = kept_table(fingerprints(docs, words, row), "fingerprints")
    classes = kept_table(
        fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_same")),
        "classes",
    )
    roots = components(links(classes, distance)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return fps, kept_table(rooted, "rooted")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable over links), n_same (rows with
    the fingerprint), one row for each of `docs`.

    Null texts count as empty; a null doc_id keeps its row and takes the component of its
    fingerprint, which is null if no row there has an id. Repeated rows stay. Empty in,
    empty out.
    """
    fps, rooted = _grouped(docs, words, distance)
    first = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = kept_table(rooted.join(first, "root").select("fp", "n_same", "component_id"), "named")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id", "n_same")


def keep_first(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """The row of the smallest doc_id of every component (any one of repeated rows; rows
    without doc_id only where no other is there), with all columns.

    `docs` is written once with the numbers of its rows, and read from there.
    """
    rows, name = numbered(docs)
    fps, rooted = _grouped(rows, words, distance, name)
    placed = kept_table(fps.join(rooted.select("fp", "root"), "fp"), "placed")
    first = kept_table(
        placed.groupBy("root").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).getField("row").alias("first")
        ),
        "first",
    )
    others = placed.join(first, "root").where("row <> first")
    rest = kept_table(others.select(F.col("row").alias(name)), "others")
    return rows.join(rest, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def hexed(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
