"""Training order: packed sequences of token ids in shards, at slots that a keyed Feistel
permutation gives.

The ids of all documents, an end mark behind each, are packed into sequences of one length.
Sequence i of n goes to slot p(i), where p is a permutation of 0 ... n-1 that needs no table:
a Feistel network over the next power of four, walked along its cycle until it is below n.
Slots are dealt out in ranges; each range is one shard, a file in which slot s stands at
byte (s - first) * stride. So a reader goes through files in sequence, and starts anywhere.

An id takes 1, 2 or 4 bytes, little end first (uint8, uint16, uint32). The largest id but one
of that width ends a document, the largest fills the last sequence of a partition; neither may
stand in a document. Ids come from a tokenizer, as arrays or packed in bytes; or a text is
taken by its bytes of UTF-8, one each, where 254 and 255 never occur.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import chunks, kept_table, located, opened, tidy
from tallyforge.session import shared_folder

ROUNDS = 6
#: Tasks that write shards; with more shards, a task writes several, one after the other.
MOST_TASKS = 20_000
#: Ids that are turned into bytes at once.
CHUNK_IDS = 1 << 20


def marks(width: int) -> tuple[int, int]:
    """The ids that end a document and fill a sequence."""
    if width not in (1, 2, 4):
        raise ValueError(f"an id takes 1, 2 or 4 bytes, not {width}")
    top = (1 << 8 * width) - 1
    return top - 1, top


def _rounds(key: int) -> list[np.uint64]:
    state, out = key & (2**64 - 1), []
    for _ in range(ROUNDS):
        state = (state + 0x9E3779B97F4A7C15) & (2**64 - 1)
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
        out.append(np.uint64(z ^ (z >> 31)))
    return out


def _network(x: np.ndarray, n: int, keys: list[np.uint64], back: bool) -> np.ndarray:
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = x >> half, x & mask
    for k in reversed(keys) if back else keys:
        side = left if back else right
        mixed = (side ^ k) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed >> np.uint64(32)) & mask
        left, right = (right ^ mixed, left) if back else (right, left ^ mixed)
    return left << half | right


def permute(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """Slots of sequences (or, `back`, sequences of slots), all in 0 ... n-1."""
    keys = _rounds(key)
    out = _network(np.asarray(index, np.uint64), n, keys, back) if n else np.zeros(0, np.uint64)
    while len(over := np.flatnonzero(out >= n)):
        out[over] = _network(out[over], n, keys, back)
    return out.astype(np.int64)


def _kind(docs: DataFrame, column: str) -> str:
    return docs.schema[column].dataType.typeName()


def _rows(batch: pa.RecordBatch, kind: str, width: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The ids of the column `ids` as bytes, an end mark behind each row, in bounded parts of the
    batch."""
    end, _ = marks(width)
    mark = end.to_bytes(width, "little")
    if kind != "array":
        for part in chunks(batch, "ids"):
            ids = [x or b"" for x in part.column("ids").cast(pa.binary()).to_pylist()]
            if kind == "binary":
                if any(len(x) % width for x in ids):
                    raise ValueError(f"packed ids must take {width} bytes each")
                _check(np.frombuffer(b"".join(ids), f"<u{width}"), width)
            yield part, [x + mark for x in ids]
        return
    sizes = batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // CHUNK_IDS)) + 1
    for a, b in itertools.pairwise([0, *cuts.tolist(), len(sizes)]):
        part = batch.slice(a, b - a)
        ids = part.column("ids").flatten()
        values = ids.to_numpy(zero_copy_only=False)
        _check(np.array([-1]) if ids.null_count else values, width)
        data, ends = values.astype(f"<u{width}").tobytes(), np.cumsum(sizes[a:b], dtype=np.int64) * width
        yield part, [data[i:j] + mark for i, j in itertools.pairwise([0, *ends.tolist()])]


def _check(ids: np.ndarray, width: int) -> None:
    end, _ = marks(width)
    if len(ids) and (ids.min() < 0 or ids.max() >= end):
        raise ValueError(f"ids must be 0 to {end - 1} to be kept in {width} bytes")


def _placed(docs: DataFrame, column: str, width: int) -> DataFrame:
    """doc_id, ids (packed, with the end mark), n_ids, part and at: the task that has packed a row
    and how many ids that task had before it. Written with the ids, these are the rows'
    places for good, however later passes are split."""
    kind = _kind(docs, column)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, lines in _rows(batch, kind, width):
                n = np.array([len(x) // width for x in lines], np.int64)
                begins = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(lines, pa.binary()),
                        pa.array(n),
                        pa.array(np.full(len(n), part, np.int64)),
                        pa.array(begins),
                    ],
                    ["doc_id", "ids", "n_ids", "part", "at"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).alias("ids"))
    shape = "doc_id long, ids binary, n_ids long, part long, at long"
    return kept_table(rows.mapInArrow(tidy(place), shape), "placed", "zstd")


def write_shards(
    docs: DataFrame,
    folder: str,
    length: int = 2048,
    per_shard: int = 8192,
    key: int = 20_240,
    column: str = "text",
    width: int = 1,
) -> tuple[DataFrame, DataFrame, int]:
    """Write the ids in `column` (an array of ids that fit `width` bytes, or binary with such
    ids packed, little end first, or a text, whose bytes are its ids at width 1) to shards
    below `folder`, which all executors must reach; give back where the documents lie, what
    shards there are, and the number of sequences.

    First: doc_id, n_ids (with the end mark), sequence and place (of its first id), slot,
    shard and offset (byte of its first id in that file). Second: shard, first_slot, n_slots,
    n_bytes, crc32.

    The ids are written once to the shared folder, each row with its place; all passes read
    that table, so it matters to none of them how it is split, or which executors are left.
    Pieces of a sequence meet at the task of their shard, one task a shard. Null texts and arrays
    count as empty (an end mark alone); null and repeated doc_ids stay as they are, further
    columns are left out, an empty table gives no shards; a text may be of any length. A shard that
    is written again, as after a lost executor or by a second attempt, is the same file.
    """
    spark = docs.sparkSession
    kind, stride, filler = _kind(docs, column), length * width, marks(width)[1]
    if kind not in ("array", "binary") and width != 1:
        raise ValueError("the bytes of a text are ids of one byte")
    folder = located(spark, folder)
    placed = _placed(docs, column, width)
    sums = placed.groupBy("part").agg(F.max(F.col("at") + F.col("n_ids")).alias("n")).collect()
    first, short, total = {}, {}, 0
    for part, n in sorted((r.part, r.n) for r in sums):
        first[part] = total
        total += -(-n // length)
        # The last sequence of a part may have fewer ids
        short[total - 1] = (n - 1) % length + 1
    known = spark.sparkContext.broadcast((first, short))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line, begin = bytearray(), 0
        for batch in batches:
            for part in chunks(batch, "ids"):
                starts = [known.value[0][p] * length for p in part.column("part").to_pylist()]
                for start, at, ids in zip(
                    starts, part.column("at").to_pylist(), part.column("ids").to_pylist(), strict=True
                ):
                    if line and start + at != begin + len(line) // width:
                        yield pieces(begin, bytes(line))
                        line.clear()
                    if not line:
                        begin = start + at
                    line += ids
                # Whole sequences go, the rest waits for the next row
                whole = (begin + len(line) // width) // length * length - begin
                if whole > 0:
                    yield pieces(begin, bytes(line[: whole * width]))
                    del line[: whole * width]
                    begin += whole
        if line:
            yield pieces(begin, bytes(line))

    def pieces(begin: int, line: bytes) -> pa.RecordBatch:
        """Ids from a position on, cut where sequences end, each piece packed."""
        end = begin + len(line) // width
        borders = [begin, *range((begin // length + 1) * length, end, length), end]
        cuts = [line[(a - begin) * width : (b - begin) * width] for a, b in itertools.pairwise(borders)]
        at = np.array(borders[:-1], np.int64)
        slots = permute(at // length, total, key)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(slots // per_shard),
                pa.array(slots),
                pa.array(at // length),
                pa.array(at % length),
                pa.array([len(x) for x in cuts], pa.int64()),
                pa.array([pa.compress(x, "zstd", asbytes=True) for x in cuts], pa.binary()),
            ],
            ["shard", "slot", "sequence", "place", "size", "ids"],
        )

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = opened(folder)
        store.create_dir(path, recursive=True)
        done: list[tuple[int, int, int, int, int]] = []
        now = out = None
        crc = n = 0

        def put(sequence: int, line: bytes) -> None:
            nonlocal crc, n
            want = known.value[1].get(sequence, length) * width
            if len(line) != want:
                raise RuntimeError(f"sequence {sequence} has {len(line)} bytes in place of {want}")
            line += filler.to_bytes(width, "little") * ((stride - want) // width)
            out.write(line)
            crc = zlib.crc32(line, crc)
            n += 1

        def finish() -> None:
            out.close()
            want = min(per_shard, total - now * per_shard)
            if n != want:
                raise RuntimeError(f"shard {now} has {n} sequences in place of {want}")
            store.move(hidden, f"{path}/{name(now)}")
            done.append((now, now * per_shard, n, n * stride, crc))

        waiting: tuple[int, int, bytes] | None = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "slot", "sequence", "place", "size", "ids")]
            for shard, slot, sequence, place, size, ids in zip(*columns, strict=True):
                ids = pa.decompress(ids, size, "zstd", asbytes=True)
                if waiting and waiting[0] == slot:
                    if place * width != len(waiting[2]):
                        raise RuntimeError(f"sequence {sequence} lacks a piece before {place}")
                    waiting = (slot, sequence, waiting[2] + ids)
                    continue
                if waiting:
                    put(*waiting[1:])
                if shard != now:
                    if now is not None:
                        finish()
                    now, crc, n = shard, 0, 0
                    # No other attempt at this shard has the same name
                    hidden = f"{path}/.{name(now)}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(hidden)
                waiting = (slot, sequence, ids)
        if waiting:
            put(*waiting[1:])
            finish()
        columns = list(zip(*done, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns],
            ["shard", "first_slot", "n_slots", "n_bytes", "crc32"],
        )

    tasks = min(max(1, -(-total // per_shard)), MOST_TASKS)
    packed = placed.select("part", "at", "ids").mapInArrow(
        tidy(pack), "shard long, slot long, sequence long, place long, size long, ids binary"
    )
    shards = kept_table(
        packed.repartitionById(tasks, (F.col("shard") % tasks).cast("int"))
        .sortWithinPartitions("slot", "place")
        .mapInArrow(tidy(save), "shard long, first_slot long, n_slots long, n_bytes long, crc32 long"),
        "shards",
    )

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = np.array([known.value[0][p] for p in batch.column("part").to_pylist()], np.int64)
            start = starts * length + batch.column("at").to_numpy()
            sequence, inner = start // length, start % length
            slots = permute(sequence, total, key)
            offset = (slots % per_shard * length + inner) * width
            places = (sequence, inner, slots, slots // per_shard, offset)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_ids"), *map(pa.array, places)],
                ["doc_id", "n_ids", "sequence", "place", "slot", "shard", "offset"],
            )

    where = placed.select("doc_id", "n_ids", "part", "at").mapInArrow(
        locate,
        "doc_id long, n_ids long, sequence long, place long, slot long, shard long, offset long",
    )
    return where, shards, total


def name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def read_slots(
    folder: str, begin: int, end: int, length: int = 2048, per_shard: int = 8192, width: int = 1
) -> Iterator[np.ndarray]:
    """Sequences of the slots from `begin` to `end` (excluded), file after file: a run that
    stopped goes on from the slot it had come to. `folder` is as `shard_folder` gives it, or a local
    path."""
    store, path = opened(folder)
    while begin < end:
        shard = begin // per_shard
        with store.open_input_file(f"{path}/{name(shard)}") as file:
            file.seek(begin % per_shard * length * width)
            for _ in range(min(end, (shard + 1) * per_shard) - begin):
                yield np.frombuffer(file.read(length * width), f"<u{width}")
                begin += 1


def read_sequences(
    folder: str,
    sequences: np.ndarray,
    n: int,
    key: int = 20_240,
    length: int = 2048,
    per_shard: int = 8192,
    width: int = 1,
) -> Iterator[np.ndarray]:
    """Sequences by their number before the permutation."""
    for slot in permute(sequences, n, key).tolist():
        yield from read_slots(folder, slot, slot + 1, length, per_shard, width)


def shard_folder(spark: SparkSession) -> str:
    """A new folder for shards below the shared one, with its scheme."""
    return located(spark, f"{shared_folder(spark)}/tallyforge-llm/order-{uuid.uuid4().hex}")
