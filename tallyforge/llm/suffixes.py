"""Exact removal of long repeats with sparse suffix arrays and a logarithmic index family.

A byte goes if a string of 100 bytes that covers it also starts earlier. Comparing all
strings would move ten times the corpus, so only those at chosen positions are compared
first (see `anchors`): equal strings have their anchor at the same place.

1. Each anchor gives a suffix of bytes, known by the digest of its first ones (the key) and
   of the whole region of strings that it serves. Sorted by key and region, equal regions
   lie side by side: all but the earliest go. A key whose regions are all equal is done.
2. The strings of the remaining regions are laid open, in order of their place. A batch of
   them becomes a sorted array, is scanned against the arrays of the earlier levels, and
   becomes a level itself; levels of like size are merged, so that there are few. As only
   equality is asked, arrays are ordered by digest.
3. What was found for a document is cut out of it.

The documents are written once with their numbers and read from there three times; texts are
never shuffled. What concerns a document is written to the folder of its partition when it was
numbered, and read there by the tasks that come to rows of it, however these are split.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.anchors import LENGTH, Strings, _mixed, pieces
from tallyforge.llm.common import chunks, located, numbered, opened, tidy
from tallyforge.session import shared_folder

#: What becomes of an anchor's strings: all repeat; to be laid open; the same, for keys with
#: so many regions that their strings are dealt out one by one. A mark tells of such a key.
REPEAT, OPEN, HOT, MARK = 1, 2, 3, 0
NORMAL = 4
#: Regions of a key in one chunk, and in all, from which the key is hot.
HOT_IN_CHUNK, HOT_IN_ALL = 16, 4_096
ROW_BITS = 33
#: A place and a number of strings in one long.
COUNT_BITS = 8
LAST = 2**63 - 1
NOTES = "part int, row array<long>, {}"
#: Rows to be scanned: a region's bytes, one string by its digest, a run known to repeat.
REGION, STRING, KNOWN = 1, 2, 3


class Levels:
    """Sorted arrays of digests of geometrically growing sizes."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, digests: np.ndarray) -> np.ndarray:
        """Which digests were there before, in an earlier call or earlier in this one."""
        new, first, back = np.unique(digests, return_index=True, return_inverse=True)
        old = np.zeros(len(new), bool)
        for level in self.levels:
            at = np.searchsorted(level, new)
            at[at == len(level)] = 0
            old |= level[at] == new
        seen = old[back]
        again = np.ones(len(digests), bool)
        again[first] = False
        fresh = new[~old]
        if len(fresh):
            self.levels.append(fresh)
        while len(self.levels) > 1 and 2 * len(self.levels[-1]) > len(self.levels[-2]):
            one, two = self.levels.pop(), self.levels.pop()
            both = np.concatenate([two, one])
            both.sort(kind="stable")
            self.levels.append(both)
        return seen | again


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode() for t in batch.column("text").to_pylist()]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of all texts; of equal regions in a chunk the earliest stands for all."""
    for batch in batches:
        for part in chunks(batch, "text"):
            rows, ids = part.column("row").to_numpy(), part.column("doc_id").to_numpy()
            found = []
            for data, valid, which, starts, at in pieces(_bytes(part)):
                strings = Strings(data)
                key, anchor, first, n = strings.anchors(valid)
                inner = _mixed((anchor - first).astype(np.uint64) + np.uint64(1))
                region = strings.digest(first, first + n - 1 + LENGTH) ^ inner
                text = np.searchsorted(starts, first, "right") - 1
                place = first - starts[text] + at[text]
                text = which[text]
                found.append((key, region, ids[text], rows[text], place << COUNT_BITS | n))
            if not found:
                continue
            key, region, doc, row, spot = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((spot, doc, region, key))
            key, region, doc, row, spot = (x[order] for x in (key, region, doc, row, spot))
            new_key = np.r_[True, key[1:] != key[:-1]]
            new = new_key | np.r_[True, region[1:] != region[:-1]]
            group = np.cumsum(new_key) - 1
            hot = np.bincount(group, new)[group] >= HOT_IN_CHUNK
            state = np.where(new, np.where(hot, HOT, NORMAL), REPEAT).astype(np.int8)
            marks = np.flatnonzero(new_key & hot)
            take = np.r_[np.arange(len(key)), marks]
            state = np.r_[state, np.full(len(marks), MARK, np.int8)]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(key[take]),
                    _signed(region[take]),
                    pa.array(doc[take]),
                    pa.array(row[take]),
                    pa.array(spot[take]),
                    pa.array(state),
                ],
                ["key", "region", "doc_id", "row", "spot", "state"],
            )


def _packed(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Notes as lists, one row for each partition of the documents that they are about."""
    part = columns["row"] >> ROW_BITS
    order = np.argsort(part, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0][: len(part)])
    cuts = np.r_[first, len(part)].astype(np.int32)
    lists = [
        pa.ListArray.from_arrays(cuts, pa.array(v[order].astype(np.int64)))
        for v in columns.values()
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[order][first]).cast(pa.int32()), *lists], ["part", *columns]
    )


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What becomes of each anchor, from rows sorted by key, marks first, region and place.

    The rows of a key wait until the next key comes; a key of too many goes on as hot."""
    names = ("key", "region", "row", "spot", "state")
    kept = None
    hot_key = None

    def told(x: dict[str, np.ndarray], hot: int | None) -> pa.RecordBatch:
        key, region, state = x["key"], x["region"], x["state"]
        own = state >= NORMAL
        mark = state == MARK
        new_key = np.r_[True, key[1:] != key[:-1]]
        # Marks stand before the regions of their key
        new = own & (new_key | np.r_[True, (region[1:] != region[:-1]) | mark[:-1]])
        group = np.cumsum(new_key) - 1
        regions = np.bincount(group, new)[group]
        marked = (np.bincount(group, mark)[group] > 0) | (regions > HOT_IN_ALL)
        if hot is not None:
            marked |= key == hot
        what = np.where(marked, HOT, np.where(regions > 1, OPEN, 0))
        what = np.where(own, np.where(new, what, REPEAT), np.where(mark, 0, state))
        keep = what > 0
        return _packed(
            {"row": x["row"][keep], "spot": x["spot"][keep], "key": key[keep], "what": what[keep]}
        )

    for batch in batches:
        x = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        # Repeats and hot anchors of a chunk only pass through
        done = (x["state"] == REPEAT) | (x["state"] == HOT)
        if done.any():
            yield told({n: v[done] for n, v in x.items()}, None)
            x = {n: v[~done] for n, v in x.items()}
        if kept is not None:
            x = {n: np.concatenate([kept[n], v]) for n, v in x.items()}
        if not len(x["key"]):
            continue
        last = x["key"][-1]
        cut = int(np.flatnonzero(np.r_[True, x["key"][1:] != x["key"][:-1]])[-1])
        if cut:
            yield told({n: v[:cut] for n, v in x.items()}, hot_key)
            x = {n: v[cut:] for n, v in x.items()}
        if hot_key is not None and last != hot_key:
            hot_key = None
        if len(x["key"]) > HOT_IN_ALL:
            hot_key = last
            # The last row stays, for the region of the next one
            yield told({n: v[:-1] for n, v in x.items()}, hot_key)
            x = {n: v[-1:] for n, v in x.items()}
        kept = x
    if kept is not None and len(kept["key"]):
        yield told(kept, hot_key)


class _Notes:
    """What was written about the rows of one partition, by row."""

    def __init__(self, folder: str, columns: list[str], part: int):
        import pyarrow.dataset as dataset
        from pyarrow import fs

        store, path = opened(folder)
        # A partition may have no notes, but then the folder is there all the same
        if store.get_file_info(path).type != fs.FileType.Directory:
            raise FileNotFoundError(f"the notes in {folder} can't be reached from this task")
        path = f"{path}/part={part}"
        self.columns = {c: np.zeros(0, np.int64) for c in ("row", *columns)}
        if store.get_file_info(path).type != fs.FileType.NotFound:
            found = dataset.dataset(path, filesystem=store, format="parquet")
            table = found.to_table(columns=["row", *columns]).combine_chunks()
            self.columns = {
                c: pa.concat_arrays([x.flatten() for x in table.column(c).chunks]).to_numpy()
                for c in table.column_names
                if len(table)
            } or self.columns
        order = np.argsort(self.columns["row"], kind="stable")
        self.columns = {c: v[order] for c, v in self.columns.items()}
        self.rows = self.columns["row"]

    def of(self, row: int) -> dict[str, np.ndarray]:
        low, high = np.searchsorted(self.rows, [row, row + 1])
        return {c: v[low:high] for c, v in self.columns.items()}


def _opened(folder: str):
    """Regions to be laid open, with their bytes; the strings of hot ones by themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = notes = None
        for batch in batches:
            for part in chunks(batch, "text"):
                out: list[tuple] = []
                bytes_, marks = [], []
                for row, doc, text in zip(
                    part.column("row").to_pylist(),
                    part.column("doc_id").to_pylist(),
                    part.column("text").to_pylist(),
                    strict=True,
                ):
                    if row >> ROW_BITS != at:
                        at = row >> ROW_BITS
                        notes = _Notes(folder, ["spot", "what", "key"], at)
                    note = notes.of(row)
                    open_ = note["what"] >= OPEN
                    if not open_.any():
                        continue
                    data = text.encode()
                    for spot, what, key in zip(
                        *(note[c][open_].tolist() for c in ("spot", "what", "key")), strict=True
                    ):
                        place, n = spot >> COUNT_BITS, spot & ((1 << COUNT_BITS) - 1)
                        line = data[place : place + n - 1 + LENGTH]
                        if what == OPEN:
                            out.append((key, doc, row, spot, REGION, line))
                        else:
                            bytes_.append(line)
                            marks.append((doc, row, place, n))
                if marks:
                    out += _dealt(bytes_, np.array(marks, np.int64))
                if out:
                    *columns, lines = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(c, pa.int64()) for c in columns), pa.array(lines, pa.binary())],
                        ["key", "doc_id", "row", "spot", "kind", "line"],
                    )

    return run


def _strings(lines: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Digests of all strings of all lines, one after the other."""
    out, at, size = [], 0, 0
    for i in range(len(lines) + 1):
        if i == len(lines) or size + len(lines[i]) > 1 << 17:
            if i > at:
                part = lines[at:i]
                data = np.frombuffer(b"".join(part), np.uint8)
                lengths = np.array([len(x) for x in part])
                n = counts[at:i]
                begin = np.repeat(np.cumsum(lengths) - lengths, n) + _inner(n)
                out.append(Strings(data).digest(begin, begin + LENGTH))
            at, size = i, 0
        if i < len(lines):
            size += len(lines[i])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _inner(n: np.ndarray) -> np.ndarray:
    """0 ... k-1 for each k of n."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _dealt(lines: list[bytes], marks: np.ndarray) -> list[tuple]:
    """The strings of hot regions, by their digests: of equal ones in the chunk the earliest
    goes on alone, the others are known to repeat and go on as runs."""
    doc, row, place, n = marks.T
    digest = _strings(lines, n).view(np.int64)
    region = np.repeat(np.arange(len(n)), n)
    at = place[region] + _inner(n)
    order = np.lexsort((at, doc[region], digest))
    again = np.zeros(len(digest), bool)
    again[order[1:]] = digest[order[1:]] == digest[order[:-1]]
    new = ~again
    out = zip(
        digest[new].tolist(),
        doc[region[new]].tolist(),
        row[region[new]].tolist(),
        (at[new] << COUNT_BITS | 1).tolist(),
        strict=True,
    )
    known = np.flatnonzero(again)
    starts = np.r_[True, (np.diff(known) != 1) | (np.diff(region[known]) != 0)][: len(known)]
    first = np.flatnonzero(starts)
    size, head = np.diff(np.r_[first, len(known)]), known[first]
    runs = zip(
        row[region[head]].tolist(),
        doc[region[head]].tolist(),
        row[region[head]].tolist(),
        (at[head] << COUNT_BITS | size).tolist(),
        strict=True,
    )
    return [*((*x, STRING, None) for x in out), *((*x, KNOWN, None) for x in runs)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated strings, from rows in the order of their places: batch after batch against
    the levels of the earlier ones. Runs of strings come as one row."""
    levels = Levels()
    for batch in batches:
        row, spot, key, kind = (
            batch.column(c).to_numpy() for c in ("row", "spot", "key", "kind")
        )
        place, n = spot >> COUNT_BITS, spot & ((1 << COUNT_BITS) - 1)
        of = np.repeat(np.arange(len(n)), n)
        digest = np.zeros(len(of), np.uint64)
        region, string = kind == REGION, kind == STRING
        lines = [x for x in batch.column("line").to_pylist() if x is not None]
        digest[region[of]] = _strings(lines, n[region])
        digest[string[of]] = key[string].view(np.uint64)
        again = kind[of] == KNOWN
        again[~again] = levels.add(digest[~again])
        row_of, at = row[of][again], (place[of] + _inner(n))[again]
        if len(at):
            new = np.r_[True, (row_of[1:] != row_of[:-1]) | (at[1:] != at[:-1] + 1)]
            first = np.flatnonzero(new)
            size = np.diff(np.r_[first, len(at)])
            yield _packed({"row": row_of[first], "place": at[first], "n": size})


def _write_notes(df: DataFrame, name: str) -> str:
    """One folder for each partition of the documents; the path is one that tasks can open."""
    path = f"{shared_folder(df.sparkSession)}/tallyforge-llm/{name}-{uuid.uuid4().hex}"
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(parts, "part").write.partitionBy("part").parquet(path)
    return located(df.sparkSession, path)


def repeats(docs: DataFrame, row: str) -> tuple[str, str]:
    """Folders of the notes on repeated strings in the rows of `docs`, for `cut`; the column
    `row` has their numbers, as `numbered` writes them.

    The earlier of two equal strings is the one with the smaller doc_id (null last),
    or the smaller start in rows of the same doc_id.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(row).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"),
        "text",
    )
    shape = "key long, region long, doc_id long, row long, spot long, state tinyint"
    # A repeat or a hot anchor needs no meeting: dealt by its document
    meets = F.when(F.col("state").isin(MARK, NORMAL), F.col("key")).otherwise(F.col("row"))
    judged = (
        rows.mapInArrow(tidy(_find), shape)
        .repartition(parts, meets)
        .sortWithinPartitions("key", F.col("state") != MARK, "region", "doc_id", "spot")
        .mapInArrow(tidy(_judge), NOTES.format("spot array<long>, key array<long>, what array<long>"))
    )
    first = _write_notes(judged, "anchors")
    found = (
        rows.mapInArrow(
            tidy(_opened(first)),
            "key long, doc_id long, row long, spot long, kind long, line binary",
        )
        .repartition(parts, "key")
        .sortWithinPartitions("doc_id", "spot")
        .mapInArrow(tidy(_scan), NOTES.format("place array<long>, n array<long>"))
    )
    return first, _write_notes(found, "strings")


def spans(notes: list[dict[str, np.ndarray]]) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes (end excluded) of one document."""
    anchors, strings = notes
    gone = anchors["what"] == REPEAT
    place = np.r_[anchors["spot"][gone] >> COUNT_BITS, strings["place"]]
    n = np.r_[anchors["spot"][gone] & ((1 << COUNT_BITS) - 1), strings["n"]]
    if not len(place):
        return []
    order = np.argsort(place, kind="stable")
    begin, end = place[order], np.maximum.accumulate((place + n - 1 + LENGTH)[order])
    new = np.r_[True, begin[1:] > end[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(begin) - 1]
    return list(zip(begin[new].tolist(), end[last].tolist(), strict=True))


def kept(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for begin, end in gone:
        out.append(data[at:begin])
        at = end
    return b"".join([*out, data[at:]])


def _cutter(folders: tuple[str, str], each):
    """`each` takes a batch and the removed runs of its rows, known by the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = notes = None
        for batch in batches:
            for part in chunks(batch, "text"):
                gone = []
                for row in part.column(part.num_columns - 1).to_pylist():
                    if row >> ROW_BITS != at:
                        at = row >> ROW_BITS
                        notes = (
                            _Notes(folders[0], ["spot", "what"], at),
                            _Notes(folders[1], ["place", "n"], at),
                        )
                    gone.append(spans([x.of(row) for x in notes]))
                yield each(part, gone)

    return run


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row for each of `docs`. Null
    texts count as empty; of repeated rows the later ones lose what they share; rows without
    doc_id count as last; an empty table gives no rows; a text may be of any length, and further
    columns are left out."""
    rows, row = numbered(docs.select(F.col("doc_id").cast("long"), "text"))
    folders = repeats(rows, row)

    def each(batch: pa.RecordBatch, gone: list[list[tuple[int, int]]]) -> pa.RecordBatch:
        data = _bytes(batch)
        left = [kept(d, g) for d, g in zip(data, gone, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(d) for d in data], pa.int64()),
                pa.array([len(d) - len(x) for d, x in zip(data, left, strict=True)], pa.int64()),
                pa.array([len(g) for g in gone], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    return rows.mapInArrow(
        tidy(_cutter(folders, each)),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    )


def cut(docs: DataFrame) -> DataFrame:
    """`docs` without the repeats in their texts (and n_chars, if there, counted anew). Where
    a cut goes through a character, its remaining bytes go too; rows of which nothing is left
    but white space stay out, if anything was cut from them."""
    rows, row = numbered(docs)
    folders = repeats(rows, row)
    schema = docs.schema

    def each(batch: pa.RecordBatch, gone: list[list[tuple[int, int]]]) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        keep = [True] * len(texts)
        for i, g in enumerate(gone):
            if g:
                texts[i] = kept(texts[i].encode(), g).decode("utf-8", "ignore")
                keep[i] = bool(texts[i].strip())
        out = batch.select(list(range(batch.num_columns - 1)))
        at = out.schema.get_field_index("text")
        out = out.set_column(at, "text", pa.array(texts, out.column("text").type))
        if (at := out.schema.get_field_index("n_chars")) >= 0:
            old = out.column("n_chars")
            counts = [
                len(t) if g else n for t, g, n in zip(texts, gone, old.to_pylist(), strict=True)
            ]
            out = out.set_column(at, "n_chars", pa.array(counts, old.type))
        return out.filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(tidy(_cutter(folders, each)), schema)
